"""Independent DuckDB oracle: every target restated as plain SQL (window
minima, ordered string_agg / list aggregates, EXISTS / NOT EXISTS,
row_number windows), over the same source views as the Spark jobs.

``oracle_sql()`` returns one self-contained query per registered name:
the needed source views and target CTEs are prepended as a WITH list.
"""

from __future__ import annotations

import re

from headway.functions.columns import CSS_COLOR_NAMES
from headway.sources.fixtures import FIXTURE_NAMES, fixture_body, fixture_closure

SKIP = "7, 21"
DST_AGENCY_IDS = "(SELECT agency_id FROM o_agencies)"
WEEKDAY_BOOLS = ", ".join(f"CAST(c.{d} AS BOOLEAN) AS {d}" for d in
                          ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"])
WEEKDAY_COLS = "c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday, c.sunday"
TRIP_ORDER = ("agency_id, timed_pattern_id, calendar_id, start_time, end_time, headway_secs, block_id, monday, "
              "tuesday, wednesday, thursday, friday, saturday, sunday, in_seat_transfer")


def _nl(cols: str) -> str:
    return ", ".join(f"{c.strip()} NULLS LAST" for c in cols.split(","))


# Target tables as CTEs, in dependency order.
CTES: list[tuple[str, str]] = [
    ("o_stop_times", "SELECT *, CAST(NULL AS INTEGER) AS drop_off_type, CAST(NULL AS BIGINT) AS headsign_id FROM src_stop_times"),
    ("o_agencies", f"""SELECT DISTINCT ag.agency_id, ag.agency_id_import, ag.agency_url, ag.agency_timezone, ag.agency_lang_id, ag.agency_name,
 ag.agency_short_name, ag.agency_phone, ag.agency_fare_url, ag.agency_info, ag.query_tracking, ag.last_modified, ag.no_frequencies,
 link.agency_group_id AS feed_id
 FROM src_agency ag JOIN src_agency_group_assoc link USING (agency_id) WHERE ag.agency_id NOT IN ({SKIP})"""),
    ("o_feeds", f"""SELECT DISTINCT grp.agency_group_id AS feed_id, grp.group_name AS name, grp.feed_contact_email AS contact_email,
 grp.feed_contact_url AS contact_url, grp.feed_license AS license, grp.last_modified FROM src_agency_groups grp
 WHERE EXISTS (SELECT 1 FROM src_agency_group_assoc link WHERE link.agency_group_id = grp.agency_group_id
               AND link.agency_id NOT IN ({SKIP}))"""),
    ("o_zones", """SELECT zone_id, zone_name AS name, agency_id, last_modified, zone_id_import FROM src_zones
 UNION ALL SELECT -411, 'Wildcard: any or all zones for this agency.', -411, DATE '2024-01-01', ''"""),
    ("o_stops", f"""SELECT ag.feed_id, sp.stop_id, sp.stop_code, sp.platform_code, sp.location_type,
 sp.parent_station AS parent_station_id, sp.stop_name AS name, sp.stop_desc, sp.stop_comments, sp.city, sp.direction_id,
 sp.stop_url AS url, zn.zone_id, sp.stop_lon AS lon, sp.stop_lat AS lat,
 sp.publish_status AS enabled, sp.agency_id,
 (SELECT min(n.n_name) FROM nation n, (SELECT sp.stop_lon + 180 AS x, sp.stop_lat AS y) p
   WHERE p.x >= 15 * n.n_nationkey AND p.x < 15 * n.n_nationkey + 15 AND p.y >= -60
   AND p.y < 60 - 20 * abs(p.x - 15 * n.n_nationkey - 7.5) / 7.5
   AND NOT (p.y >= -10 AND p.y < 12 - 22 * abs(p.x - 15 * n.n_nationkey - 7.5) / 3.5)) AS timezone
 FROM src_stops sp JOIN o_agencies ag ON ag.agency_id = sp.agency_id LEFT JOIN src_zones zn ON zn.zone_id = sp.zone_id"""),
    ("o_routes", f"""SELECT agency_id, route_id, route_short_name, route_long_name, route_desc AS route_description, route_type,
 coalesce('#' || lower(CASE WHEN regexp_full_match(route_color, '[0-9a-fA-F]{{6}}') THEN route_color END), '#ffffff') AS route_color,
 coalesce('#' || lower(CASE WHEN regexp_full_match(route_text_color, '[0-9a-fA-F]{{6}}') THEN route_text_color END), '#000000') AS route_text_color,
 route_url, route_bikes_allowed, route_id_import, last_modified, route_sort_order, coalesce(NOT hidden, true) AS enabled
 FROM src_routes WHERE agency_id IN {DST_AGENCY_IDS}"""),
    ("o_headsigns", f"""SELECT DISTINCT agency_id, headsign_id, headsign FROM src_headsigns
 WHERE headsign IS NOT NULL AND headsign_id IS NOT NULL AND agency_id IN {DST_AGENCY_IDS}"""),
    ("o_calendars", f"""SELECT agency_id, service_schedule_group_id AS calendar_id, service_schedule_group_label AS name
 FROM src_service_schedule_groups WHERE service_schedule_group_id IS NOT NULL AND agency_id IN {DST_AGENCY_IDS}"""),
    ("o_calendar_bounds", f"""SELECT bnd.agency_id, bnd.service_schedule_group_id AS calendar_id, bnd.start_date, bnd.end_date
 FROM src_service_schedule_bounds bnd WHERE bnd.agency_id IN {DST_AGENCY_IDS}
 AND EXISTS (SELECT 1 FROM o_calendars k WHERE k.calendar_id = bnd.service_schedule_group_id)"""),
    ("o_calendar_dates", f"""SELECT calendar_date_id, date, agency_id, description AS name, last_modified FROM src_calendar_dates
 WHERE agency_id IN {DST_AGENCY_IDS}"""),
    ("o_service_exceptions", f"""SELECT ex.calendar_date_id, ex.exception_type, ex.service_exception AS calendar_id, {WEEKDAY_BOOLS}, ex.agency_id, ex.last_modified
 FROM src_calendar_date_service_exceptions ex JOIN src_calendar c ON c.calendar_id = ex.service_exception
 WHERE ex.agency_id IN {DST_AGENCY_IDS}
 AND EXISTS (SELECT 1 FROM o_calendars k WHERE k.calendar_id = ex.service_exception)
 AND EXISTS (SELECT 1 FROM o_calendar_dates d WHERE d.calendar_date_id = ex.calendar_date_id)"""),
    # literal reading: the date id must equal the calendar id, and some calendar date must exist
    ("o_service_exceptions_literal", f"""SELECT ex.calendar_date_id, ex.exception_type, ex.service_exception AS calendar_id, {WEEKDAY_BOOLS}, ex.agency_id, ex.last_modified
 FROM src_calendar_date_service_exceptions ex JOIN src_calendar c ON c.calendar_id = ex.service_exception
 WHERE ex.agency_id IN {DST_AGENCY_IDS}
 AND EXISTS (SELECT 1 FROM o_calendars k WHERE k.calendar_id = ex.service_exception)
 AND ex.calendar_date_id = c.calendar_id AND EXISTS (SELECT 1 FROM o_calendar_dates)"""),
    ("o_blocks", f"""SELECT blk.agency_id, blk.block_id, blk.name, col.color FROM
 (SELECT DISTINCT agency_id, block_id, block_label AS name FROM src_blocks WHERE agency_id IN {DST_AGENCY_IDS}) blk
 LEFT JOIN sample_colors col ON col.color_id = blk.block_id"""),
    ("o_fare_attributes", f"""SELECT agency_id, fare_id, price, currency_type, payment_method, transfers, transfer_duration, last_modified, fare_id_import
 FROM src_fare_attributes
 WHERE agency_id IN {DST_AGENCY_IDS}"""),
    ("o_transfers", f"""SELECT transfer_id, from_stop_id, to_stop_id, transfer_type, min_transfer_time, agency_id, last_modified,
 from_stop_id_import, to_stop_id_import FROM src_transfers
 WHERE agency_id IN {DST_AGENCY_IDS}"""),
    ("o_users", """SELECT user_id, email, pass, first_name, last_name, active, registration_date, language_id, last_modified,
 CASE WHEN read_only IS NULL THEN NULL ELSE read_only = 1 END AS read_only,
 CASE WHEN admin IS NULL THEN NULL ELSE admin = 1 END AS admin FROM src_users"""),
    ("o_user_permissions", """SELECT perm.permission_id, perm.agency_id, perm.user_id, perm.last_modified
 FROM src_user_permissions perm JOIN o_agencies USING (agency_id) JOIN o_users USING (user_id)"""),
    # ---- pattern mining
    # stop rows of base trips past the skip list, with the trip's first times
    ("o_trip_rows", f"""SELECT x.trip_id, x.stop_sequence, x.stop_id, x.arrival_time, x.departure_time,
 min(x.arrival_time) OVER (PARTITION BY x.trip_id) AS first_arr, min(x.departure_time) OVER (PARTITION BY x.trip_id) AS first_dep
 FROM src_stop_times x WHERE x.agency_id NOT IN ({SKIP})
 AND EXISTS (SELECT 1 FROM src_trips tr WHERE tr.trip_id = x.trip_id AND tr.based_on IS NULL)"""),
    ("o_trip_sig", """SELECT trip_id, min(first_arr) AS min_arrival_time,
 string_agg(CAST(stop_id AS VARCHAR), ', ' ORDER BY stop_sequence NULLS LAST, stop_id) AS stops_pattern,
 string_agg(CASE WHEN arrival_time IS NULL THEN '' ELSE CAST(arrival_time - first_arr AS VARCHAR) END, ',' ORDER BY stop_sequence NULLS LAST, stop_id) AS arrival_time_intervals,
 string_agg(CASE WHEN arrival_time IS NULL THEN '' ELSE CAST(departure_time - first_dep AS VARCHAR) END, ',' ORDER BY stop_sequence NULLS LAST, stop_id) AS departure_time_intervals
 FROM o_trip_rows GROUP BY trip_id"""),
    ("o_pattern_groups", f"""SELECT g.stops_pattern, g.arrival_time_intervals, g.departure_time_intervals, tr.agency_id, tr.route_id,
 tr.direction_id, min(tr.trip_id) AS one_trip, count(*) AS trip_count,
 list(tr.trip_id ORDER BY g.min_arrival_time, tr.trip_id) AS member_trips
 FROM o_trip_sig g JOIN src_trips tr ON tr.trip_id = g.trip_id
 WHERE tr.based_on IS NULL AND tr.agency_id IN {DST_AGENCY_IDS}
 GROUP BY g.stops_pattern, g.arrival_time_intervals, g.departure_time_intervals, tr.agency_id, tr.route_id, tr.direction_id"""),
    ("o_rep_min", f"""SELECT trip_id, min(arrival_time) AS rep_arr, min(departure_time) AS rep_dep FROM src_stop_times
 WHERE agency_id IN {DST_AGENCY_IDS} GROUP BY trip_id"""),
    ("o_tp", """SELECT row_number() OVER (ORDER BY g.one_trip) AS timed_pattern_id, g.*, r.rep_arr AS min_arrival_time,
 r.rep_dep AS min_departure_time FROM o_pattern_groups g JOIN o_rep_min r ON r.trip_id = g.one_trip"""),
    ("o_stop_lists", f"""SELECT x.trip_id, string_agg(CAST(x.stop_id AS VARCHAR), ', ' ORDER BY x.stop_sequence NULLS LAST, x.stop_id) AS stop_list
 FROM src_stop_times x JOIN src_trips tr ON tr.trip_id = x.trip_id
 WHERE tr.based_on IS NULL AND tr.agency_id IN {DST_AGENCY_IDS} GROUP BY x.trip_id"""),
    ("o_sp", """SELECT u.stops_pattern, u.route_id, u.direction_id,
 row_number() OVER (ORDER BY u.stops_pattern NULLS LAST, u.route_id NULLS LAST, u.direction_id NULLS LAST) AS pattern_id
 FROM (SELECT DISTINCT l.stop_list AS stops_pattern, tr.route_id, tr.direction_id
       FROM o_stop_lists l JOIN src_trips tr ON tr.trip_id = l.trip_id) u"""),
    ("o_wide_keys", """SELECT tp.timed_pattern_id, sp.pattern_id, tp.agency_id, tp.one_trip, tp.member_trips, sp.stops_pattern,
 tp.arrival_time_intervals, tp.departure_time_intervals, tp.min_arrival_time, tp.min_departure_time
 FROM o_tp tp JOIN o_sp sp ON sp.stops_pattern = tp.stops_pattern AND sp.route_id = tp.route_id
 AND sp.direction_id = tp.direction_id"""),
    ("o_tpsn_raw", """SELECT w.agency_id, ag.agency_name, rt.route_short_name, rt.route_long_name, dir.direction_label AS direction_name,
 tr.direction_id, hs.headsign_id AS trip_headsign_id, hs.headsign AS trip_headsign, x.stop_id,
 dense_rank() OVER (PARTITION BY w.timed_pattern_id ORDER BY x.stop_sequence NULLS LAST) AS stop_order,
 w.timed_pattern_id, w.pattern_id, x.arrival_time - w.min_arrival_time AS arrival_time,
 x.departure_time - w.min_departure_time AS departure_time,
 coalesce(x.pickup_type, 0) AS pickup_type, coalesce(x.drop_off_type, 0) AS drop_off_type,
 w.one_trip, w.member_trips, w.stops_pattern, w.arrival_time_intervals, w.departure_time_intervals, tr.route_id,
 x.headsign_id AS stop_headsign_id
 FROM o_wide_keys w
 JOIN o_stop_times x ON x.trip_id = w.one_trip
 JOIN src_agency ag ON ag.agency_id = x.agency_id
 JOIN src_trips tr ON tr.trip_id = x.trip_id
 JOIN src_routes rt ON rt.route_id = tr.route_id
 LEFT JOIN src_directions dir ON dir.direction_id = tr.direction_id
 LEFT JOIN src_headsigns hs ON hs.headsign_id = tr.headsign_id"""),
    ("o_bad_patterns", """SELECT DISTINCT w.pattern_id FROM o_tpsn_raw w
 WHERE w.stop_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM src_stops sp WHERE sp.stop_id = w.stop_id)"""),
    ("o_tpsn", """SELECT w.* FROM o_tpsn_raw w WHERE NOT EXISTS (SELECT 1 FROM o_bad_patterns b WHERE b.pattern_id = w.pattern_id)"""),
    ("o_one_headsign", """SELECT pattern_id, min(lo) AS headsign_id FROM (
   SELECT pattern_id, agency_id, route_id, direction_id, min(trip_headsign_id) AS lo, max(trip_headsign_id) AS hi
   FROM o_tpsn WHERE trip_headsign_id IS NOT NULL GROUP BY pattern_id, agency_id, route_id, direction_id) q
 WHERE lo = hi GROUP BY pattern_id"""),
    ("o_patterns_base", """SELECT p.agency_id, p.pattern_id, p.route_id, p.direction_id, h.headsign_id
 FROM (SELECT DISTINCT agency_id, pattern_id, route_id, direction_id FROM o_tpsn) p
 LEFT JOIN o_one_headsign h ON h.pattern_id = p.pattern_id"""),
    ("o_pattern_stops", f"""SELECT DISTINCT agency_id, pattern_id, stop_order, stop_id FROM o_tpsn
 WHERE agency_id IN {DST_AGENCY_IDS}"""),
    ("o_timed_patterns", "SELECT DISTINCT agency_id, timed_pattern_id, pattern_id FROM o_tpsn"),
    ("o_timed_pattern_stops", """SELECT DISTINCT agency_id, timed_pattern_id, stop_order, stop_id, arrival_time, departure_time,
 pickup_type, drop_off_type, stop_headsign_id AS headsign_id FROM o_tpsn"""),
    ("o_directions", f"""SELECT agency_id, direction_id, name FROM (
   SELECT agency_id, direction_id, direction_name AS name,
     row_number() OVER (PARTITION BY direction_id ORDER BY agency_id NULLS LAST, direction_name NULLS LAST) AS pos
   FROM o_tpsn WHERE agency_id IN {DST_AGENCY_IDS}) q WHERE pos = 1"""),
    # ---- trips
    ("o_first_rows", f"""SELECT x.trip_id, x.stop_sequence, x.arrival_time FROM src_stop_times x
 WHERE x.agency_id IN {DST_AGENCY_IDS} AND x.trip_id <> 0
 AND EXISTS (SELECT 1 FROM src_trips tr WHERE tr.trip_id = x.trip_id)
 AND x.stop_sequence = (SELECT min(y.stop_sequence) FROM src_stop_times y
                        WHERE y.trip_id = x.trip_id AND y.agency_id IN {DST_AGENCY_IDS})"""),
    ("o_first_arrivals", "SELECT trip_id, arrival_time AS first_arrival_time FROM o_first_rows"),
    ("o_patterns_trips", f"""SELECT DISTINCT timed_pattern_id, agency_id, trip_id FROM (
   SELECT timed_pattern_id, agency_id, unnest(member_trips) AS trip_id FROM (
     SELECT DISTINCT timed_pattern_id, agency_id, member_trips FROM o_tpsn WHERE agency_id IN {DST_AGENCY_IDS}) a) b"""),
    ("o_trips_sched", f"""SELECT {TRIP_ORDER} FROM (
   SELECT DISTINCT tr.trip_id AS trip_key, c.calendar_id AS cal_key, tr.in_seat_transfer AS ist_key,
     tr.agency_id, pt.timed_pattern_id, c.service_schedule_group_id AS calendar_id, fa.first_arrival_time AS start_time,
     CAST(NULL AS BIGINT) AS end_time, CAST(NULL AS INTEGER) AS headway_secs, tr.block_id, {WEEKDAY_BOOLS},
     tr.in_seat_transfer = 1 AS in_seat_transfer
   FROM src_trips tr JOIN src_calendar c ON c.calendar_id = tr.service_id
   JOIN o_first_arrivals fa ON fa.trip_id = tr.trip_id JOIN o_patterns_trips pt ON pt.trip_id = tr.trip_id
   WHERE tr.based_on IS NULL AND fa.first_arrival_time IS NOT NULL AND c.service_schedule_group_id IS NOT NULL
   AND tr.agency_id IN {DST_AGENCY_IDS}
   AND NOT EXISTS (SELECT 1 FROM src_frequencies f WHERE f.trip_id = tr.trip_id)) d"""),
    ("o_trips_based_on", f"""SELECT {TRIP_ORDER} FROM (
   SELECT DISTINCT par.trip_id AS parent_key, c.calendar_id AS cal_key, kid.in_seat_transfer AS ist_key,
     kid.agency_id, pt.timed_pattern_id, c.service_schedule_group_id AS calendar_id,
     coalesce(kid.trip_start_time, par.trip_start_time) AS start_time,
     CAST(NULL AS BIGINT) AS end_time, CAST(NULL AS INTEGER) AS headway_secs, kid.block_id, {WEEKDAY_BOOLS},
     par.in_seat_transfer = 1 AS in_seat_transfer
   FROM src_trips kid JOIN src_trips par ON par.trip_id = kid.based_on
   JOIN o_patterns_trips pt ON pt.trip_id = par.trip_id JOIN src_calendar c ON c.calendar_id = kid.service_id
   WHERE coalesce(kid.trip_start_time, par.trip_start_time) IS NOT NULL AND c.service_schedule_group_id IS NOT NULL
   AND par.agency_id IN {DST_AGENCY_IDS}
   AND NOT EXISTS (SELECT 1 FROM src_frequencies f WHERE f.trip_id = par.trip_id)) d"""),
    ("o_trips_freq_based_on", f"""SELECT kid.agency_id, pt.timed_pattern_id, c.service_schedule_group_id AS calendar_id,
 CAST(f.start_time AS BIGINT) AS start_time, CAST(f.end_time AS BIGINT) AS end_time, CAST(f.headway_secs AS INTEGER) AS headway_secs,
 kid.block_id, {WEEKDAY_BOOLS}, kid.in_seat_transfer = 1 AS in_seat_transfer
 FROM src_frequencies f JOIN src_trips kid ON kid.trip_id = f.trip_id JOIN src_trips par ON par.trip_id = kid.based_on
 JOIN o_patterns_trips pt ON pt.trip_id = par.trip_id JOIN src_calendar c ON c.calendar_id = kid.service_id
 WHERE par.agency_id IN {DST_AGENCY_IDS}"""),
    ("o_trips_freq", f"""SELECT tr.agency_id, pt.timed_pattern_id, c.service_schedule_group_id AS calendar_id,
 CAST(f.start_time AS BIGINT) AS start_time, CAST(f.end_time AS BIGINT) AS end_time, CAST(f.headway_secs AS INTEGER) AS headway_secs,
 tr.block_id, {WEEKDAY_BOOLS}, tr.in_seat_transfer = 1 AS in_seat_transfer
 FROM src_frequencies f JOIN src_trips tr ON tr.trip_id = f.trip_id JOIN o_patterns_trips pt ON pt.trip_id = tr.trip_id
 JOIN src_calendar c ON c.calendar_id = tr.service_id
 WHERE tr.based_on IS NULL AND tr.agency_id IN {DST_AGENCY_IDS}"""),
    ("o_trips", f"""SELECT row_number() OVER (ORDER BY trip_source, {_nl(TRIP_ORDER)}) AS trip_id, * FROM (
 SELECT 1 AS trip_source, * FROM o_trips_sched UNION ALL SELECT 2, * FROM o_trips_based_on
 UNION ALL SELECT 3, * FROM o_trips_freq_based_on UNION ALL SELECT 4, * FROM o_trips_freq) u"""),
    # ---- naming
    ("o_counts", """SELECT p.route_id, p.direction_id, p.pattern_id,
 CAST(sum(CASE WHEN tr.headway_secs IS NOT NULL AND tr.end_time IS NOT NULL
               THEN CAST(floor((tr.end_time - tr.start_time) / tr.headway_secs + 1) AS BIGINT) ELSE 1 END) AS BIGINT) AS num_trips
 FROM o_trips tr JOIN o_timed_patterns tp ON tp.timed_pattern_id = tr.timed_pattern_id
 JOIN o_patterns_base p ON p.pattern_id = tp.pattern_id
 GROUP BY p.route_id, p.direction_id, p.pattern_id"""),
    ("o_primary", """SELECT route_id, direction_id, pattern_id AS primary_pattern_id FROM (
   SELECT route_id, direction_id, pattern_id,
     row_number() OVER (PARTITION BY route_id, direction_id ORDER BY num_trips DESC, pattern_id) AS pos
   FROM o_counts) q WHERE pos = 1"""),
    ("o_stop_sets", "SELECT pattern_id, list(stop_id ORDER BY stop_id) AS stops FROM o_pattern_stops GROUP BY pattern_id"),
    ("o_diff_lists", """SELECT p.route_id, p.pattern_id, pr.primary_pattern_id, mine.stops AS stops_mine,
 list_sort(list_distinct(list_filter(mine.stops, lambda v: NOT list_contains(theirs.stops, v)))) AS plus_l,
 list_sort(list_distinct(list_filter(theirs.stops, lambda v: NOT list_contains(mine.stops, v)))) AS minus_l
 FROM o_patterns_base p JOIN o_primary pr ON pr.route_id = p.route_id AND pr.direction_id = p.direction_id
 JOIN o_stop_sets mine ON mine.pattern_id = p.pattern_id JOIN o_stop_sets theirs ON theirs.pattern_id = pr.primary_pattern_id"""),
    ("o_diff", """SELECT route_id, pattern_id, primary_pattern_id, CAST(len(stops_mine) AS BIGINT) AS n_stops,
 CAST(len(plus_l) AS BIGINT) AS n_added_stops, CAST(len(minus_l) AS BIGINT) AS n_removed_stops,
 CASE WHEN len(plus_l) > 0 THEN plus_l END AS added_stop_ids,
 CASE WHEN len(minus_l) > 0 THEN minus_l END AS removed_stop_ids
 FROM o_diff_lists"""),
    # a pattern that several agencies share has one row
    ("o_diff_one", "SELECT DISTINCT ON (pattern_id) * FROM o_diff ORDER BY pattern_id, route_id, primary_pattern_id"),
    ("o_plus_names", """SELECT d.pattern_id, string_agg(sp.name, ' + ' ORDER BY sp.stop_id) AS nm
 FROM o_diff_one d JOIN o_stops sp ON list_contains(d.added_stop_ids, sp.stop_id)
 WHERE d.n_added_stops BETWEEN 1 AND 3 GROUP BY d.pattern_id"""),
    ("o_minus_names", """SELECT d.pattern_id, string_agg(sp.name, ' - ' ORDER BY sp.stop_id) AS nm
 FROM o_diff_one d JOIN o_stops sp ON list_contains(d.removed_stop_ids, sp.stop_id)
 WHERE d.n_removed_stops BETWEEN 1 AND 3 GROUP BY d.pattern_id"""),
    ("o_names", """SELECT d.route_id, d.pattern_id, d.primary_pattern_id,
 CASE WHEN d.pattern_id = d.primary_pattern_id THEN 'Primary'
 ELSE (CASE WHEN d.n_added_stops BETWEEN 1 AND 3 THEN '+ ' || pn.nm
            ELSE '+ ' || CAST(d.n_added_stops AS VARCHAR) || ' stops' END)
   || (CASE WHEN d.n_removed_stops BETWEEN 1 AND 3 THEN ' - ' || mn.nm
            ELSE ' - ' || CAST(d.n_removed_stops AS VARCHAR) || ' stops' END) END AS generated_name
 FROM o_diff_one d LEFT JOIN o_plus_names pn ON pn.pattern_id = d.pattern_id
 LEFT JOIN o_minus_names mn ON mn.pattern_id = d.pattern_id"""),
    ("o_patterns", """SELECT p.*, n.generated_name AS name FROM o_patterns_base p
 LEFT JOIN o_names n ON n.pattern_id = p.pattern_id"""),
    ("o_unordered", """SELECT agency_id, CAST(count(DISTINCT route_sort_order) AS BIGINT) AS n_sort_orders,
 CAST(count(route_id) AS BIGINT) AS n_routes FROM o_routes GROUP BY agency_id
 HAVING count(DISTINCT route_sort_order) <> count(route_id)"""),
    ("o_routes_ordered", """SELECT r.* REPLACE (coalesce(alpha.pos, r.route_sort_order) AS route_sort_order)
 FROM o_routes r LEFT JOIN (
   SELECT route_id, row_number() OVER (PARTITION BY agency_id
     ORDER BY route_long_name NULLS LAST, route_short_name NULLS LAST, route_id) AS pos
   FROM o_routes WHERE agency_id IN (SELECT agency_id FROM o_unordered)) alpha ON alpha.route_id = r.route_id"""),
    # ---- fares
    ("o_fare_rules", f"""SELECT fare_rule_id, fare_id, route_id, origin_id, destination_id, contains_id, agency_id,
 CASE WHEN agency_id IN (42, 175) THEN false
      WHEN agency_id = 19 AND (origin_id IS NOT NULL OR destination_id IS NOT NULL) THEN false ELSE true END AS is_combinable,
 last_modified, fare_id_import, route_id_import, origin_id_import, destination_id_import, contains_id_import
 FROM (SELECT *, max(fare_rule_id) OVER (PARTITION BY agency_id, fare_id, route_id, origin_id, destination_id, contains_id) AS newest
       FROM src_fare_rules) r
 WHERE fare_rule_id = newest AND agency_id IN {DST_AGENCY_IDS}
 AND (origin_id IS NULL OR EXISTS (SELECT 1 FROM o_zones z WHERE z.zone_id = r.origin_id))
 AND (destination_id IS NULL OR EXISTS (SELECT 1 FROM o_zones z WHERE z.zone_id = r.destination_id))
 AND (contains_id IS NULL OR EXISTS (SELECT 1 FROM o_zones z WHERE z.zone_id = r.contains_id))"""),
    ("o_rule_keys", """SELECT r.*, coalesce(r.origin_id, -411) AS ko, coalesce(r.destination_id, -411) AS kd,
 coalesce(r.route_id, -411) AS kr, coalesce(r.contains_id, -411) AS kc FROM o_fare_rules r"""),
    ("o_sym", """SELECT DISTINCT lo.agency_id, lo.fare_id, lo.origin_id AS zone_id_a, lo.destination_id AS zone_id_b, lo.route_id,
 lo.contains_id, lo.is_combinable, greatest(lo.last_modified, hi.last_modified) AS last_modified
 FROM o_rule_keys lo JOIN o_rule_keys hi
 ON hi.agency_id = lo.agency_id AND hi.fare_id = lo.fare_id AND hi.kr = lo.kr AND hi.kc = lo.kc
 AND hi.ko = lo.kd AND hi.kd = lo.ko
 WHERE lo.ko < lo.kd"""),
    ("o_asym", """SELECT r.fare_rule_id, r.fare_id, r.route_id, r.origin_id, r.destination_id, r.contains_id, r.agency_id,
 r.is_combinable, r.last_modified, fare_id_import, route_id_import, origin_id_import, destination_id_import, contains_id_import FROM o_rule_keys r
 WHERE NOT EXISTS (SELECT 1 FROM o_sym s WHERE s.agency_id = r.agency_id AND s.fare_id = r.fare_id
   AND coalesce(s.route_id, -411) = r.kr AND coalesce(s.contains_id, -411) = r.kc
   AND coalesce(s.zone_id_a, -411) = least(r.ko, r.kd) AND coalesce(s.zone_id_b, -411) = greatest(r.ko, r.kd))"""),
    ("o_edits", """SELECT * FROM (
 SELECT fare_rule_id AS seq,
   CASE CAST(FLOOR(fare_rule_id / 10) AS BIGINT) % 5 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' END AS op,
   fare_id, agency_id, route_id, contains_id, is_combinable, origin_id AS old_a, destination_id AS old_b,
   origin_id AS new_a,
   CASE WHEN CAST(FLOOR(fare_rule_id / 10) AS BIGINT) % 5 = 1 THEN destination_id + 1 ELSE destination_id END AS new_b
 FROM o_fare_rules WHERE fare_rule_id % 10 = 0) e
 WHERE op IS NOT NULL AND NOT (op <> 'DELETE' AND COALESCE(new_a, -411) = COALESCE(new_b, -411))"""),
    ("o_touch", """SELECT seq, 0 AS step, false AS ins, fare_id, agency_id, route_id, contains_id, is_combinable, new_a, new_b,
   COALESCE(route_id, -411) AS kr, LEAST(COALESCE(old_a, -411), COALESCE(old_b, -411)) AS klo,
   GREATEST(COALESCE(old_a, -411), COALESCE(old_b, -411)) AS khi, COALESCE(contains_id, -411) AS kc
 FROM o_edits WHERE op IN ('DELETE', 'UPDATE')
 UNION ALL
 SELECT seq, 1, true, fare_id, agency_id, route_id, contains_id, is_combinable, new_a, new_b,
   COALESCE(route_id, -411), LEAST(COALESCE(new_a, -411), COALESCE(new_b, -411)),
   GREATEST(COALESCE(new_a, -411), COALESCE(new_b, -411)), COALESCE(contains_id, -411)
 FROM o_edits WHERE op IN ('INSERT', 'UPDATE')"""),
    ("o_last_touch", """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY fare_id, agency_id, kr, klo, khi, kc
   ORDER BY seq DESC, step DESC) AS rn FROM o_touch) x WHERE rn = 1"""),
    ("o_fare_edits_applied", """SELECT fare_rule_id, fare_id, route_id, origin_id, destination_id, contains_id, agency_id, is_combinable, last_modified, fare_id_import, route_id_import, origin_id_import, destination_id_import, contains_id_import
 FROM o_fare_rules fr WHERE NOT EXISTS (SELECT 1 FROM o_last_touch l WHERE l.fare_id = fr.fare_id AND l.agency_id = fr.agency_id
   AND l.kr = COALESCE(fr.route_id, -411) AND l.kc = COALESCE(fr.contains_id, -411)
   AND l.klo = LEAST(COALESCE(fr.origin_id, -411), COALESCE(fr.destination_id, -411))
   AND l.khi = GREATEST(COALESCE(fr.origin_id, -411), COALESCE(fr.destination_id, -411)))
 UNION ALL
 SELECT (SELECT COALESCE(MAX(fare_rule_id), 0) FROM o_fare_rules) + ROW_NUMBER() OVER (ORDER BY seq, dir) AS fare_rule_id,
   fare_id, route_id, o AS origin_id, d AS destination_id, contains_id, agency_id, is_combinable, DATE '2024-01-01' AS last_modified,
   NULL, NULL, NULL, NULL, NULL
 FROM (SELECT seq, 0 AS dir, new_a AS o, new_b AS d, * FROM o_last_touch WHERE ins
       UNION ALL SELECT seq, 1, new_b, new_a, * FROM o_last_touch WHERE ins) p"""),
    # ---- shapes
    ("o_shape_pts", """SELECT seg.start_coordinate_id AS from_stop_id, seg.end_coordinate_id AS to_stop_id, pt.shape_pt_sequence,
 pt.lon, pt.lat
 FROM (SELECT *, max(shape_segment_id) OVER (PARTITION BY start_coordinate_id, end_coordinate_id) AS newest
       FROM src_shape_segments) seg
 JOIN src_shape_points pt ON pt.shape_segment_id = seg.shape_segment_id
 WHERE seg.shape_segment_id = seg.newest
 AND EXISTS (SELECT 1 FROM o_stops a WHERE a.stop_id = seg.start_coordinate_id)
 AND EXISTS (SELECT 1 FROM o_stops b WHERE b.stop_id = seg.end_coordinate_id)"""),
]

_CTE_NAMES = [n for n, _ in CTES]
_CTE_BODY = dict(CTES)

# Lambert's ellipsoidal distance, in SQL (mirrors functions/geo.py's formula).
_LAMBERT = """(CASE WHEN sig = 0 THEN 0.0 ELSE 6378137.0 * (sig - (1.0 / 298.257223563) / 2 * (
   (sig - sin(sig)) * pow(sin(p) * cos(q), 2) / pow(cos(sig / 2), 2)
 + (sig + sin(sig)) * pow(cos(p) * sin(q), 2) / pow(sin(sig / 2), 2))) END)"""


# Fixed values, stated apart from the job: keys (rule on delete, child, column, parent, column) and unique tuples.
_KEYS = """
restrict calendar_bounds agency_id agencies agency_id
cascade calendar_bounds calendar_id calendars calendar_id
restrict calendar_date_service_exceptions agency_id agencies agency_id
cascade calendar_date_service_exceptions calendar_date_id calendar_dates calendar_date_id
cascade calendar_date_service_exceptions calendar_id calendars calendar_id
restrict calendar_dates agency_id agencies agency_id
restrict calendars agency_id agencies agency_id
restrict directions agency_id agencies agency_id
restrict fare_attributes agency_id agencies agency_id
restrict fare_rider_categories agency_id agencies agency_id
cascade fare_rider_categories fare_id fare_attributes fare_id
restrict fare_rules agency_id agencies agency_id
cascade fare_rules fare_id fare_attributes fare_id
cascade fare_rules contains_id zones zone_id
cascade fare_rules origin_id zones zone_id
cascade fare_rules destination_id zones zone_id
restrict headsigns agency_id agencies agency_id
cascade pattern_stops pattern_id patterns pattern_id
restrict pattern_stops stop_id stops stop_id
"""
_UNIQUE = """
feeds feed_id
agencies agency_id
zones zone_id
stops stop_id
routes route_id
headsigns headsign_id
directions direction_id
calendars calendar_id
calendar_dates calendar_date_id
blocks block_id
fare_attributes fare_id
fare_rules fare_rule_id
fare_rules agency_id fare_id route_id origin_id destination_id contains_id
users user_id
transfers transfer_id
patterns pattern_id
timed_patterns timed_pattern_id
shape_segments from_stop_id to_stop_id
trips trip_id
"""


def _fk_sql() -> str:
    parts = []
    for line in _KEYS.strip().splitlines():
        _, child, col, parent, pcol = line.split()
        parts.append(
            f"SELECT '{child}.{col} -> {parent}.{pcol}' AS constraint_name, CAST(COUNT(*) AS BIGINT) AS orphan_rows "
            f"FROM {_TABLE_CTE[child]} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_TABLE_CTE[parent]} p WHERE CAST(p.{pcol} AS BIGINT) = CAST(c.{col} AS BIGINT))")
    return "\nUNION ALL ".join(parts)


def _key_sql() -> str:
    parts = []
    for line in _UNIQUE.strip().splitlines():
        table, *cols = line.split()
        cl = ", ".join(cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        parts.append(
            f"SELECT '{table}' AS table_name, '{','.join(cols)}' AS key_columns, CAST(COUNT(*) AS BIGINT) AS duplicate_keys, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows_in_duplicates FROM (SELECT {cl}, COUNT(*) AS n "
            f"FROM {_TABLE_CTE[table]} WHERE {nn} GROUP BY {cl} HAVING COUNT(*) > 1) d")
    return "\nUNION ALL ".join(parts)


def _css_valid(expr: str) -> str:
    names = ", ".join(f"'{n}'" for n in CSS_COLOR_NAMES)
    return f"(regexp_full_match(lower({expr}), '[0-9a-f]{{6}}') OR lower({expr}) IN ({names}))"


# Fixed values, stated apart from the job: required columns, and columns with their longest text.
_WEEK = "monday tuesday wednesday thursday friday saturday sunday"
_REQUIRED = f"""
agencies: agency_id agency_url agency_timezone agency_name agency_short_name last_modified no_frequencies
blocks: agency_id block_id name
calendar_bounds: agency_id calendar_id start_date end_date
calendar_date_service_exceptions: calendar_date_id calendar_id {_WEEK} agency_id last_modified
calendar_dates: date
calendars: agency_id calendar_id name
directions: direction_id name
fare_attributes: fare_id price currency_type last_modified
fare_rider_categories: fare_rider_category_id
fare_rules: fare_rule_id is_combinable last_modified
feeds: feed_id name
headsigns: headsign_id headsign
pattern_stops: agency_id pattern_id stop_order stop_id
patterns: agency_id pattern_id route_id
routes: agency_id route_id route_short_name route_long_name route_id_import last_modified
shape_segments: from_stop_id to_stop_id
stops: stop_id location_type enabled
timed_pattern_stops: stop_order pickup_type drop_off_type
timed_patterns: agency_id timed_pattern_id pattern_id
trips: timed_pattern_id calendar_id agency_id start_time {_WEEK}
"""
_LONGEST = """
agencies: agency_id_import 100 agency_url 255 agency_timezone 45 agency_name 120 agency_short_name 10 agency_phone 70 agency_fare_url 255 agency_info 255
calendars: name 2044
directions: name 35
fare_attributes: currency_type 3
feeds: name 2044 contact_email 2044 contact_url 2044 license 2044
headsigns: headsign 105
routes: route_short_name 30 route_long_name 220 route_url 300 route_id_import 100
stops: stop_code 2044 stop_desc 2044 stop_comments 2044 platform_code 2044 city 2044 url 2044 timezone 2044
"""


def _check_sql() -> str:
    parts = []
    for line in _REQUIRED.strip().splitlines():
        table, cols = line.split(": ")
        for c in cols.split():
            parts.append(f"SELECT '{table}.{c} not null' AS rule, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS violations FROM {_TABLE_CTE[table]}")
    for line in _LONGEST.strip().splitlines():
        table, rest = line.split(": ")
        words = rest.split()
        for c, n in zip(words[::2], words[1::2]):
            parts.append(f"SELECT '{table}.{c} length <= {n}', CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) FROM {_TABLE_CTE[table]}")
    parts.append("SELECT 'blocks.color is_valid_css_color', CAST(COUNT(*) FILTER (WHERE color IS NOT NULL AND NOT "
                 + _css_valid("color") + ") AS BIGINT) FROM o_blocks")
    return "\nUNION ALL ".join(parts)


_TABLE_CTE = {
    "feeds": "o_feeds", "agencies": "o_agencies", "zones": "o_zones", "stops": "o_stops", "routes": "o_routes_ordered",
    "headsigns": "o_headsigns", "directions": "o_directions", "calendars": "o_calendars",
    "calendar_bounds": "o_calendar_bounds", "calendar_dates": "o_calendar_dates",
    "calendar_date_service_exceptions": "o_service_exceptions", "blocks": "o_blocks",
    "fare_attributes": "o_fare_attributes", "fare_rider_categories": "o_rider_intent", "transfers": "o_transfers",
    "users": "o_users", "patterns": "o_patterns", "pattern_stops": "o_pattern_stops",
    "timed_patterns": "o_timed_patterns", "fare_rules": "o_fare_rules", "shape_segments": "o_shape_lines",
    "trips": "o_trips", "timed_pattern_stops": "o_timed_pattern_stops",
}

CTES += [
    ("o_ps_summary", """SELECT ps.pattern_id, count(*) AS n, min(ps.stop_order) AS lo, max(ps.stop_order) AS hi
 FROM o_pattern_stops ps WHERE ps.pattern_id IN (SELECT pattern_id FROM o_patterns_base) GROUP BY ps.pattern_id"""),
    ("o_rider_intent", f"""SELECT fare_rider_category_id, fare_id, rider_category_custom_id, CAST(price AS DOUBLE) AS price, agency_id
 FROM src_fare_rider_categories WHERE agency_id IN {DST_AGENCY_IDS} AND fare_id IN (SELECT fare_id FROM o_fare_attributes)"""),
    ("o_shape_lines", """SELECT from_stop_id, to_stop_id, CAST(COUNT(*) AS BIGINT) AS n_points,
 'LINESTRING(' || string_agg(printf('%.6f %.6f', lon, lat), ', ' ORDER BY shape_pt_sequence) || ')' AS linestring
 FROM o_shape_pts GROUP BY from_stop_id, to_stop_id"""),
]
_CTE_NAMES = [n for n, _ in CTES]
_CTE_BODY = dict(CTES)

FINAL: dict[str, str] = {
    "feeds": "SELECT * FROM o_feeds",
    "agencies": "SELECT * FROM o_agencies",
    "zones": "SELECT * FROM o_zones",
    "stops": "SELECT * EXCLUDE (agency_id) FROM o_stops",
    "routes": "SELECT * FROM o_routes",
    "headsigns": "SELECT * FROM o_headsigns",
    "directions": "SELECT * FROM o_directions",
    "calendars": "SELECT * FROM o_calendars",
    "calendar_bounds": "SELECT * FROM o_calendar_bounds",
    "calendar_dates": "SELECT * FROM o_calendar_dates",
    "service_exceptions_intent": "SELECT * FROM o_service_exceptions",
    "service_exceptions_literal": "SELECT * FROM o_service_exceptions_literal",
    "blocks_colored": "SELECT * FROM o_blocks",
    "fare_attributes": "SELECT * FROM o_fare_attributes",
    "rider_categories_intent": "SELECT * FROM o_rider_intent",
    "rider_categories_literal": f"""SELECT fare_rider_category_id, fare_id, rider_category_custom_id, CAST(price AS DOUBLE) AS price, agency_id
 FROM src_fare_rider_categories WHERE agency_id IN {DST_AGENCY_IDS} AND fare_id IN (SELECT agency_id FROM o_fare_attributes)""",
    "transfers": "SELECT * FROM o_transfers",
    "users": "SELECT * FROM o_users",
    "user_permissions": "SELECT * FROM o_user_permissions",
    "timed_pattern_groups": """SELECT stops_pattern, arrival_time_intervals, departure_time_intervals, agency_id, route_id,
 direction_id, one_trip, trip_count FROM o_pattern_groups""",
    "tpsn": """SELECT agency_id, agency_name, route_short_name, route_long_name, direction_name, direction_id, trip_headsign_id,
 trip_headsign, stop_id, CAST(stop_order AS BIGINT) AS stop_order, timed_pattern_id, pattern_id, arrival_time, departure_time,
 pickup_type, drop_off_type, one_trip, stops_pattern, arrival_time_intervals, departure_time_intervals, route_id, stop_headsign_id
 FROM o_tpsn""",
    "patterns_with_headsign": "SELECT * FROM o_patterns_base",
    "pattern_stops": "SELECT agency_id, pattern_id, CAST(stop_order AS BIGINT) AS stop_order, stop_id FROM o_pattern_stops",
    "timed_patterns": "SELECT * FROM o_timed_patterns",
    "timed_pattern_stops": """SELECT agency_id, timed_pattern_id, CAST(stop_order AS BIGINT) AS stop_order, stop_id, arrival_time,
 departure_time, pickup_type, drop_off_type, headsign_id FROM o_timed_pattern_stops""",
    "multi_route_patterns": """SELECT pattern_id, CAST(COUNT(DISTINCT agency_id) AS BIGINT) AS agency_count,
 CAST(COUNT(DISTINCT route_id) AS BIGINT) AS route_count, CAST(COUNT(DISTINCT direction_id) AS BIGINT) AS direction_count
 FROM o_tpsn GROUP BY pattern_id""",
    "first_arrivals": "SELECT * FROM o_first_arrivals",
    "first_arrival_duplicates": """SELECT trip_id, CAST(COUNT(*) AS BIGINT) AS n_rows,
 string_agg(CAST(stop_sequence AS VARCHAR), ',' ORDER BY stop_sequence, arrival_time) AS stop_sequences,
 string_agg(CAST(arrival_time AS VARCHAR), ',' ORDER BY stop_sequence, arrival_time) AS arrival_times
 FROM o_first_rows GROUP BY trip_id HAVING COUNT(*) > 1""",
    "patterns_trips": "SELECT * FROM o_patterns_trips",
    "trips_scheduled": "SELECT * FROM o_trips_sched",
    "trips_based_on": "SELECT * FROM o_trips_based_on",
    "trips_freq_based_on": "SELECT * FROM o_trips_freq_based_on",
    "trips_freq": "SELECT * FROM o_trips_freq",
    "trips_all": "SELECT * FROM o_trips",
    "pattern_trip_counts": "SELECT * FROM o_counts",
    "primary_patterns": "SELECT * FROM o_primary",
    "pattern_stop_difference": """SELECT route_id, pattern_id, primary_pattern_id, n_stops, n_added_stops, n_removed_stops,
 array_to_string(added_stop_ids, ',') AS added_stop_ids, array_to_string(removed_stop_ids, ',') AS removed_stop_ids FROM o_diff""",
    "pattern_names": "SELECT * FROM o_patterns",
    "pattern_names_endpoints": """SELECT ends.pattern_id,
 head.stop_name || ' to ' || tail.stop_name || ' x' || CAST(ends.n AS VARCHAR) AS generated_name
 FROM o_ps_summary ends
 JOIN (SELECT pattern_id, stop_order, min(stop_id) AS stop_id FROM o_pattern_stops GROUP BY ALL) f ON f.pattern_id = ends.pattern_id AND f.stop_order = ends.lo
 JOIN (SELECT pattern_id, stop_order, min(stop_id) AS stop_id FROM o_pattern_stops GROUP BY ALL) l ON l.pattern_id = ends.pattern_id AND l.stop_order = ends.hi
 JOIN src_stops head ON head.stop_id = f.stop_id JOIN src_stops tail ON tail.stop_id = l.stop_id""",
    "unordered_agencies": "SELECT * FROM o_unordered",
    "routes_ordered": "SELECT * FROM o_routes_ordered",
    "fare_rules_golden": """SELECT agency_id, fare_id, route_id, origin_id, destination_id, contains_id,
 max(fare_rule_id) AS newest_fare_rule_id, min(fare_rule_id) AS oldest_fare_rule_id, CAST(count(*) AS BIGINT) AS n_rules
 FROM src_fare_rules GROUP BY agency_id, fare_id, route_id, origin_id, destination_id, contains_id""",
    "fare_rules": "SELECT * FROM o_fare_rules",
    "fares_symmetric": "SELECT * FROM o_sym",
    "fares_asymmetric": "SELECT * FROM o_asym",
    "fare_balance": """SELECT CAST((SELECT COUNT(*) FROM o_sym) AS BIGINT) AS n_symmetric,
 CAST((SELECT COUNT(*) FROM o_asym) AS BIGINT) AS n_asymmetric, CAST((SELECT COUNT(*) FROM o_fare_rules) AS BIGINT) AS n_rules,
 CAST((SELECT sum(c) FROM (SELECT -2 * COUNT(*) AS c FROM o_sym UNION ALL SELECT -COUNT(*) FROM o_asym
   UNION ALL SELECT COUNT(*) FROM o_fare_rules) x) AS BIGINT) AS residue""",
    "fare_edits_applied": "SELECT * FROM o_fare_edits_applied",
    "stop_timezones": """SELECT DISTINCT lon, lat, timezone AS tzid FROM o_stops""",
    "timezone_fallback": """SELECT s.stop_id, COALESCE(CASE WHEN length(s.stop_timezone) = 0 THEN NULL
   WHEN s.stop_timezone = 'US/Eastern' THEN 'America/New_York' ELSE s.stop_timezone END, a.agency_timezone) AS timezone
 FROM src_stops s LEFT JOIN src_agency a ON s.agency_id = a.agency_id""",
    "shape_segments": "SELECT * FROM o_shape_lines",
    "shape_points_dump": """SELECT from_stop_id, to_stop_id,
 CAST(ROW_NUMBER() OVER (PARTITION BY from_stop_id, to_stop_id ORDER BY shape_pt_sequence) AS BIGINT) AS path, lon, lat
 FROM o_shape_pts""",
    "shape_length_miles": f"""SELECT from_stop_id, to_stop_id, ROUND(COALESCE(SUM(leg), 0) * 0.000621371192237, 2) AS length_miles FROM (
 SELECT from_stop_id, to_stop_id, {_LAMBERT} AS leg FROM (
  SELECT *, 2 * asin(sqrt(least(1.0, pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(dl / 2), 2)))) AS sig,
         (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q FROM (
   SELECT from_stop_id, to_stop_id,
     atan((1 - 1.0 / 298.257223563) * tan(radians(lag(lat) OVER w))) AS b1,
     atan((1 - 1.0 / 298.257223563) * tan(radians(lat))) AS b2,
     radians(lon - lag(lon) OVER w) AS dl
   FROM o_shape_pts WINDOW w AS (PARTITION BY from_stop_id, to_stop_id ORDER BY shape_pt_sequence)) a
  WHERE b1 IS NOT NULL) b
 UNION ALL SELECT DISTINCT from_stop_id, to_stop_id, 0.0 FROM o_shape_pts) c GROUP BY from_stop_id, to_stop_id""",
    "null_timezones": """SELECT CAST(COUNT(*) AS BIGINT) AS n_stops,
 CAST(COUNT(*) FILTER (WHERE timezone IS NULL) AS BIGINT) AS n_null_timezone FROM o_stops""",
    "fk_audit": None,  # built below
    "key_audit": None,
    "check_audit": None,
    "frequency_parity": """SELECT COALESCE(s.route_id, t.route_id) AS route_id, COALESCE(s.n_source, 0) AS n_source,
 COALESCE(t.n_target, 0) AS n_target FROM
 (SELECT route_id, CAST(COUNT(*) AS BIGINT) AS n_source FROM src_frequencies f JOIN src_trips USING (trip_id) GROUP BY route_id) s
 FULL JOIN
 (SELECT p.route_id, CAST(COUNT(*) AS BIGINT) AS n_target FROM o_trips tr JOIN o_timed_patterns tp USING (timed_pattern_id)
  JOIN o_patterns_base p ON p.pattern_id = tp.pattern_id WHERE tr.headway_secs IS NOT NULL GROUP BY p.route_id) t
 ON s.route_id = t.route_id""",
    "based_on_missing_start": f"""SELECT kid.trip_id AS b_trip_id, par.trip_id AS base_trip_id, kid.agency_id, pt.timed_pattern_id,
 c.service_schedule_group_id AS calendar_id
 FROM src_trips kid JOIN src_trips par ON par.trip_id = kid.based_on
 JOIN o_patterns_trips pt ON pt.trip_id = par.trip_id JOIN src_calendar c ON c.calendar_id = kid.service_id
 WHERE coalesce(kid.trip_start_time, par.trip_start_time) IS NULL AND par.agency_id IN {DST_AGENCY_IDS}
 AND NOT EXISTS (SELECT 1 FROM src_frequencies f WHERE f.trip_id = par.trip_id)""",
    "trip_chain_counts": """SELECT 1 AS stage_order, 'trips' AS stage, CAST(COUNT(*) AS BIGINT) AS n_rows FROM src_trips
 UNION ALL SELECT 2, 'with calendar', CAST(COUNT(*) AS BIGINT) FROM src_trips t JOIN src_calendar c ON t.service_id = c.calendar_id
 UNION ALL SELECT 3, 'with first arrival', CAST(COUNT(*) AS BIGINT) FROM src_trips t JOIN src_calendar c ON t.service_id = c.calendar_id
   JOIN o_first_arrivals fa ON fa.trip_id = t.trip_id
 UNION ALL SELECT 4, 'with timed pattern', CAST(COUNT(*) AS BIGINT) FROM src_trips t JOIN src_calendar c ON t.service_id = c.calendar_id
   JOIN o_first_arrivals fa ON fa.trip_id = t.trip_id JOIN o_patterns_trips pt ON pt.trip_id = t.trip_id""",
    "css_color_valid": f"SELECT route_id, route_color, {_css_valid('route_color')} AS is_valid FROM src_routes",
    "high_water_marks": """SELECT 'zones' AS table_name, CAST(COALESCE(MAX(zone_id), 0) + 1 AS BIGINT) AS next_id FROM o_zones
 UNION ALL SELECT 'stops', CAST(COALESCE(MAX(stop_id), 0) + 1 AS BIGINT) FROM o_stops
 UNION ALL SELECT 'patterns', CAST(COALESCE(MAX(pattern_id), 0) + 1 AS BIGINT) FROM o_patterns
 UNION ALL SELECT 'timed_patterns', CAST(COALESCE(MAX(timed_pattern_id), 0) + 1 AS BIGINT) FROM o_timed_patterns
 UNION ALL SELECT 'trips', CAST(COALESCE(MAX(trip_id), 0) + 1 AS BIGINT) FROM o_trips
 UNION ALL SELECT 'fare_rules', CAST(COALESCE(MAX(fare_rule_id), 0) + 1 AS BIGINT) FROM o_fare_rules
 UNION ALL SELECT 'blocks', CAST(COALESCE(MAX(block_id), 0) + 1 AS BIGINT) FROM o_blocks""",
}
_RING_EDGES = """SELECT tzid, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2,
   coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2
 FROM tz_polygons WINDOW w AS (PARTITION BY tzid, ring_id ORDER BY vertex_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
FINAL.update({
    "trips_legacy_union": """SELECT * FROM o_trips_sched UNION SELECT * FROM o_trips_based_on
 UNION SELECT * FROM o_trips_freq_based_on UNION SELECT * FROM o_trips_freq""",
    "tz_coverage": f"""SELECT ROUND((SELECT SUM(area_m2) FROM (
   SELECT tzid, abs(sum((radians(x2) - radians(x1)) * (2 + sin(radians(y1)) + sin(radians(y2))))) * 6378137.0 * 6378137.0 / 2 AS area_m2
   FROM ({_RING_EDGES}) e GROUP BY tzid) a) / 510072000000000.0, 9) AS fraction_covered,
 (SELECT CAST(COUNT(*) FILTER (WHERE timezone IS NULL) AS BIGINT) FROM o_stops) AS n_null_timezone""",
    "stop_feed_link": "SELECT s.stop_id, a.feed_id FROM src_stops s LEFT JOIN o_agencies a ON s.agency_id = a.agency_id",
    "orphan_prune": f"""SELECT * FROM (SELECT fare_rider_category_id, fare_id, rider_category_custom_id, CAST(price AS DOUBLE) AS price, agency_id
 FROM src_fare_rider_categories WHERE agency_id IN {DST_AGENCY_IDS} AND fare_id IN (SELECT agency_id FROM o_fare_attributes)) r
 WHERE r.fare_id IN (SELECT fare_id FROM o_fare_attributes) OR r.fare_id IS NULL""",
})
FINAL["scope_only_agency"] = """SELECT DISTINCT ag.agency_id, ag.agency_name, link.agency_group_id AS feed_id
 FROM src_agency ag JOIN src_agency_group_assoc link USING (agency_id)
 WHERE ag.agency_id = (SELECT agency_id FROM src_trips WHERE agency_id IN (SELECT agency_id FROM src_agency_group_assoc) GROUP BY agency_id
                       ORDER BY count(*) DESC, agency_id LIMIT 1)"""
FINAL["null_means_all"] = """SELECT fare_rule_id, coalesce(route_id, -411) AS route_id, coalesce(origin_id, -411) AS origin_id,
 coalesce(destination_id, -411) AS destination_id, coalesce(contains_id, -411) AS contains_id FROM src_fare_rules"""
# The keyed tables before any agency is left out, for the cascade.
_UNSCOPED = {
    "agencies": "SELECT agency_id FROM o_agencies", "zones": "SELECT zone_id, agency_id FROM o_zones",
    "patterns": "SELECT pattern_id FROM o_patterns_base", "stops": "SELECT stop_id, zone_id FROM o_stops",
    "pattern_stops": "SELECT pattern_id, stop_id FROM o_pattern_stops",
    "calendars": "SELECT agency_id, service_schedule_group_id AS calendar_id FROM src_service_schedule_groups",
    "calendar_bounds": "SELECT agency_id, service_schedule_group_id AS calendar_id FROM src_service_schedule_bounds",
    "calendar_dates": "SELECT calendar_date_id, agency_id FROM src_calendar_dates",
    "calendar_date_service_exceptions": "SELECT calendar_date_id, service_exception AS calendar_id, agency_id FROM src_calendar_date_service_exceptions",
    "directions": "SELECT agency_id FROM o_directions", "headsigns": "SELECT agency_id FROM src_headsigns",
    "fare_attributes": "SELECT fare_id, agency_id FROM src_fare_attributes",
    "fare_rider_categories": "SELECT fare_id, agency_id FROM src_fare_rider_categories",
    "fare_rules": "SELECT fare_id, origin_id, destination_id, contains_id, agency_id FROM src_fare_rules",
}
_NAMED = {"calendars": "agency_id NOT IN (SELECT agency_id FROM o_agencies)", "calendar_dates": "agency_id NOT IN (SELECT agency_id FROM o_agencies)",
          "fare_attributes": "agency_id NOT IN (SELECT agency_id FROM o_agencies)",
          "zones": "agency_id <> -411 AND agency_id NOT IN (SELECT agency_id FROM o_agencies)", "stops": "zone_id IS NULL"}


def _cascade_sql() -> str:
    """Every row is a node, every key an edge to the parent's row; a recursive walk carries the chains down."""
    ctes, edges, nodes, restrict = [], [], [], []
    for t, body in _UNSCOPED.items():
        ctes.append(f"t_{t} AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM ({body}) b)")
        nodes.append(f"SELECT '{t}' AS tbl, rid FROM t_{t}")
    for line in _KEYS.strip().splitlines():
        rule, child, col, parent, pcol = line.split()
        edge = (f"SELECT '{child}' AS tbl, c.rid, '{child}.{col} -> {parent}.{pcol}: ' AS step, '{parent}' AS up, p.rid AS up_rid "
                f"FROM t_{child} c LEFT JOIN t_{parent} p ON p.{pcol} = c.{col} WHERE c.{col} IS NOT NULL")
        (edges if rule == "cascade" else restrict).append(edge)
    named = " UNION ALL ".join(f"SELECT '{t}' AS tbl, rid, 'deleted' AS chain FROM t_{t} WHERE {rule}" for t, rule in _NAMED.items())
    union = " UNION ALL ".join
    return "WITH RECURSIVE " + ",\n".join(ctes) + f""",
e AS MATERIALIZED ({union(edges)}), r AS MATERIALIZED ({union(restrict)}), n AS ({union(nodes)}),
gone AS (SELECT * FROM ({named}) x UNION SELECT tbl, rid, step || 'absent' FROM e WHERE up_rid IS NULL
 UNION SELECT e.tbl, e.rid, e.step || g.chain FROM e JOIN gone g ON g.tbl = e.up AND g.rid = e.up_rid),
why AS (SELECT tbl, rid, min(chain) AS chain FROM gone GROUP BY tbl, rid)
SELECT n.tbl AS table_name, CASE WHEN why.chain IS NULL THEN 'kept' WHEN why.chain = 'deleted' THEN 'deleted' ELSE 'cascade' END AS action,
 coalesce(why.chain, '') AS chain, CAST(count(*) AS BIGINT) AS n_rows
FROM n LEFT JOIN why ON why.tbl = n.tbl AND why.rid = n.rid GROUP BY ALL
UNION ALL
SELECT r.tbl, 'restrict', r.step || coalesce(up.chain, 'absent'), CAST(count(*) AS BIGINT)
FROM r LEFT JOIN why own ON own.tbl = r.tbl AND own.rid = r.rid LEFT JOIN why up ON up.tbl = r.up AND up.rid = r.up_rid
WHERE own.chain IS NULL AND (r.up_rid IS NULL OR up.chain IS NOT NULL) GROUP BY ALL"""


FINAL["lasting_pattern_ids"] = """SELECT CAST(CASE WHEN e.stops_pattern IS NOT NULL THEN e.pos ELSE (SELECT count(*) FROM
   (SELECT DISTINCT l.stop_list, tr.route_id, tr.direction_id FROM o_stop_lists l JOIN src_trips tr ON tr.trip_id = l.trip_id
    WHERE tr.agency_id IN (SELECT agency_id FROM o_agencies WHERE feed_id > (SELECT min(feed_id) FROM o_agencies))) c)
  + row_number() OVER (PARTITION BY e.stops_pattern IS NULL ORDER BY s.stops_pattern NULLS LAST, s.route_id NULLS LAST, s.direction_id NULLS LAST) END AS BIGINT) AS pattern_id,
 s.stops_pattern, s.route_id, s.direction_id, e.stops_pattern IS NULL AS is_new
 FROM o_sp s LEFT JOIN (
   SELECT stops_pattern, route_id, direction_id,
     row_number() OVER (ORDER BY stops_pattern NULLS LAST, route_id NULLS LAST, direction_id NULLS LAST) AS pos
   FROM (SELECT DISTINCT l.stop_list AS stops_pattern, tr.route_id, tr.direction_id FROM o_stop_lists l JOIN src_trips tr ON tr.trip_id = l.trip_id
         WHERE tr.agency_id IN (SELECT agency_id FROM o_agencies WHERE feed_id > (SELECT min(feed_id) FROM o_agencies))) d) e
 ON e.stops_pattern IS NOT DISTINCT FROM s.stops_pattern AND e.route_id IS NOT DISTINCT FROM s.route_id AND e.direction_id IS NOT DISTINCT FROM s.direction_id"""
def _reasons(source: str, step: str, reasons: list[tuple[str, str]], trips: str = "1") -> str:
    """Rows of ``source`` by the first condition that holds; a row per reason, also where it never holds."""
    case = " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in reasons)
    names = ", ".join(f"('{name}')" for name, _ in reasons)
    return (f"SELECT '{step}' AS step, k.reason, CAST(count(x.reason) AS BIGINT) AS n_rows, CAST(coalesce(sum(x.w), 0) AS BIGINT) AS n_trips "
            f"FROM (VALUES {names}) k(reason) LEFT JOIN (SELECT CASE {case} END AS reason, {trips} AS w FROM ({source}) s) x ON x.reason = k.reason GROUP BY k.reason")


_SCHEDULED = f"""SELECT tr.service_id, c.calendar_id, fa.trip_id AS first_row, fa.first_arrival_time, pt.timed_pattern_id, c.service_schedule_group_id AS grp
 FROM src_trips tr LEFT JOIN src_calendar c ON c.calendar_id = tr.service_id LEFT JOIN o_first_arrivals fa ON fa.trip_id = tr.trip_id
 LEFT JOIN o_patterns_trips pt ON pt.trip_id = tr.trip_id
 WHERE tr.based_on IS NULL AND tr.agency_id IN {DST_AGENCY_IDS} AND tr.trip_id NOT IN (SELECT trip_id FROM src_frequencies)"""
_CHILDREN = f"""SELECT kid.service_id, c.calendar_id, coalesce(kid.trip_start_time, par.trip_start_time) AS start_time, pt.timed_pattern_id,
 c.service_schedule_group_id AS grp
 FROM src_trips kid JOIN src_trips par ON par.trip_id = kid.based_on LEFT JOIN src_calendar c ON c.calendar_id = kid.service_id
 LEFT JOIN o_patterns_trips pt ON pt.trip_id = par.trip_id
 WHERE par.agency_id IN {DST_AGENCY_IDS} AND par.trip_id NOT IN (SELECT trip_id FROM src_frequencies)"""
_RESOLVE = """SELECT tp.trip_count, tp.direction_id, rt.route_id, sp.pattern_id, bad.pattern_id AS bad_id
 FROM o_tp tp LEFT JOIN (SELECT DISTINCT route_id FROM src_routes) rt ON rt.route_id = tp.route_id
 LEFT JOIN o_sp sp ON sp.stops_pattern = tp.stops_pattern AND sp.route_id = tp.route_id AND sp.direction_id = tp.direction_id
 LEFT JOIN o_bad_patterns bad ON bad.pattern_id = sp.pattern_id"""
FINAL["dropped_rows"] = "\nUNION ALL ".join([
    _reasons("SELECT g.trip_count, r.trip_id FROM o_pattern_groups g LEFT JOIN o_rep_min r ON r.trip_id = g.one_trip", "timed pattern",
             [("representative without a migrated stop row", "trip_id IS NULL")], "trip_count"),
    _reasons(_RESOLVE, "wide table", [("no direction", "direction_id IS NULL"), ("no route", "route_id IS NULL"),
                                      ("no stop pattern", "pattern_id IS NULL"), ("stop not in the source", "bad_id IS NOT NULL")], "trip_count"),
    _reasons(_SCHEDULED, "scheduled trips", [("no service", "service_id IS NULL"), ("no calendar", "calendar_id IS NULL"),
                                             ("no first stop row", "first_row IS NULL"), ("first stop without an arrival", "first_arrival_time IS NULL"),
                                             ("no timed pattern", "timed_pattern_id IS NULL"), ("calendar without a schedule group", "grp IS NULL")]),
    _reasons(_CHILDREN, "based-on trips", [("no service", "service_id IS NULL"), ("no calendar", "calendar_id IS NULL"), ("no start time", "start_time IS NULL"),
                                           ("no timed pattern", "timed_pattern_id IS NULL"), ("calendar without a schedule group", "grp IS NULL")])])
_FREQ_SOURCE = """SELECT tr.route_id, CAST(f.start_time AS BIGINT) AS start_time, CAST(f.end_time AS BIGINT) AS end_time,
 CAST(f.headway_secs AS BIGINT) AS headway_secs FROM src_frequencies f JOIN src_trips tr USING (trip_id)"""
_FREQ_TARGET = """SELECT p.route_id, tr.start_time, tr.end_time, CAST(tr.headway_secs AS BIGINT) AS headway_secs
 FROM o_trips tr JOIN (SELECT DISTINCT timed_pattern_id, pattern_id FROM o_timed_patterns) tp USING (timed_pattern_id)
 JOIN (SELECT DISTINCT pattern_id, route_id FROM o_patterns_base) p ON p.pattern_id = tp.pattern_id WHERE tr.headway_secs IS NOT NULL"""
FINAL["frequency_difference"] = f"""SELECT route_id, start_time, end_time, headway_secs, 'source' AS side, CAST(count(*) AS BIGINT) AS n_rows
 FROM ({_FREQ_SOURCE} EXCEPT ALL {_FREQ_TARGET}) a GROUP BY ALL
 UNION ALL SELECT route_id, start_time, end_time, headway_secs, 'target', CAST(count(*) AS BIGINT)
 FROM ({_FREQ_TARGET} EXCEPT ALL {_FREQ_SOURCE}) b GROUP BY ALL"""
_LEGACY_COLUMNS = f"tr.agency_id, l.timed_pattern_id, c.service_schedule_group_id AS calendar_id, %s, tr.block_id, {WEEKDAY_BOOLS}, tr.in_seat_transfer = 1 AS in_seat_transfer"
_LEGACY_FROM = "FROM lists l JOIN src_trips tr ON tr.trip_id = l.trip_id JOIN src_calendar c ON c.calendar_id = tr.service_id"
_NO_FREQUENCY = "tr.trip_id NOT IN (SELECT trip_id FROM src_frequencies)"
FINAL["trips_legacy_own_list"] = f"""WITH sig_rows AS (SELECT x.*, min(arrival_time) OVER (PARTITION BY trip_id) AS fa, min(departure_time) OVER (PARTITION BY trip_id) AS fd
  FROM src_stop_times x WHERE agency_id NOT IN ({SKIP})),
sigs AS (SELECT trip_id, string_agg(CAST(stop_id AS VARCHAR), ', ' ORDER BY stop_sequence NULLS LAST, stop_id) AS s,
  string_agg(CASE WHEN arrival_time IS NULL THEN '' ELSE CAST(arrival_time - fa AS VARCHAR) END, ',' ORDER BY stop_sequence NULLS LAST, stop_id) AS a,
  string_agg(CASE WHEN arrival_time IS NULL THEN '' ELSE CAST(departure_time - fd AS VARCHAR) END, ',' ORDER BY stop_sequence NULLS LAST, stop_id) AS d
  FROM sig_rows GROUP BY trip_id),
lists AS (SELECT DISTINCT tp.timed_pattern_id, tr.trip_id FROM sigs JOIN src_trips tr USING (trip_id) JOIN o_tp tp
  ON tp.stops_pattern IS NOT DISTINCT FROM sigs.s AND tp.arrival_time_intervals IS NOT DISTINCT FROM sigs.a AND tp.departure_time_intervals IS NOT DISTINCT FROM sigs.d
  AND tp.agency_id = tr.agency_id AND tp.route_id IS NOT DISTINCT FROM tr.route_id AND tp.direction_id IS NOT DISTINCT FROM tr.direction_id
  WHERE tp.timed_pattern_id IN (SELECT timed_pattern_id FROM o_tpsn WHERE agency_id IN {DST_AGENCY_IDS}))
SELECT {_LEGACY_COLUMNS % "CAST(fa.first_arrival_time AS BIGINT) AS start_time, CAST(NULL AS BIGINT) AS end_time, CAST(NULL AS INTEGER) AS headway_secs"}
 {_LEGACY_FROM} JOIN o_first_arrivals fa ON fa.trip_id = tr.trip_id WHERE tr.based_on IS NULL AND fa.first_arrival_time IS NOT NULL AND {_NO_FREQUENCY}
UNION SELECT {_LEGACY_COLUMNS % "tr.trip_start_time, NULL, NULL"} {_LEGACY_FROM} WHERE tr.based_on IS NOT NULL AND {_NO_FREQUENCY}
UNION SELECT {_LEGACY_COLUMNS % "f.start_time, f.end_time, f.headway_secs"} {_LEGACY_FROM} JOIN src_frequencies f ON f.trip_id = tr.trip_id"""
FINAL["timezone_by_link"] = """SELECT s.stop_id, coalesce(CASE s.stop_timezone WHEN '' THEN NULL WHEN 'US/Eastern' THEN 'America/New_York' ELSE s.stop_timezone END,
 (SELECT min(a.agency_timezone) FROM src_stop_times x JOIN o_agencies a ON a.agency_id = x.agency_id WHERE x.stop_id = s.stop_id)) AS timezone FROM src_stops s"""
FINAL["geojson_lines"] = """SELECT shape_segment_id, CAST(count(*) AS BIGINT) AS n_points,
 'LINESTRING(' || string_agg(printf('%.6f %.6f', lon, lat), ', ' ORDER BY shape_pt_sequence) || ')' AS linestring FROM src_shape_points GROUP BY shape_segment_id"""
FINAL["stop_time_texts"] = """SELECT trip_id, stop_id, CAST(arrival_time // 3600 AS VARCHAR) || ':' || lpad(CAST(arrival_time // 60 % 60 AS VARCHAR), 2, '0') || ':'
 || lpad(CAST(arrival_time % 60 AS VARCHAR), 2, '0') AS arrival_text, CAST(arrival_time AS BIGINT) AS arrival_time FROM src_stop_times"""
FINAL["agency_sample"] = """SELECT agency_id FROM (SELECT agency_id FROM src_agency WHERE agency_id IN (3, 175) OR agency_name NOT LIKE '%DEPRECATED%'
 ORDER BY agency_id LIMIT 10) s WHERE agency_id <> 1"""
FINAL["busiest_stop"] = """SELECT feed_id, stop_id, name, zone_id, lon, lat, enabled, timezone FROM o_stops
 WHERE stop_id = (SELECT x.stop_id FROM src_stop_times x WHERE x.stop_id IN (SELECT stop_id FROM o_stops) GROUP BY x.stop_id ORDER BY count(*) DESC, x.stop_id LIMIT 1)"""
FINAL["cascade_prune"] = _cascade_sql()
FINAL["fk_audit"] = _fk_sql()
FINAL["key_audit"] = _key_sql()
FINAL["check_audit"] = _check_sql()


def _closure(sql: str) -> list[str]:
    needed: set[str] = set()
    frontier = [n for n in _CTE_NAMES if re.search(rf"\b{n}\b", sql)]
    while frontier:
        n = frontier.pop()
        if n in needed:
            continue
        needed.add(n)
        frontier += [m for m in _CTE_NAMES if m != n and re.search(rf"\b{m}\b", _CTE_BODY[n])]
    return [n for n in _CTE_NAMES if n in needed]


def build(name: str) -> str:
    final = FINAL[name]
    ctes = _closure(final)
    text = final + "\n" + "\n".join(_CTE_BODY[c] for c in ctes)
    fixtures = fixture_closure(text)
    parts = [f"{n} AS ({fixture_body(n)})" for n in fixtures] + [f"{c} AS ({_CTE_BODY[c]})" for c in ctes]
    if final.startswith("WITH sig_rows"):
        return "WITH " + ",\n".join(parts) + ",\n" + final.removeprefix("WITH ")
    if final.startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + final.removeprefix("WITH RECURSIVE ")
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in FINAL}


__all__ = ["oracle_sql", "build", "FIXTURE_NAMES"]
