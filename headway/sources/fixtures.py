"""Source schedule tables derived from the driver's TPC-H style tables.

The same portable SQL text defines the source tables for Spark (through
``spark.sql`` with DataFrame arguments) and for the DuckDB oracle (as
CTEs).  Every view reads whole base tables, so its size grows with the
scale factor; the stride rules below only shape the data model (which
customers become routes, which suppliers are missing from ``stops``, ...).
"""

from __future__ import annotations

import re

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# (name, body) in definition order; a body may use earlier names.
FIXTURE_VIEWS: list[tuple[str, str]] = [
    ("src_agency_groups", """
SELECT r_regionkey AS agency_group_id, r_name AS group_name, lower(r_name) || '@example.org' AS feed_contact_email,
 'https://feeds.example/' || CAST(r_regionkey AS VARCHAR(20)) AS feed_contact_url, CASE WHEN r_regionkey % 2 = 0 THEN 'CC0' END AS feed_license,
 DATE '2024-01-01' + CAST(r_regionkey AS INT) AS last_modified FROM region"""),
    ("src_agency_group_assoc", """
SELECT n_nationkey AS agency_id, n_regionkey AS agency_group_id FROM nation WHERE n_nationkey <> 24"""),
    ("src_agency", """
SELECT n_nationkey AS agency_id, n_name AS agency_name, 'A' || CAST(n_nationkey AS VARCHAR(20)) AS agency_id_import,
 'https://' || lower(n_name) || '.example' AS agency_url, CASE WHEN n_nationkey % 5 <> 0 THEN 'Region/' || CAST(n_regionkey AS VARCHAR(20)) END AS agency_timezone,
 CAST(n_nationkey % 3 AS INT) AS agency_lang_id, substr(n_name, 1, 4) AS agency_short_name, '555-01' || CAST(10 + n_nationkey AS VARCHAR(20)) AS agency_phone,
 CASE WHEN n_nationkey % 4 = 1 THEN 'https://fares.example/' || CAST(n_nationkey AS VARCHAR(20)) END AS agency_fare_url,
 CASE WHEN n_nationkey % 6 = 2 THEN 'serves ' || n_name END AS agency_info, n_nationkey % 2 = 0 AS query_tracking,
 DATE '2024-02-01' + CAST(n_nationkey AS INT) AS last_modified, n_nationkey % 7 = 3 AS no_frequencies FROM nation"""),
    ("src_zones", """
SELECT 100 + n_nationkey AS zone_id, n_name AS zone_name, n_nationkey AS agency_id, DATE '2024-03-01' + CAST(n_nationkey AS INT) AS last_modified,
 CASE WHEN n_nationkey % 4 <> 3 THEN 'Z' || CAST(n_nationkey AS VARCHAR(20)) END AS zone_id_import FROM nation WHERE n_nationkey < 20"""),
    ("src_stops", """
SELECT s_suppkey AS stop_id, s_name AS stop_name, s_nationkey AS agency_id, CAST(100 + s_suppkey % 25 AS INT) AS zone_id,
 CAST((s_suppkey * 37) % 360 AS DOUBLE) - 179.5 AS stop_lon, CAST((s_suppkey * 53) % 140 AS DOUBLE) - 69.5 AS stop_lat,
 CASE WHEN s_suppkey % 9 = 0 THEN '' WHEN s_suppkey % 4 = 0 THEN 'US/Eastern' END AS stop_timezone, s_suppkey % 6 <> 0 AS publish_status,
 CASE WHEN s_suppkey % 8 <> 1 THEN 'S' || CAST(s_suppkey AS VARCHAR(20)) END AS stop_code, CASE WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey % 4 AS VARCHAR(20)) END AS platform_code,
 CAST(s_suppkey % 2 AS INT) AS location_type, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 1 END AS parent_station, 'near ' || s_name AS stop_desc,
 CASE WHEN s_suppkey % 7 = 0 THEN 'shelter' END AS stop_comments, 'city ' || CAST(s_nationkey AS VARCHAR(20)) AS city, CAST(s_suppkey % 4 AS INT) AS direction_id,
 'https://stops.example/' || CAST(s_suppkey AS VARCHAR(20)) AS stop_url
 FROM supplier WHERE s_suppkey % 50 <> 49"""),
    ("src_routes", """
SELECT CAST(FLOOR(c_custkey / 10) AS BIGINT) AS route_id, c_nationkey AS agency_id, c_mktsegment AS route_long_name, c_name AS route_short_name,
 CASE CAST(FLOOR(c_custkey / 10) AS BIGINT) % 4 WHEN 0 THEN '00FF7f' WHEN 1 THEN 'red' WHEN 2 THEN NULL ELSE 'ABCDEF' END AS route_color,
 CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE CAST(FLOOR(c_custkey / 10) AS BIGINT) END AS route_sort_order,
 CASE CAST(FLOOR(c_custkey / 10) AS BIGINT) % 5 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS hidden,
 CASE CAST(FLOOR(c_custkey / 10) AS BIGINT) % 3 WHEN 0 THEN 'FFffFF' WHEN 1 THEN 'white' END AS route_text_color,
 'route of ' || c_name AS route_desc, CAST(CAST(FLOOR(c_custkey / 10) AS BIGINT) % 8 AS INT) AS route_type,
 CASE WHEN CAST(FLOOR(c_custkey / 10) AS BIGINT) % 6 <> 5 THEN 'https://routes.example/' || CAST(c_custkey AS VARCHAR(20)) END AS route_url,
 CAST(CAST(FLOOR(c_custkey / 10) AS BIGINT) % 3 AS INT) AS route_bikes_allowed, 'R' || CAST(c_custkey AS VARCHAR(20)) AS route_id_import,
 DATE '2024-04-01' + CAST(c_custkey % 200 AS INT) AS last_modified
 FROM customer WHERE c_custkey % 10 = 0"""),
    ("src_headsigns", """
SELECT DISTINCT CAST(p_size AS BIGINT) AS headsign_id, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'To ' || CAST(p_size AS VARCHAR(10)) END AS headsign, CAST(p_size % 25 AS INT) AS agency_id FROM part"""),
    ("src_directions", """
SELECT 0 AS direction_id, 'Outbound' AS direction_label UNION ALL SELECT 1, 'Inbound'"""),
    ("src_calendar", """
SELECT n_nationkey AS calendar_id, CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE n_regionkey END AS service_schedule_group_id,
 n_nationkey AS agency_id, n_nationkey % 2 AS monday, 1 AS tuesday, 1 AS wednesday, 1 AS thursday, 1 AS friday, CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE 0 END AS saturday, CASE WHEN n_nationkey % 3 = 0 THEN 1 ELSE 0 END AS sunday FROM nation"""),
    ("src_trips", """
SELECT o.o_orderkey AS trip_id, r.route_id, r.agency_id, CASE WHEN r.route_id % 17 = 16 THEN NULL ELSE CAST(o.o_orderkey % 2 AS INT) END AS direction_id,
 CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE CAST(o.o_orderkey % 25 AS INT) END AS service_id,
 CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE 1 + (r.route_id + o.o_orderkey % 3) % 50 END AS headsign_id,
 o.o_orderkey % 40 AS block_id,
 CASE WHEN o.o_orderkey % 11 = 0 AND o.o_orderkey > 0 THEN o.o_orderkey - 1 END AS based_on,
 CASE WHEN o.o_orderkey % 6 IN (0, 5) THEN NULL ELSE 18000 + (o.o_orderkey % 60) * 900 END AS trip_start_time,
 CASE o.o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END AS in_seat_transfer
 FROM orders o JOIN src_routes r ON r.route_id = CAST(FLOOR(o.o_custkey / 10) AS BIGINT)"""),
    ("src_stop_times", """
SELECT t.trip_id, t.agency_id, CAST(CASE WHEN t.trip_id % 31 = 3 AND l.l_linenumber = 2 THEN 1 ELSE l.l_linenumber END AS INT) AS stop_sequence,
 (t.route_id * 7 + l.l_linenumber * 3 + t.trip_id % 2) % (SELECT COUNT(*) FROM supplier) AS stop_id,
 CASE WHEN t.trip_id % 13 = 0 AND l.l_linenumber = 4 THEN NULL ELSE 18000 + (t.trip_id % 60) * 900 + l.l_linenumber * 300 END AS arrival_time,
 CASE WHEN t.trip_id % 23 = 0 AND l.l_linenumber = 5 THEN NULL ELSE 18000 + (t.trip_id % 60) * 900 + l.l_linenumber * 300 + 30 END AS departure_time,
 CASE WHEN l.l_linenumber = 1 THEN NULL ELSE 0 END AS pickup_type
 FROM src_trips t JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON l.l_orderkey = t.trip_id"""),
    ("src_frequencies", """
SELECT o_orderkey AS trip_id, 21600 AS start_time, CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE 36000 END AS end_time, 600 + CAST(o_orderkey % 3 AS INT) * 300 AS headway_secs
 FROM orders WHERE o_orderkey % 7 = 0"""),
    ("src_fare_rules", """
WITH base AS (SELECT p_partkey, CAST(p_partkey AS INT) AS pk, CAST(p_size % 10 AS BIGINT) AS fare_id, CAST(p_partkey % 25 AS INT) AS agency_id,
 CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 50 END AS route_id, CASE WHEN p_partkey % 6 = 0 THEN 100 + p_partkey % 22 END AS contains_id,
 CASE WHEN p_size % 5 = 0 THEN NULL ELSE 100 + p_partkey % 22 END AS zone_a, CAST(100 + p_size % 22 AS BIGINT) AS zone_b FROM part)
 SELECT p_partkey * 10 AS fare_rule_id, fare_id, route_id, zone_a AS origin_id, zone_b AS destination_id, contains_id, agency_id,
  CASE WHEN p_partkey % 11 <> 0 THEN DATE '2024-05-01' + pk % 40 END AS last_modified, 'F' || CAST(fare_id AS VARCHAR(20)) AS fare_id_import,
  CASE WHEN route_id IS NOT NULL THEN 'R' || CAST(route_id AS VARCHAR(20)) ELSE '' END AS route_id_import, CASE WHEN zone_a IS NOT NULL THEN 'Z' || CAST(zone_a AS VARCHAR(20)) END AS origin_id_import,
  'Z' || CAST(zone_b AS VARCHAR(20)) AS destination_id_import, CASE WHEN contains_id IS NOT NULL THEN 'Z' || CAST(contains_id AS VARCHAR(20)) END AS contains_id_import FROM base
 UNION ALL SELECT p_partkey * 10 + 1, fare_id, route_id, zone_b, zone_a, contains_id, agency_id,
  CASE WHEN p_partkey % 13 <> 0 THEN DATE '2024-05-01' + pk % 37 END, 'F' || CAST(fare_id AS VARCHAR(20)),
  CASE WHEN route_id IS NOT NULL THEN 'R' || CAST(route_id AS VARCHAR(20)) ELSE '' END, 'Z' || CAST(zone_b AS VARCHAR(20)),
  CASE WHEN zone_a IS NOT NULL THEN 'Z' || CAST(zone_a AS VARCHAR(20)) END, NULL FROM base WHERE p_partkey % 3 <> 0
 UNION ALL SELECT p_partkey * 10 + 2, fare_id, route_id, zone_a, zone_b, contains_id, agency_id,
  DATE '2024-06-01' + pk % 5, NULL, NULL, NULL, NULL, NULL FROM base WHERE p_partkey % 8 = 0"""),
    ("src_fare_attributes", """
SELECT p_partkey AS fare_id, CAST((p_partkey * 3) % 25 AS INT) AS agency_id, p_retailprice AS price, 'USD' AS currency_type, CAST(p_size % 2 AS INT) AS payment_method,
 CASE WHEN p_size % 4 <> 3 THEN CAST(p_size % 4 AS INT) END AS transfers, CASE WHEN p_size % 3 = 0 THEN 5400 END AS transfer_duration,
 DATE '2024-07-01' + CAST(p_size AS INT) AS last_modified, 'F' || CAST(p_partkey AS VARCHAR(20)) AS fare_id_import FROM part"""),
    ("src_fare_rider_categories", """
SELECT p_partkey AS fare_rider_category_id, CAST(p_size % 12 AS BIGINT) AS fare_id, p_size % 4 AS rider_category_custom_id, CAST(p_size AS DECIMAL(10,4)) AS price, CAST(p_partkey % 25 AS INT) AS agency_id FROM part"""),
    ("src_transfers", """
SELECT s_suppkey AS transfer_id, s_suppkey AS from_stop_id, s_suppkey + 1 AS to_stop_id, CAST(s_suppkey % 4 AS INT) AS transfer_type, s_nationkey AS agency_id,
 CASE WHEN s_suppkey % 4 = 2 THEN CAST(60 * (s_suppkey % 10) AS INT) END AS min_transfer_time, DATE '2024-08-01' + CAST(s_suppkey % 90 AS INT) AS last_modified,
 'S' || CAST(s_suppkey AS VARCHAR(20)) AS from_stop_id_import, 'S' || CAST(s_suppkey + 1 AS VARCHAR(20)) AS to_stop_id_import FROM supplier"""),
    ("src_blocks", """
SELECT DISTINCT o_orderkey % 40 AS block_id, CAST(o_orderkey % 40 % 25 AS INT) AS agency_id, 'Block ' || CAST(o_orderkey % 40 AS VARCHAR(20)) AS block_label FROM orders"""),
    ("sample_colors", """
SELECT p_partkey AS color_id, '#' || lpad(lower(hex((p_partkey * 7919) % 16777216)), 6, '0') AS color FROM part"""),
    ("src_service_schedule_groups", """
SELECT r_regionkey AS service_schedule_group_id, r_name AS service_schedule_group_label, CASE WHEN r_regionkey = 3 THEN 7 ELSE r_regionkey END AS agency_id FROM region"""),
    ("src_service_schedule_bounds", """
SELECT CASE WHEN n_nationkey % 8 = 0 THEN NULL ELSE n_regionkey END AS service_schedule_group_id, n_nationkey AS agency_id, DATE '2024-01-01' AS start_date, DATE '2024-12-31' AS end_date FROM nation"""),
    ("src_calendar_dates", """
SELECT o_orderkey AS calendar_date_id, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 25 AS INT) AS agency_id, o_orderpriority AS description, CAST(o_orderdate AS DATE) AS last_modified FROM orders"""),
    ("src_calendar_date_service_exceptions", """
SELECT o_orderkey AS calendar_date_id, CAST(1 + o_orderkey % 2 AS INT) AS exception_type, CAST(o_orderkey % 30 AS INT) AS service_exception, CAST(o_orderkey % 25 AS INT) AS agency_id,
 CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS last_modified FROM orders"""),
    ("src_users", """
SELECT c_custkey AS user_id, c_name AS email, CAST(c_custkey % 2 AS INT) AS read_only, CASE WHEN c_custkey % 10 = 0 THEN 1 WHEN c_custkey % 10 = 9 THEN NULL ELSE 0 END AS admin,
 'hash' || CAST(c_custkey * 7 AS VARCHAR(20)) AS pass, c_mktsegment AS first_name, c_name AS last_name, c_custkey % 12 <> 0 AS active,
 DATE '2020-01-01' + CAST(c_custkey % 900 AS INT) AS registration_date, CAST(c_custkey % 3 AS INT) AS language_id,
 DATE '2024-09-01' + CAST(c_custkey % 60 AS INT) AS last_modified FROM customer"""),
    ("src_user_permissions", """
SELECT c_custkey AS permission_id, c_nationkey AS agency_id, c_custkey AS user_id,
 DATE '2024-10-01' + CAST(c_custkey % 30 AS INT) AS last_modified FROM customer"""),
    ("src_shape_points", """
SELECT CAST(FLOOR(event_id / 10) AS BIGINT) AS shape_segment_id, CAST(event_id % 10 AS INT) AS shape_pt_sequence, CAST((event_id * 7) % 360 AS DOUBLE) - 180 AS lon, CAST((event_id * 3) % 160 AS DOUBLE) - 80 AS lat FROM events"""),
    ("src_shape_segments", """
SELECT CAST(FLOOR(event_id / 10) AS BIGINT) AS shape_segment_id, user_id % 20 AS start_coordinate_id, CASE WHEN event_id % 70 = 0 THEN NULL ELSE (user_id + 1 + CAST(FLOOR(event_id / 10) AS BIGINT) % 5) % 20 END AS end_coordinate_id FROM events WHERE event_id % 10 = 0"""),
    # one house-shaped zone with a triangular hole per nation
    ("tz_polygons", """
SELECT n_name AS tzid, 0 AS ring_id, 0 AS vertex_no, CAST(15 * n_nationkey AS DOUBLE) - 180 + 0.0 AS lon, CAST(-60.0 AS DOUBLE) AS lat FROM nation
 UNION ALL SELECT n_name, 0, 1, CAST(15 * n_nationkey AS DOUBLE) - 180 + 15.0, CAST(-60.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 0, 2, CAST(15 * n_nationkey AS DOUBLE) - 180 + 15.0, CAST(40.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 0, 3, CAST(15 * n_nationkey AS DOUBLE) - 180 + 7.5, CAST(60.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 0, 4, CAST(15 * n_nationkey AS DOUBLE) - 180 + 0.0, CAST(40.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 1, 0, CAST(15 * n_nationkey AS DOUBLE) - 180 + 4.0, CAST(-10.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 1, 1, CAST(15 * n_nationkey AS DOUBLE) - 180 + 7.5, CAST(12.0 AS DOUBLE) FROM nation
 UNION ALL SELECT n_name, 1, 2, CAST(15 * n_nationkey AS DOUBLE) - 180 + 11.0, CAST(-10.0 AS DOUBLE) FROM nation"""),
]

FIXTURE_NAMES = [name for name, _ in FIXTURE_VIEWS]
_BODIES = dict(FIXTURE_VIEWS)


def referenced_names(sql: str, candidates) -> list[str]:
    return [n for n in candidates if re.search(rf"\b{re.escape(n)}\b", sql)]


def fixture_closure(sql: str) -> list[str]:
    """Fixture views a SQL text needs, transitively, in definition order."""
    needed: set[str] = set()
    frontier = referenced_names(sql, FIXTURE_NAMES)
    while frontier:
        name = frontier.pop()
        if name in needed:
            continue
        needed.add(name)
        frontier.extend(referenced_names(_BODIES[name], FIXTURE_NAMES))
    return [n for n in FIXTURE_NAMES if n in needed]


def fixture_body(name: str) -> str:
    return _BODIES[name].strip()
