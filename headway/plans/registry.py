"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query runs the migration over the whole source tables derived from
``sf_dir``; column names match the DuckDB oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.columns import hms_to_seconds, is_valid_css_color, seconds_to_hms
from headway.functions.geo import line_text
from headway.operators import audits, fares, naming, patterns as pat, spatial, trips as trp
from headway.operators.cascade import prune_orphans as prune_all
from headway.operators.ids import high_water_marks
from headway.operators.scope import sample_agencies
from headway.operators.keydict import KeyDictionary, lasting_ids
from headway.plans.pipeline import Migration
from headway.sources.catalog import SourceCatalog

# The scope of the registered queries (the fixture's choice, FIXTURES.md).
FIXTURE_CONFIG = MigrateConfig(skip_agencies=(7, 21), skip_trips=(0,))

_MIGRATIONS: dict[tuple, Migration] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return (spark.sparkContext.applicationId, id(spark), sf_dir)


def migration(spark: SparkSession, sf_dir: str) -> Migration:
    """One migration per (application, session, scale folder): the queries of
    one driver run share its persisted intermediates and dense ids."""
    key = _key(spark, sf_dir)
    m = _MIGRATIONS.get(key)
    if m is None or m.spark is not spark:
        m = _MIGRATIONS[key] = Migration(spark, SourceCatalog.from_testdata(spark, sf_dir), FIXTURE_CONFIG)
    return m


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- B: reference tables ------------------------------------------------------

@query("feeds")
def q_feeds(spark, sf):
    return migration(spark, sf).feeds


@query("agencies")
def q_agencies(spark, sf):
    return migration(spark, sf).agencies


@query("zones")
def q_zones(spark, sf):
    return migration(spark, sf).zones


@query("stops")
def q_stops(spark, sf):
    s = migration(spark, sf).stops
    return s.select("feed_id", "stop_id", "stop_code", "platform_code", "location_type", "parent_station_id", "name",
                    "stop_desc", "stop_comments", "zone_id", "city", "direction_id", "url",
                    F.col("point.lon").alias("lon"), F.col("point.lat").alias("lat"), "enabled", "timezone")


@query("routes")
def q_routes(spark, sf):
    return migration(spark, sf).routes


@query("headsigns")
def q_headsigns(spark, sf):
    return migration(spark, sf).headsigns


@query("directions")
def q_directions(spark, sf):
    return migration(spark, sf).directions


@query("calendars")
def q_calendars(spark, sf):
    return migration(spark, sf).calendars


@query("calendar_bounds")
def q_calendar_bounds(spark, sf):
    return migration(spark, sf).calendar_bounds


@query("calendar_dates")
def q_calendar_dates(spark, sf):
    return migration(spark, sf).calendar_dates


@query("service_exceptions_intent")
def q_exc_intent(spark, sf):
    return migration(spark, sf).service_exceptions("intent")


@query("service_exceptions_literal")
def q_exc_literal(spark, sf):
    return migration(spark, sf).service_exceptions("literal")


@query("blocks_colored")
def q_blocks(spark, sf):
    return migration(spark, sf).blocks


@query("fare_attributes")
def q_fare_attributes(spark, sf):
    return migration(spark, sf).fare_attributes


def _riders(m, mode):
    return m.fare_rider_categories(mode).withColumn("price", F.col("price").cast("double"))


@query("rider_categories_intent")
def q_riders_intent(spark, sf):
    return _riders(migration(spark, sf), "intent")


@query("rider_categories_literal")
def q_riders_literal(spark, sf):
    return _riders(migration(spark, sf), "literal")


@query("transfers")
def q_transfers(spark, sf):
    return migration(spark, sf).transfers


@query("users")
def q_users(spark, sf):
    return migration(spark, sf).users


@query("user_permissions")
def q_user_permissions(spark, sf):
    return migration(spark, sf).user_permissions


# ---- C: patterns ----------------------------------------------------------------

@query("timed_pattern_groups")
def q_timed_pattern_groups(spark, sf):
    return migration(spark, sf).pattern_time_intervals.select(
        *pat.PATTERN_KEY, "one_trip", "trip_count")


TPSN_COLUMNS = ["agency_id", "agency_name", "route_short_name", "route_long_name", "direction_name",
                "direction_id", "trip_headsign_id", "trip_headsign", "stop_id", "stop_order",
                "timed_pattern_id", "pattern_id", "arrival_time", "departure_time", "pickup_type",
                "drop_off_type", "one_trip", "stops_pattern", "arrival_time_intervals",
                "departure_time_intervals", "route_id", "stop_headsign_id"]


@query("tpsn")
def q_tpsn(spark, sf):
    return migration(spark, sf).tpsn.select(*TPSN_COLUMNS)


@query("patterns_with_headsign")
def q_patterns_with_headsign(spark, sf):
    return migration(spark, sf).patterns_base


@query("pattern_stops")
def q_pattern_stops(spark, sf):
    return migration(spark, sf).pattern_stops


@query("timed_patterns")
def q_timed_patterns(spark, sf):
    return migration(spark, sf).timed_patterns


@query("timed_pattern_stops")
def q_timed_pattern_stops(spark, sf):
    return migration(spark, sf).timed_pattern_stops


@query("multi_route_patterns")
def q_multi_route(spark, sf):
    return pat.multi_route_patterns(migration(spark, sf).patterns_base).select(
        "pattern_id", *[F.col(c).cast("bigint").alias(c) for c in ("agency_count", "route_count", "direction_count")])


# ---- D: trips ---------------------------------------------------------------------

@query("first_arrivals")
def q_first_arrivals(spark, sf):
    return migration(spark, sf).first_arrivals


@query("first_arrival_duplicates")
def q_first_arrival_dups(spark, sf):
    m = migration(spark, sf)
    return trp.first_arrival_duplicates(trp.first_arrival_rows(m.per_trip, m.cfg)).withColumn(
        "n_rows", F.col("n_rows").cast("bigint"))


@query("patterns_trips")
def q_patterns_trips(spark, sf):
    return migration(spark, sf).patterns_trips


@query("trips_scheduled")
def q_trips_scheduled(spark, sf):
    m = migration(spark, sf)
    return trp.scheduled_trips(m.src, m.agencies, m.first_arrivals, m.patterns_trips)


@query("trips_based_on")
def q_trips_based_on(spark, sf):
    m = migration(spark, sf)
    return trp.based_on_trips(m.src, m.agencies, m.patterns_trips)


@query("trips_freq_based_on")
def q_trips_freq_based_on(spark, sf):
    m = migration(spark, sf)
    return trp.frequency_based_on_trips(m.src, m.agencies, m.patterns_trips)


@query("trips_freq")
def q_trips_freq(spark, sf):
    m = migration(spark, sf)
    return trp.frequency_trips(m.src, m.agencies, m.patterns_trips)


@query("trips_all")
def q_trips_all(spark, sf):
    return migration(spark, sf).trips


# ---- E: ranking, naming, ordering -----------------------------------------------------

@query("pattern_trip_counts")
def q_pattern_trip_counts(spark, sf):
    return migration(spark, sf).pattern_trip_counts


@query("primary_patterns")
def q_primary_patterns(spark, sf):
    return migration(spark, sf).primary_patterns


@query("pattern_stop_difference")
def q_pattern_stop_difference(spark, sf):
    d = migration(spark, sf).pattern_stop_difference
    return d.select("route_id", "pattern_id", "primary_pattern_id", "n_stops", "n_added_stops", "n_removed_stops",
                    F.array_join("added_stop_ids", ",").alias("added_stop_ids"),
                    F.array_join("removed_stop_ids", ",").alias("removed_stop_ids"))


@query("pattern_names")
def q_pattern_names(spark, sf):
    return migration(spark, sf).patterns


@query("pattern_names_endpoints")
def q_pattern_names_endpoints(spark, sf):
    m = migration(spark, sf)
    return naming.pattern_names_endpoints(m.patterns_base, m.pattern_stops, m.src["stops"])


@query("unordered_agencies")
def q_unordered_agencies(spark, sf):
    return naming.unordered_agencies(migration(spark, sf).routes).select(
        "agency_id", F.col("n_sort_orders").cast("bigint").alias("n_sort_orders"),
        F.col("n_routes").cast("bigint").alias("n_routes"))


@query("routes_ordered")
def q_routes_ordered(spark, sf):
    return migration(spark, sf).routes_ordered


# ---- F: fares ----------------------------------------------------------------------------

@query("fare_rules_golden")
def q_fare_rules_golden(spark, sf):
    g = fares.newest_fare_rules(migration(spark, sf).src["fare_rules"])
    return g.withColumn("n_rules", F.col("n_rules").cast("bigint"))


@query("fare_rules")
def q_fare_rules(spark, sf):
    return migration(spark, sf).fare_rules


@query("fares_symmetric")
def q_fares_symmetric(spark, sf):
    return migration(spark, sf).fares_symmetric


@query("fares_asymmetric")
def q_fares_asymmetric(spark, sf):
    return migration(spark, sf).fares_asymmetric


@query("fare_balance")
def q_fare_balance(spark, sf):
    m = migration(spark, sf)
    return fares.fare_balance(m.fare_rules, m.fares_symmetric, m.fares_asymmetric)


@query("fare_edits_applied")
def q_fare_edits(spark, sf):
    m = migration(spark, sf)
    return fares.apply_edits(m.fare_rules, fares.derive_edits(m.fare_rules), run_ts=m.cfg.run_ts)


# ---- I: spatial ---------------------------------------------------------------------------

@query("stop_timezones")
def q_stop_timezones(spark, sf):
    m = migration(spark, sf)
    pts = m.stops.select(F.col("point.lon").alias("lon"), F.col("point.lat").alias("lat"))
    return spatial.point_timezone(pts, spatial.polygon_edges(m.src["tz_polygons"]), m.cfg)


@query("timezone_fallback")
def q_timezone_fallback(spark, sf):
    return spatial.timezone_fallback(migration(spark, sf).src)


@query("shape_segments")
def q_shape_segments(spark, sf):
    s = migration(spark, sf).shape_segments
    return s.select("from_stop_id", "to_stop_id", F.size("linestring").cast("bigint").alias("n_points"),
                    line_text("linestring").alias("linestring"))


@query("shape_points_dump")
def q_shape_points_dump(spark, sf):
    return spatial.dump_points(migration(spark, sf).shape_segments)


@query("shape_length_miles")
def q_shape_length(spark, sf):
    s = migration(spark, sf).shape_segments
    return s.select("from_stop_id", "to_stop_id",
                    F.round(spatial.line_length_miles("linestring"), 2).alias("length_miles"))


@query("null_timezones")
def q_null_timezones(spark, sf):
    return spatial.null_timezones(migration(spark, sf).stops)


# ---- J: audits -----------------------------------------------------------------------------

@query("fk_audit")
def q_fk_audit(spark, sf):
    return audits.fk_audit(migration(spark, sf))


@query("key_audit")
def q_key_audit(spark, sf):
    return audits.key_audit(migration(spark, sf))


@query("check_audit")
def q_check_audit(spark, sf):
    return audits.check_audit(migration(spark, sf))


@query("frequency_parity")
def q_frequency_parity(spark, sf):
    m = migration(spark, sf)
    return audits.frequency_parity(m.src, m)


@query("based_on_missing_start")
def q_based_on_missing_start(spark, sf):
    m = migration(spark, sf)
    return audits.based_on_missing_start(m.src, m)


@query("trip_chain_counts")
def q_trip_chain_counts(spark, sf):
    m = migration(spark, sf)
    return audits.trip_chain_counts(m.src, m)


@query("frequency_difference")
def q_frequency_difference(spark, sf):
    m = migration(spark, sf)
    return audits.frequency_difference(m.src, m)


@query("trips_legacy_own_list")
def q_trips_legacy_own_list(spark, sf):
    m = migration(spark, sf)
    return trp.trips_legacy_own_list(m.src, m.first_arrivals, m.legacy_lists)


@query("timezone_by_link")
def q_timezone_by_link(spark, sf):
    m = migration(spark, sf)
    return spatial.timezone_by_link(m.src, m.agencies, spatial.stop_agencies(m.src))


@query("geojson_lines")
def q_geojson_lines(spark, sf):
    """Every segment's points written as GeoJSON and parsed back into a line."""
    pair = F.concat(F.lit("["), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("shape_pt_sequence", pair.alias("p")))), lambda x: x["p"])
    texts = migration(spark, sf).src["shape_points"].groupBy("shape_segment_id").agg(F.concat(
        F.lit('{"type":"LineString","coordinates":['), F.array_join(ordered, ","), F.lit("]}")).alias("geojson"))
    return spatial.geojson_lines(texts, "geojson").select("shape_segment_id", F.size("linestring").cast("bigint").alias("n_points"),
                                                          line_text("linestring").alias("linestring"))


@query("stop_time_texts")
def q_stop_time_texts(spark, sf):
    """H7: arrival times as text and back."""
    text = seconds_to_hms("arrival_time")
    return migration(spark, sf).src["stop_times"].select("trip_id", "stop_id", text.alias("arrival_text"), hms_to_seconds(text).alias("arrival_time"))


@query("agency_sample")
def q_agency_sample(spark, sf):
    """Must-have agencies and the first ten that aren't deprecated, without a block list (a sample by design)."""
    return sample_agencies(migration(spark, sf).src, [3, 175], 10, [1])


@query("busiest_stop")
def q_busiest_stop(spark, sf):
    """The look-up of one stop, the one that most stop rows name (ties: smallest id)."""
    m = migration(spark, sf)
    calls = (m.src["stop_times"].where(F.col("stop_id").isNotNull()).join(m.stops_base.select("stop_id"), "stop_id", "left_semi")
             .groupBy("stop_id").count())
    top = calls.agg(F.max_by("stop_id", F.struct("count", -F.col("stop_id"))).alias("s")).first()["s"]     # one value
    return audits.stop_lookup(m, int(top)).select("feed_id", "stop_id", "name", "zone_id", F.col("point.lon").alias("lon"), F.col("point.lat").alias("lat"),
                                                  "enabled", "timezone")


@query("dropped_rows")
def q_dropped_rows(spark, sf):
    return migration(spark, sf).dropped_rows()


# ---- H / A: functions and id bookkeeping ------------------------------------------------------

@query("css_color_valid")
def q_css_color_valid(spark, sf):
    r = migration(spark, sf).src["routes"]
    return r.select("route_id", "route_color", is_valid_css_color("route_color").alias("is_valid"))


@query("high_water_marks")
def q_high_water_marks(spark, sf):
    m = migration(spark, sf)
    return high_water_marks({
        "zones": (m.zones, "zone_id"), "stops": (m.stops, "stop_id"), "patterns": (m.patterns, "pattern_id"),
        "timed_patterns": (m.timed_patterns, "timed_pattern_id"), "trips": (m.trips, "trip_id"),
        "fare_rules": (m.fare_rules, "fare_rule_id"), "blocks": (m.blocks, "block_id"),
    })


@query("lasting_pattern_ids")
def q_lasting_pattern_ids(spark, sf):
    """The stop patterns of the second of two reloads.  The first one ran before the feed with the
    smallest id joined; patterns it numbered keep their ids, the others are numbered after them."""
    m = migration(spark, sf)
    key = ["stops_pattern", "route_id", "direction_id"]
    every = pat.distinct_stop_patterns(m.per_trip, m.agencies)
    joined_later = m.agencies.agg(F.min("feed_id").alias("feed_id"))
    earlier = m.agencies.join(joined_later, "feed_id", "left_anti")
    none = spark.createDataFrame([], KeyDictionary.SCHEMA)
    _, first = lasting_ids(pat.distinct_stop_patterns(m.per_trip, earlier), key, "pattern_id", none)
    second, fresh = lasting_ids(every, key, "pattern_id", first)
    return second.join(fresh.select(F.col("_hw_id").alias("pattern_id"), F.lit(True).alias("is_new")), "pattern_id", "left").select(
        "pattern_id", *key, F.coalesce("is_new", F.lit(False)).alias("is_new"))


# ---- legacy and coverage jobs ------------------------------------------------------------------

@query("trips_legacy_union")
def q_trips_legacy_union(spark, sf):
    m = migration(spark, sf)
    return trp.trips_legacy_union(m.src, m.agencies, m.first_arrivals, m.patterns_trips)


@query("tz_coverage")
def q_tz_coverage(spark, sf):
    m = migration(spark, sf)
    cov = spatial.tz_coverage(spatial.polygon_edges(m.src["tz_polygons"]), m.stops)
    return cov.select(F.round("fraction_covered", 9).alias("fraction_covered"), "n_null_timezone")


@query("stop_feed_link")
def q_stop_feed_link(spark, sf):
    m = migration(spark, sf)
    return spatial.stop_feed_link(m.src, m.agencies)


@query("orphan_prune")
def q_orphan_prune(spark, sf):
    m = migration(spark, sf)
    return audits.prune_orphans(_riders(m, "literal"), "fare_id", m.fare_attributes, "fare_id")


def unscoped_tables(m) -> dict:
    """The keyed tables as the source holds them, before any agency is left out (patterns and stops: migrated)."""
    src = m.src
    groups = src["service_schedule_groups"]
    return {
        "agencies": m.agencies, "zones": m.zones, "patterns": m.patterns_base, "stops": m.stops_base, "pattern_stops": m.pattern_stops,
        "calendars": groups.select("agency_id", F.col("service_schedule_group_id").alias("calendar_id")),
        "calendar_bounds": src["service_schedule_bounds"].select("agency_id", F.col("service_schedule_group_id").alias("calendar_id"), "start_date"),
        "calendar_dates": src["calendar_dates"].select("calendar_date_id", "agency_id"),
        "calendar_date_service_exceptions": src["calendar_date_service_exceptions"].select(
            "calendar_date_id", F.col("service_exception").alias("calendar_id"), "agency_id"),
        "directions": m.directions, "headsigns": src["headsigns"],
        "fare_attributes": src["fare_attributes"].select("fare_id", "agency_id"),
        "fare_rider_categories": src["fare_rider_categories"].select("fare_rider_category_id", "fare_id", "agency_id"),
        "fare_rules": src["fare_rules"].select("fare_rule_id", "fare_id", "origin_id", "destination_id", "contains_id", "agency_id"),
    }


@query("cascade_prune")
def q_cascade_prune(spark, sf):
    """J4 over all 19 keys: everything that agencies outside the run own in calendars, calendar dates, fares
    and zones is deleted, and so are the stops without a zone."""
    m = migration(spark, sf)
    tables = unscoped_tables(m)
    migrated = m.agencies.select("agency_id")
    def foreign(name, key):
        return tables[name].where(F.col("agency_id") != -411).join(migrated, "agency_id", "left_anti").select(key)
    deletes = {"calendars": foreign("calendars", "calendar_id"), "calendar_dates": foreign("calendar_dates", "calendar_date_id"),
               "fare_attributes": foreign("fare_attributes", "fare_id"), "zones": foreign("zones", "zone_id"),
               "stops": m.stops_base.where(F.col("zone_id").isNull()).select("stop_id")}
    return prune_all(tables, deletes=deletes)[1]


def busiest_agency(src) -> int:
    """The agency in a group running the most trips (ties: smallest id), read as a scalar."""
    grouped = src["agency_group_assoc"].select("agency_id")
    row = (src["trips"].where(F.col("agency_id").isNotNull()).join(grouped, "agency_id", "left_semi").groupBy("agency_id").count()
           .orderBy(F.col("count").desc(), F.col("agency_id")).first())
    return int(row["agency_id"])


@query("scope_only_agency")
def q_scope_only_agency(spark, sf):
    """A5: a trial run scoped to one agency; its skip list is every other
    agency (computed from the data)."""
    from headway.operators.scope import scope_only
    from headway.operators.reference_tables import agencies
    m = migration(spark, sf)
    cfg = MigrateConfig(skip_agencies=tuple(scope_only(m.src, busiest_agency(m.src))))
    return agencies(m.src, cfg).select("agency_id", "agency_name", "feed_id")


@query("null_means_all")
def q_null_means_all(spark, sf):
    """H3 over the whole source fare-rule table: wildcard keys as -411."""
    from headway.functions.columns import null_means_all
    r = migration(spark, sf).src["fare_rules"]
    return r.select("fare_rule_id", *[null_means_all(c).alias(c) for c in
                                      ("route_id", "origin_id", "destination_id", "contains_id")])
