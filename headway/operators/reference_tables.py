"""Straight table migrations: project, filter, deduplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.config import MigrateConfig
from headway.functions.columns import ALL_ID, int_to_bool, flag_is_one, normalise_route_color
from headway.functions.geo import make_point
from headway.operators.scope import in_migrated_agencies, not_skipped

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
# Fixed value: name of the wildcard zone row (id -411).
WILDCARD_ZONE_NAME = "Wildcard: any or all zones for this agency."


def feeds(src, cfg: MigrateConfig) -> DataFrame:
    """Agency groups with at least one agency outside the skip list (B1)."""
    g, a = src["agency_groups"], src["agency_group_assoc"]
    return (g.join(a, g.agency_group_id == a.agency_group_id)
            .where(not_skipped(a.agency_id, cfg.skip_agencies))
            .select(g.agency_group_id.alias("feed_id"), g.group_name.alias("name"),
                    g.feed_contact_email.alias("contact_email"), g.feed_contact_url.alias("contact_url"),
                    g.feed_license.alias("license"), g.last_modified)
            .distinct())


def agencies(src, cfg: MigrateConfig) -> DataFrame:
    """Agencies joined to their group; an agency without a group is lost,
    one in two groups appears twice (B2, see key_audit)."""
    a, g = src["agency"], src["agency_group_assoc"]
    return (a.join(g, "agency_id")
            .where(not_skipped("agency_id", cfg.skip_agencies))
            .select("agency_id", "agency_id_import", "agency_url", "agency_timezone", "agency_lang_id", "agency_name",
                    "agency_short_name", "agency_phone", "agency_fare_url", "agency_info", "query_tracking",
                    "last_modified", "no_frequencies", F.col("agency_group_id").alias("feed_id"))
            .distinct())


def zones(src, cfg: MigrateConfig) -> DataFrame:
    """All zones (no agency filter) plus the wildcard zone -411, stamped
    with the run's timestamp and the blank import id that means "all" (B3)."""
    z = src["zones"].select("zone_id", F.col("zone_name").alias("name"), "agency_id", "last_modified", "zone_id_import")
    wildcard = z.sparkSession.range(1).select(
        F.lit(ALL_ID).cast(z.schema["zone_id"].dataType).alias("zone_id"),
        F.lit(WILDCARD_ZONE_NAME).alias("name"),
        F.lit(ALL_ID).cast(z.schema["agency_id"].dataType).alias("agency_id"),
        F.lit(cfg.run_ts).cast(z.schema["last_modified"].dataType).alias("last_modified"),
        F.lit("").alias("zone_id_import"))
    return z.unionByName(wildcard)


def stops_base(src, dst_agencies: DataFrame) -> DataFrame:
    """Stops of migrated agencies with feed, point and zone (B4); the time
    zone is added by ``spatial.assign_timezones``."""
    s, z = src["stops"], src["zones"].select("zone_id", F.lit(True).alias("_zone_ok"))
    a = dst_agencies.select("agency_id", "feed_id")
    return (s.join(z, "zone_id", "left")
            .join(a, "agency_id")
            .select("feed_id", "stop_id", "stop_code", "platform_code", "location_type",
                    F.col("parent_station").alias("parent_station_id"), F.col("stop_name").alias("name"),
                    "stop_desc", "stop_comments", "city", "direction_id", F.col("stop_url").alias("url"),
                    F.when(F.col("_zone_ok"), F.col("zone_id")).alias("zone_id"),
                    make_point("stop_lon", "stop_lat").alias("point"),
                    F.col("publish_status").alias("enabled"),
                    "agency_id"))


def routes(src, dst_agencies: DataFrame) -> DataFrame:
    """Colour clean-up and ``enabled = NOT hidden`` with NULL -> enabled."""
    r = in_migrated_agencies(src["routes"], dst_agencies)
    return r.select(
        "agency_id", "route_id", "route_short_name", "route_long_name",
        F.col("route_desc").alias("route_description"), "route_type",
        normalise_route_color("route_color", "#ffffff").alias("route_color"),
        normalise_route_color("route_text_color", "#000000").alias("route_text_color"),
        "route_url", "route_bikes_allowed", "route_id_import", "last_modified", "route_sort_order",
        F.when(F.col("hidden"), F.lit(False)).otherwise(F.lit(True)).alias("enabled"))


def headsigns(src, dst_agencies: DataFrame) -> DataFrame:
    h = in_migrated_agencies(src["headsigns"], dst_agencies)
    return (h.where(F.col("headsign_id").isNotNull() & F.col("headsign").isNotNull())
            .select("agency_id", "headsign_id", "headsign").distinct())


def calendars(src, dst_agencies: DataFrame) -> DataFrame:
    g = in_migrated_agencies(src["service_schedule_groups"], dst_agencies)
    return (g.where(F.col("service_schedule_group_id").isNotNull())
            .select("agency_id", F.col("service_schedule_group_id").alias("calendar_id"),
                    F.col("service_schedule_group_label").alias("name")))


def calendar_bounds(src, dst_agencies: DataFrame, dst_calendars: DataFrame) -> DataFrame:
    b = in_migrated_agencies(src["service_schedule_bounds"], dst_agencies)
    cal = dst_calendars.select(F.col("calendar_id").alias("_cid"))
    return (b.where(F.col("service_schedule_group_id").isNotNull())
            .join(cal, F.col("service_schedule_group_id") == cal["_cid"], "left_semi")
            .select("agency_id", F.col("service_schedule_group_id").alias("calendar_id"),
                    "start_date", "end_date"))


def calendar_dates(src, dst_agencies: DataFrame) -> DataFrame:
    d = in_migrated_agencies(src["calendar_dates"], dst_agencies)
    return d.select("calendar_date_id", "date", "agency_id", F.col("description").alias("name"), "last_modified")


def service_exceptions(src, dst_agencies: DataFrame, dst_calendars: DataFrame,
                       dst_calendar_dates: DataFrame, mode: str = "intent") -> DataFrame:
    """Calendar date exceptions (B11).  ``intent``: the date must exist in
    the migrated calendar dates.  ``literal``: the original statement's
    name binding, i.e. ``calendar_date_id = calendar.calendar_id`` while
    any calendar date exists."""
    e, c = src["calendar_date_service_exceptions"], src["calendar"]
    j = e.join(c, e.service_exception == c.calendar_id)
    aid = dst_agencies.select(F.col("agency_id").alias("_aid"))
    j = j.join(aid, e.agency_id == aid["_aid"], "left_semi")
    cal = dst_calendars.select(F.col("calendar_id").alias("_cid"))
    j = j.join(cal, e.service_exception == cal["_cid"], "left_semi")
    if mode == "intent":
        dates = dst_calendar_dates.select(F.col("calendar_date_id").alias("_did"))
        j = j.join(dates.hint("merge"), e.calendar_date_id == dates["_did"], "left_semi")
    elif mode == "literal":
        # the subquery yields calendar.calendar_id once per calendar date row:
        # true iff the ids match and at least one calendar date exists (a
        # scalar existence check read on the driver)
        j = j.where(e.calendar_date_id == c.calendar_id)
        if dst_calendar_dates.isEmpty():
            j = j.limit(0)
    else:
        raise ValueError(mode)
    return j.select(e.calendar_date_id, e.exception_type, e.service_exception.alias("calendar_id"),
                    *[int_to_bool(c[d]).alias(d) for d in WEEKDAYS], e.agency_id, e.last_modified)


def blocks(src, dst_agencies: DataFrame) -> DataFrame:
    b = in_migrated_agencies(src["blocks"], dst_agencies)
    return b.select("agency_id", "block_id", F.col("block_label").alias("name")).distinct()


def fare_attributes(src, dst_agencies: DataFrame) -> DataFrame:
    f = in_migrated_agencies(src["fare_attributes"], dst_agencies)
    return f.select("agency_id", "fare_id", "price", "currency_type", "payment_method", "transfers", "transfer_duration",
                    "last_modified", "fare_id_import")


def fare_rider_categories(src, dst_agencies: DataFrame, dst_fare_attributes: DataFrame,
                          mode: str = "intent") -> DataFrame:
    """``intent``: fare must exist in fare_attributes; ``literal``: the
    original compares fare ids with the agency ids of fare_attributes (B14)."""
    r = in_migrated_agencies(src["fare_rider_categories"], dst_agencies)
    ref_col = {"intent": "fare_id", "literal": "agency_id"}[mode]
    ref = dst_fare_attributes.select(F.col(ref_col).cast("bigint").alias("_ref"))
    r = r.join(ref.hint("merge"), r.fare_id == ref["_ref"], "left_semi")
    return r.select("fare_rider_category_id", "fare_id", "rider_category_custom_id", "price", "agency_id")


def transfers(src, dst_agencies: DataFrame) -> DataFrame:
    t = in_migrated_agencies(src["transfers"], dst_agencies)
    return t.select("transfer_id", "from_stop_id", "to_stop_id", "transfer_type", "min_transfer_time", "agency_id",
                    "last_modified", "from_stop_id_import", "to_stop_id_import")


def users(src) -> DataFrame:
    u = src["users"]
    return u.select("user_id", "email", "pass", "first_name", "last_name", "active", "registration_date",
                    flag_is_one("read_only").alias("read_only"), flag_is_one("admin").alias("admin"),
                    "language_id", "last_modified")


def user_permissions(src, dst_agencies: DataFrame, dst_users: DataFrame) -> DataFrame:
    up = src["user_permissions"]
    a = dst_agencies.select("agency_id")
    u = dst_users.select("user_id")
    return up.join(a, "agency_id").join(u, "user_id").select("permission_id", "agency_id", "user_id", up.last_modified)


CUSTOM_SHAPE_SEGMENTS_SCHEMA = T.StructType([
    T.StructField("pattern_id", T.LongType()),
    T.StructField("from_stop_id", T.LongType()),
    T.StructField("to_stop_id", T.LongType()),
    T.StructField("last_modified", T.TimestampType()),
])


def custom_shape_segments(spark: SparkSession) -> DataFrame:
    """Emptied on every reload and never filled."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in CUSTOM_SHAPE_SEGMENTS_SCHEMA.fields])
