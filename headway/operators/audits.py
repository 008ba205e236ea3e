"""Constraint audits and diagnostics, re-aimed as jobs.

Each audit is a union of small global aggregates (one row per rule), so a
whole audit is one Spark job with one short branch per rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import is_valid_css_color

# Foreign keys of the target schema (child, column, parent, column).
FOREIGN_KEYS = [
    ("calendar_bounds", "agency_id", "agencies", "agency_id"),
    ("calendar_bounds", "calendar_id", "calendars", "calendar_id"),
    ("calendar_date_service_exceptions", "agency_id", "agencies", "agency_id"),
    ("calendar_date_service_exceptions", "calendar_date_id", "calendar_dates", "calendar_date_id"),
    ("calendar_date_service_exceptions", "calendar_id", "calendars", "calendar_id"),
    ("calendar_dates", "agency_id", "agencies", "agency_id"),
    ("calendars", "agency_id", "agencies", "agency_id"),
    ("directions", "agency_id", "agencies", "agency_id"),
    ("fare_attributes", "agency_id", "agencies", "agency_id"),
    ("fare_rider_categories", "agency_id", "agencies", "agency_id"),
    ("fare_rider_categories", "fare_id", "fare_attributes", "fare_id"),
    ("fare_rules", "agency_id", "agencies", "agency_id"),
    ("fare_rules", "fare_id", "fare_attributes", "fare_id"),
    ("fare_rules", "contains_id", "zones", "zone_id"),
    ("fare_rules", "origin_id", "zones", "zone_id"),
    ("fare_rules", "destination_id", "zones", "zone_id"),
    ("headsigns", "agency_id", "agencies", "agency_id"),
    ("pattern_stops", "pattern_id", "patterns", "pattern_id"),
    ("pattern_stops", "stop_id", "stops", "stop_id"),
]

# Keys whose parent can't be deleted while a child row points to it (child, column);
# the other keys take their child rows along.
RESTRICT_KEYS = {
    ("calendar_bounds", "agency_id"), ("calendar_date_service_exceptions", "agency_id"), ("calendar_dates", "agency_id"),
    ("calendars", "agency_id"), ("directions", "agency_id"), ("fare_attributes", "agency_id"),
    ("fare_rider_categories", "agency_id"), ("fare_rules", "agency_id"), ("headsigns", "agency_id"),
    ("pattern_stops", "stop_id"),
}

# Primary keys and unique tuples (table, key columns).
UNIQUE_KEYS = [
    ("feeds", ["feed_id"]), ("agencies", ["agency_id"]), ("zones", ["zone_id"]), ("stops", ["stop_id"]),
    ("routes", ["route_id"]), ("headsigns", ["headsign_id"]), ("directions", ["direction_id"]),
    ("calendars", ["calendar_id"]), ("calendar_dates", ["calendar_date_id"]), ("blocks", ["block_id"]),
    ("fare_attributes", ["fare_id"]), ("fare_rules", ["fare_rule_id"]),
    ("fare_rules", ["agency_id", "fare_id", "route_id", "origin_id", "destination_id", "contains_id"]),
    ("users", ["user_id"]), ("transfers", ["transfer_id"]), ("patterns", ["pattern_id"]),
    ("timed_patterns", ["timed_pattern_id"]), ("shape_segments", ["from_stop_id", "to_stop_id"]),
    ("trips", ["trip_id"]),
]

# NOT NULL columns of the target schema, by table.
NOT_NULL = {
    "agencies": ["agency_id", "agency_url", "agency_timezone", "agency_name", "agency_short_name", "last_modified", "no_frequencies"],
    "blocks": ["agency_id", "block_id", "name"],
    "calendars": ["agency_id", "calendar_id", "name"],
    "calendar_bounds": ["agency_id", "calendar_id", "start_date", "end_date"],
    "calendar_dates": ["date"],
    "calendar_date_service_exceptions": ["calendar_date_id", "calendar_id", "monday", "tuesday", "wednesday", "thursday",
                                         "friday", "saturday", "sunday", "agency_id", "last_modified"],
    "directions": ["direction_id", "name"],
    "fare_attributes": ["fare_id", "price", "currency_type", "last_modified"],
    "fare_rider_categories": ["fare_rider_category_id"],
    "fare_rules": ["fare_rule_id", "is_combinable", "last_modified"],
    "feeds": ["feed_id", "name"],
    "headsigns": ["headsign_id", "headsign"],
    "patterns": ["agency_id", "pattern_id", "route_id"],
    "pattern_stops": ["agency_id", "pattern_id", "stop_order", "stop_id"],
    "routes": ["agency_id", "route_id", "route_short_name", "route_long_name", "route_id_import", "last_modified"],
    "shape_segments": ["from_stop_id", "to_stop_id"],
    "stops": ["stop_id", "location_type", "enabled"],
    "timed_patterns": ["agency_id", "timed_pattern_id", "pattern_id"],
    "timed_pattern_stops": ["stop_order", "pickup_type", "drop_off_type"],
    "trips": ["timed_pattern_id", "calendar_id", "agency_id", "start_time", "monday", "tuesday", "wednesday", "thursday",
              "friday", "saturday", "sunday"],
}
# Longest texts of the target schema, by table and column.
MAX_LENGTH = {
    "agencies": {"agency_id_import": 100, "agency_url": 255, "agency_timezone": 45, "agency_name": 120, "agency_short_name": 10,
                 "agency_phone": 70, "agency_fare_url": 255, "agency_info": 255},
    "calendars": {"name": 2044},
    "directions": {"name": 35},
    "fare_attributes": {"currency_type": 3},
    "feeds": {"name": 2044, "contact_email": 2044, "contact_url": 2044, "license": 2044},
    "headsigns": {"headsign": 105},
    "routes": {"route_short_name": 30, "route_long_name": 220, "route_url": 300, "route_id_import": 100},
    "stops": {"stop_code": 2044, "stop_desc": 2044, "stop_comments": 2044, "platform_code": 2044, "city": 2044, "url": 2044,
              "timezone": 2044},
}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fk_audit(m) -> DataFrame:
    """Orphan count per foreign key; a NULL child key passes (MATCH SIMPLE)."""
    tables = m.targets({t for child, _, parent, _ in FOREIGN_KEYS for t in (child, parent)})
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        c = tables[child].where(F.col(col).isNotNull()).select(F.col(col).cast("bigint").alias("_k"))
        p = tables[parent].select(F.col(pcol).cast("bigint").alias("_k")).distinct()
        orphans = c.join(p, "_k", "left_anti")
        parts.append(orphans.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("orphan_rows")).select(
            F.lit(f"{child}.{col} -> {parent}.{pcol}").alias("constraint_name"), "orphan_rows"))
    return _union(parts)


def key_audit(m) -> DataFrame:
    """Duplicate keys per primary key / unique tuple.  Rows with a NULL
    key part never collide in a unique index and are not counted."""
    tables = m.targets({t for t, _ in UNIQUE_KEYS})
    parts = []
    for table, cols in UNIQUE_KEYS:
        t = tables[table]
        if missing := [c for c in cols if c not in t.columns]:
            raise ValueError(f"key audit of {table}: no column {', '.join(missing)}")
        nn = t
        for c in cols:
            nn = nn.where(F.col(c).isNotNull())
        dup = nn.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        parts.append(dup.groupBy().agg(
            F.count(F.lit(1)).cast("bigint").alias("duplicate_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_in_duplicates")).select(
            F.lit(table).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
            "duplicate_keys", "rows_in_duplicates"))
    return _union(parts)


def check_audit(m) -> DataFrame:
    """NOT NULL, CHECK (block colour is a CSS colour) and length rules:
    one aggregate per table, one row per rule."""
    rules: dict[str, list] = {}
    for table, cols in NOT_NULL.items():
        rules.setdefault(table, []).extend((f"{table}.{c} not null", F.col(c).isNull()) for c in cols)
    for table, cols in MAX_LENGTH.items():
        rules.setdefault(table, []).extend((f"{table}.{c} length <= {n}", F.length(c) > n) for c, n in cols.items())
    rules["blocks"].append(("blocks.color is_valid_css_color", F.col("color").isNotNull() & ~is_valid_css_color("color")))
    tables = m.targets(set(rules))
    parts = []
    for table, checks in rules.items():
        counts = tables[table].groupBy().agg(*[
            F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"v{i}") for i, (_, bad) in enumerate(checks)])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, (name, _) in enumerate(checks)])).alias("r"))
            .select("r.*"))
    return _union(parts)


def prune_orphans(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """J4 for one key: children whose parent is gone are dropped; NULL child
    keys stay (``cascade.prune_orphans`` follows every key)."""
    p = parent.select(F.col(pcol).alias("_pk")).distinct()
    return child.join(p, child[col] == p["_pk"], "left_semi").unionByName(child.where(F.col(col).isNull()))


def frequency_parity(src, m) -> DataFrame:
    """Per route, frequency rows in the source vs trips with a headway
    in the target."""
    s = (src["frequencies"].join(src["trips"].select("trip_id", "route_id"), "trip_id")
         .groupBy("route_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_source")))
    t = (m.trip_rows.where(F.col("headway_secs").isNotNull()).select("timed_pattern_id")
         .join(m.timed_patterns.select("timed_pattern_id", "pattern_id"), "timed_pattern_id")
         .join(m.patterns_base.select("pattern_id", "route_id"), "pattern_id")
         .groupBy("route_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_target")))
    return (s.join(t, "route_id", "full")
            .select("route_id", F.coalesce("n_source", F.lit(0)).alias("n_source"),
                    F.coalesce("n_target", F.lit(0)).alias("n_target")))


def frequency_rows(src, m) -> tuple[DataFrame, DataFrame]:
    """Frequency rows of the source and trips with a headway of the target, in the same columns."""
    cols = ["route_id", "start_time", "end_time", "headway_secs"]
    s = src["frequencies"].join(src["trips"].select("trip_id", "route_id"), "trip_id")
    t = (m.trip_rows.where(F.col("headway_secs").isNotNull())
         .join(m.timed_patterns.select("timed_pattern_id", "pattern_id").distinct(), "timed_pattern_id")
         .join(m.patterns_base.select("pattern_id", "route_id").distinct(), "pattern_id"))
    return tuple(df.select(F.col("route_id"), *[F.col(c).cast("bigint").alias(c) for c in cols[1:]]) for df in (s, t))


def row_difference(a: DataFrame, b: DataFrame, a_name: str = "source", b_name: str = "target") -> DataFrame:
    """The multiset difference both ways: rows one side holds more often, with
    ``side`` and ``n_rows``, how many more.  One shuffle of partial counts."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_n")).unionByName(b.select(*cols, F.lit(-1).alias("_n")))
    more = both.groupBy(*cols).agg(F.sum("_n").cast("bigint").alias("_n")).where(F.col("_n") != 0)
    return more.select(*cols, F.when(F.col("_n") > 0, a_name).otherwise(b_name).alias("side"), F.abs("_n").alias("n_rows"))


def frequency_difference(src, m) -> DataFrame:
    """Frequency rows that the source and the target don't share."""
    return row_difference(*frequency_rows(src, m))


def based_on_missing_start(src, m) -> DataFrame:
    """Child trips that, like their base, have no start time."""
    trips = src["trips"]
    b = trips.select(*[F.col(c).alias("b_" + c) for c in trips.columns])
    base = trips.join(m.agencies.select("agency_id"), "agency_id", "left_semi")
    freq = src["frequencies"].select(F.col("trip_id").alias("_fid"))
    cal = src["calendar"]
    pt = m.patterns_trips.select(F.col("trip_id").alias("_pt"), "timed_pattern_id")
    j = (b.join(base, b.b_based_on == base.trip_id)
         .where(F.col("b_trip_start_time").isNull() & F.col("trip_start_time").isNull()
                & F.col("b_service_id").isNotNull())
         .join(freq, F.col("trip_id") == freq["_fid"], "left_anti")
         .join(pt, F.col("trip_id") == pt["_pt"])
         .join(cal, F.col("b_service_id") == cal.calendar_id))
    return j.select(F.col("b_trip_id"), F.col("trip_id").alias("base_trip_id"), F.col("b_agency_id").alias("agency_id"),
                    "timed_pattern_id", cal.service_schedule_group_id.alias("calendar_id"))


def trip_chain_counts(src, m) -> DataFrame:
    """Row counts after each join of the scheduled-trip chain."""
    t = src["trips"]
    s1 = t.join(src["calendar"], t.service_id == src["calendar"].calendar_id)
    s2 = s1.join(m.first_arrivals, "trip_id")
    s3 = s2.join(m.patterns_trips.select("trip_id", "timed_pattern_id"), "trip_id")
    stages = [(1, "trips", t), (2, "with calendar", s1), (3, "with first arrival", s2), (4, "with timed pattern", s3)]
    return _union([df.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
        F.lit(i).alias("stage_order"), F.lit(name).alias("stage"), "n_rows") for i, name, df in stages])


def stop_lookup(m, stop_id: int) -> DataFrame:
    """The stop migration for one stop (a lookup, by design one id)."""
    return m.stops.where(F.col("stop_id") == stop_id)
