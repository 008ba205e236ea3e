"""Pattern mining: trips with equal stop lists and relative times collapse
into timed patterns (C1-C15).

Plan shape (see README, "Scale"):

1. ``trip_stop_rows``: stop_times joined to trips and grouped by
   ``trip_id`` -- the only shuffle of stop_times (first arrivals, D1, are
   read off the same arrays).  Each trip carries its
   stop rows as an ordered array (a trip has a bounded number of stops).
2. ``trip_signatures``: stop list text and time signatures per trip, pure
   higher-order Column expressions over that array.
3. ``pattern_time_intervals``: a hash aggregate on the pattern key
   (partial aggregation first, so a pattern shared by a third of all trips
   is still combined map-side); the trip list is kept as a membership
   table, never collected into one array.
4. Dense ids over patterns (``ids.dense_id``); every join and test that
   needs one row per timed pattern comes before the representative trip's
   rows are exploded into the wide table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.columns import ordered_join
from headway.operators.ids import dense_id
from headway.operators.keydict import KeyDictionary, fingerprint
from headway.operators.losses import Losses, drop
from headway.operators.scope import in_migrated_agencies, not_skipped
from headway.session import scratch_table

PATTERN_KEY = ["stops_pattern", "arrival_time_intervals", "departure_time_intervals",
               "agency_id", "route_id", "direction_id"]


def trip_stop_rows(src, dst_agencies: DataFrame, cfg: MigrateConfig) -> DataFrame:
    """One row per trip with its stop_times rows sorted by stop_sequence --
    the only shuffle of stop_times in a run (the first-arrival table D1 is
    read off the same arrays).  ``is_base`` marks trips with ``based_on IS
    NULL`` (the pattern jobs use only those).  Each stop row records whether
    it passes the skip list (``keep``, filters C1-C3), whether its agency
    was migrated (``in_dst``, filters C5 and D1) and whether the source has
    its agency at all (``known``, C8)."""
    st = src["stop_times"]
    trips = (src["trips"]
             .select("trip_id", F.col("agency_id").alias("trip_agency_id"), "route_id",
                     "direction_id", F.col("headsign_id").alias("trip_headsign_id"),
                     F.col("based_on").isNull().alias("trip_is_base")))
    aid = dst_agencies.select(F.col("agency_id").alias("_aid")).distinct().withColumn("_in_dst", F.lit(True))
    every = src["agency"].select(F.col("agency_id").alias("_kid")).distinct()
    st = st.join(aid, st.agency_id == aid["_aid"], "left").join(every, F.col("agency_id") == every["_kid"], "left")
    row = F.struct(
        F.col("stop_sequence").isNull().alias("seq_last"), F.col("stop_sequence").alias("seq"), F.col("stop_id").alias("stop_id"),
        F.col("arrival_time").alias("arr"), F.col("departure_time").alias("dep"),
        F.col("pickup_type").alias("pickup_type"), F.col("drop_off_type").alias("drop_off_type"),
        F.col("headsign_id").alias("stop_headsign_id"), F.col("agency_id").alias("st_agency_id"),
        not_skipped(F.col("agency_id"), cfg.skip_agencies).alias("keep"),
        F.coalesce(F.col("_in_dst"), F.lit(False)).alias("in_dst"), F.col("_kid").isNotNull().alias("known"))
    grouped = (st.join(trips.hint("merge"), "trip_id")
               .groupBy("trip_id")
               .agg(F.first("trip_agency_id").alias("agency_id"), F.first("route_id").alias("route_id"),
                    F.first("direction_id").alias("direction_id"),
                    F.first("trip_headsign_id").alias("trip_headsign_id"),
                    F.first("trip_is_base").alias("is_base"),
                    F.array_sort(F.collect_list(row)).alias("rows")))
    return trip_signatures(grouped)


def trip_signatures(per_trip: DataFrame) -> DataFrame:
    """C1-C3 on the ordered row array.

    * ``stops_pattern``: stop ids joined by ', ' (kept rows).
    * ``arrival_time_intervals``: arrival minus the trip's minimum arrival,
      '' where the arrival is NULL, joined by ','.
    * ``departure_time_intervals``: gated on the *arrival*; a row with an
      arrival but no departure contributes nothing (trap T2).
    * ``stops_pattern_all``: stop list over all rows (C6 has no skip list).
    """
    kept = F.filter("rows", lambda r: r["keep"])
    in_dst = F.filter("rows", lambda r: r["in_dst"])
    step = per_trip.select("*", kept.alias("_kept"), in_dst.alias("_dst")).select(       # each list is filtered once
        "*",
        F.array_min(F.col("_kept.arr")).alias("min_arrival_time"),
        F.array_min(F.col("_kept.dep")).alias("min_departure_time"),
        (F.size("_dst") > 0).alias("has_dst"),
        F.array_min(F.col("_dst.arr")).alias("rep_min_arrival_time"),
        F.array_min(F.col("_dst.dep")).alias("rep_min_departure_time"))
    arr_sig = F.array_join(F.transform("_kept", lambda r: F.when(
        r["arr"].isNotNull(), (r["arr"] - F.col("min_arrival_time")).cast("string")).otherwise(F.lit(""))), ",")
    dep_sig = ordered_join(F.transform("_kept", lambda r: F.when(
        r["arr"].isNotNull(), (r["dep"] - F.col("min_departure_time")).cast("string")).otherwise(F.lit(""))), ",")
    return step.select(
        "trip_id", "agency_id", "route_id", "direction_id", "trip_headsign_id", "is_base",
        (F.size("_kept") > 0).alias("has_kept"),
        ordered_join(F.transform("_kept", lambda r: r["stop_id"].cast("string")), ", ").alias("stops_pattern"),
        F.when(F.size("_kept") > 0, arr_sig).alias("arrival_time_intervals"),
        dep_sig.alias("departure_time_intervals"),
        "min_arrival_time", "min_departure_time",
        ordered_join(F.transform("rows", lambda r: r["stop_id"].cast("string")), ", ").alias("stops_pattern_all"),
        "has_dst", "rep_min_arrival_time", "rep_min_departure_time", "rows")


def _pattern_trips(per_trip: DataFrame, dst_agencies: DataFrame, children: bool = False) -> DataFrame:
    """Trips feeding C4: base trips (with ``children`` all trips) with skip-list rows, agency migrated."""
    trips = per_trip if children else per_trip.where("is_base")
    return in_migrated_agencies(trips.where("has_kept"), dst_agencies)


def pattern_time_intervals(per_trip: DataFrame, dst_agencies: DataFrame) -> DataFrame:
    """C4: one row per (stops, signatures, agency, route, direction) with the
    representative ``one_trip = min(trip_id)`` and the trip count.  NULL key
    parts group together.  Partial aggregation keeps hot patterns cheap."""
    return (_pattern_trips(per_trip, dst_agencies)
            .groupBy(*PATTERN_KEY)
            .agg(F.min("trip_id").alias("one_trip"), F.count(F.lit(1)).alias("trip_count"),
                 F.min_by("has_dst", "trip_id").alias("one_has_dst")))


def timed_pattern_keys(pti: DataFrame, known: KeyDictionary | None = None, losses: Losses | None = None) -> DataFrame:
    """``timed_pattern_id`` numbered by ``one_trip`` (unique per pattern), or looked up by pattern key in the
    dictionary of earlier reloads (A9).  Patterns whose representative has no migrated stop row vanish."""
    keys = drop(pti, losses, "timed pattern", {"representative without a migrated stop row": ~F.col("one_has_dst")},
                F.col("trip_count")).drop("one_has_dst")
    return known.assign(keys, PATTERN_KEY, "timed_pattern_id", ["one_trip"]) if known else dense_id(keys, ["one_trip"], "timed_pattern_id")


def representative_rows(keys: DataFrame, per_trip: DataFrame) -> DataFrame:
    """The numbered patterns with the minimum times re-derived from the representative trip's migrated stop
    rows, and these rows.  They join after the id step, which never moves the row arrays."""
    rep = per_trip.where(F.col("is_base") & F.col("has_dst")).select(
        F.col("trip_id").alias("one_trip"), "trip_headsign_id",
        F.col("rep_min_arrival_time").alias("min_arrival_time"),
        F.col("rep_min_departure_time").alias("min_departure_time"), "rows")
    return keys.join(rep.hint("merge"), "one_trip")


def timed_patterns(pti: DataFrame, per_trip: DataFrame, known: KeyDictionary | None = None, losses: Losses | None = None) -> DataFrame:
    """C5 + C7: the numbered patterns with their representative's stop rows."""
    return representative_rows(timed_pattern_keys(pti, known, losses), per_trip)


def distinct_stop_patterns(per_trip: DataFrame, dst_agencies: DataFrame) -> DataFrame:
    """Distinct (stop list, route, direction) over base trips of migrated agencies."""
    trips = in_migrated_agencies(per_trip.where("is_base"), dst_agencies)
    return trips.select(F.col("stops_pattern_all").alias("stops_pattern"), "route_id", "direction_id").distinct()


def stop_patterns(per_trip: DataFrame, dst_agencies: DataFrame, known: KeyDictionary | None = None) -> DataFrame:
    """C6 + C7: ``pattern_id`` numbered by the three columns of a stop
    pattern, or looked up by them (A9)."""
    distinct = distinct_stop_patterns(per_trip, dst_agencies)
    key = ["stops_pattern", "route_id", "direction_id"]
    return known.assign(distinct, key, "pattern_id") if known else dense_id(distinct, key, "pattern_id")


def _known_rows() -> Column:
    """A representative's stop rows whose agency the source has."""
    return F.filter("rows", lambda r: r["known"])


def resolve_patterns(tp: DataFrame, sp: DataFrame, src, losses: Losses | None = None) -> DataFrame:
    """C8's key joins and C9, before any stop row is exploded: the timed
    patterns that reach the wide table with their ``pattern_id``, as a
    written table.  ``has_rows`` tells whether the representative has stop
    rows there (rows whose agency the source has).

    Stop patterns join with plain ``=``, so patterns of trips without a
    direction drop out (T1).  A pattern that names a stop absent from the
    source stops goes with all its timed patterns (stop ids are the source
    key, never NULL there); that is tested on the distinct stops of each
    pattern.
    """
    routes = src["routes"].select("route_id").distinct().withColumn("_route", F.lit(True))
    used = F.array_distinct(F.transform(_known_rows(), lambda r: r["stop_id"]))
    keyed = (tp.select("timed_pattern_id", "one_trip", "trip_count", "stops_pattern", "agency_id", "route_id", "direction_id", "trip_headsign_id",
                       used.alias("_stops"))
             .join(sp.hint("merge"), ["stops_pattern", "route_id", "direction_id"], "left")
             .join(routes, "route_id", "left"))
    bad = (keyed.where(F.col("pattern_id").isNotNull() & F.col("_route"))
           .select("pattern_id", F.explode("_stops").alias("stop_id")).where(F.col("stop_id").isNotNull()).distinct()
           .join(src["stops"].select("stop_id"), "stop_id", "left_anti")
           .select("pattern_id").distinct().withColumn("_bad", F.lit(True)))
    marked = keyed.withColumn("has_rows", F.size("_stops") > 0).drop("_stops").join(bad.hint("merge"), "pattern_id", "left")
    kept = drop(marked, losses, "wide table", {
        "no direction": F.col("direction_id").isNull(),
        "no route": F.col("_route").isNull(),
        "no stop pattern": F.col("pattern_id").isNull(),
        "stop not in the source": F.col("_bad").isNotNull()}, F.col("trip_count"))
    return scratch_table(kept.select("timed_pattern_id", "one_trip", "pattern_id", "agency_id", "route_id", "direction_id", "trip_headsign_id",
                                     "has_rows"), "resolved-patterns")


def wide_patterns(resolved: DataFrame, src) -> DataFrame:
    """The columns of the wide table that one value per timed pattern decides,
    one row each: the ids that C10, C11, B7 and D3 need, which read no stop row."""
    directions = src["directions"].select("direction_id", F.col("direction_label").alias("direction_name"))
    heads = src["headsigns"].select("headsign_id").distinct()
    return (resolved.where("has_rows").join(directions, "direction_id", "left")
            .join(heads, F.col("trip_headsign_id") == heads["headsign_id"], "left")
            .select("agency_id", "timed_pattern_id", "pattern_id", "route_id", "direction_id", "direction_name",
                    F.col("headsign_id").alias("trip_headsign_id")))


def assemble_tpsn(tp: DataFrame, resolved: DataFrame, src) -> DataFrame:
    """The wide table.  Everything that one value per timed pattern
    decides is joined before the representative's stop rows are exploded, and
    ``stop_order`` (a dense rank by stop sequence) is read off the ordered
    row array, so no exploded row is shuffled.  A representative trip stands
    for one timed pattern, and both sides meet on it, where the arrays lie."""
    routes = src["routes"].select("route_id", "route_short_name", "route_long_name")
    directions = src["directions"].select("direction_id", F.col("direction_label").alias("direction_name"))
    heads = src["headsigns"].select(F.col("headsign_id").alias("trip_headsign_id"),
                                    F.col("headsign").alias("trip_headsign"))
    agency = src["agency"].select(F.col("agency_id").alias("_st_agency_id"), "agency_name")
    joined = (tp.join(resolved.select("one_trip", "pattern_id").hint("merge"), "one_trip").join(routes, "route_id")
              .join(directions, "direction_id", "left")
              .join(heads.withColumn("_hs", F.col("trip_headsign_id")), "trip_headsign_id", "left"))
    ranked = joined.withColumn("rows", _known_rows()).withColumn("_seqs", F.array_distinct(F.transform("rows", lambda r: r["seq"])))
    # the array is sorted by sequence with NULL last; NULL has the last rank
    order = F.when(F.col("r.seq").isNull(), F.size("_seqs").cast("bigint")).otherwise(F.array_position("_seqs", F.col("r.seq")))
    rows = ranked.select(
        "agency_id", "route_id", "direction_id", "route_short_name", "route_long_name", "direction_name", "_hs", "trip_headsign",
        "timed_pattern_id", "pattern_id", "one_trip", "stops_pattern", "arrival_time_intervals", "departure_time_intervals",
        "min_arrival_time", "min_departure_time", "_seqs", F.explode("rows").alias("r")).withColumn("stop_order", order).drop("_seqs")
    wide = rows.join(agency, F.col("r.st_agency_id") == agency["_st_agency_id"])
    return wide.select(
        "agency_id", "agency_name", "route_short_name", "route_long_name", "direction_name", "direction_id",
        F.col("_hs").alias("trip_headsign_id"), "trip_headsign", F.col("r.stop_id").alias("stop_id"), "stop_order",
        "timed_pattern_id", "pattern_id",
        (F.col("r.arr") - F.col("min_arrival_time")).alias("arrival_time"),
        (F.col("r.dep") - F.col("min_departure_time")).alias("departure_time"),
        F.coalesce(F.col("r.pickup_type"), F.lit(0)).alias("pickup_type"),
        F.coalesce(F.col("r.drop_off_type"), F.lit(0)).alias("drop_off_type"),
        "one_trip", "stops_pattern", "arrival_time_intervals", "departure_time_intervals", "route_id",
        F.col("r.stop_headsign_id").alias("stop_headsign_id"),
        F.col("r.seq").alias("stop_sequence"))


def heavy_threshold(keys: DataFrame) -> int:
    """Trips that a salt of a pattern holds: a sixteenth of a join partition's even share."""
    spark = keys.sparkSession
    total = keys.agg(F.sum("trip_count").alias("n")).first()["n"] or 0        # one value
    return max(1, -(-int(total) // (16 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def pattern_members(per_trip: DataFrame, tp: DataFrame, dst_agencies: DataFrame, children: bool = False) -> DataFrame:
    """The trip list of each timed pattern as a table (trip_id,
    timed_pattern_id, min_arrival_time); ordering a pattern's trips by
    ``min_arrival_time`` reproduces the original array order.  With
    ``children`` the list also holds the based-on trips whose own stop rows
    have the pattern's key (D9).

    Trips and patterns meet on a 128-bit fingerprint of the six-column key,
    so the texts aren't shuffled.  C4 knows every pattern's trip count:
    patterns with more than ``heavy_threshold`` trips are dealt over as many
    salts as they hold thresholds.  There are at most sixteen such patterns per
    shuffle partition, which bounds the list that is broadcast to salt their
    trips.
    """
    trips = _pattern_trips(per_trip, dst_agencies, children).select(*fingerprint(PATTERN_KEY), "trip_id", "min_arrival_time")
    keys = tp.select(*fingerprint(PATTERN_KEY), "timed_pattern_id", "trip_count")
    share = heavy_threshold(keys)
    keys = keys.withColumn("_salts", F.ceil(F.col("trip_count") / share).cast("int"))
    heavy = keys.where(F.col("_salts") > 1).select(F.col("_hw_f1").alias("_h1"), F.col("_hw_f2").alias("_h2"), "_salts")
    salted = (trips.join(F.broadcast(heavy), (F.col("_hw_f1") == F.col("_h1")) & (F.col("_hw_f2") == F.col("_h2")), "left")
              .select("_hw_f1", "_hw_f2", "trip_id", "min_arrival_time",
                      F.coalesce(F.pmod(F.xxhash64("trip_id"), F.col("_salts")), F.lit(0)).cast("int").alias("_salt")))
    dealt = keys.select("_hw_f1", "_hw_f2", "timed_pattern_id", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    return salted.join(dealt.hint("merge"), ["_hw_f1", "_hw_f2", "_salt"]).select("timed_pattern_id", "trip_id", "min_arrival_time")


# ---- C10-C15: tables read off the wide table, or (patterns, headsigns, timed patterns) its ``wide_patterns`` ----

def patterns(tpsn: DataFrame) -> DataFrame:
    return tpsn.select("agency_id", "pattern_id", "route_id", "direction_id").distinct()


def pattern_headsigns(pats: DataFrame, tpsn: DataFrame) -> DataFrame:
    """C11: a pattern gets a headsign only when its rows name exactly one
    distinct non-NULL trip headsign."""
    one = (tpsn.where(F.col("trip_headsign_id").isNotNull())
           .groupBy("pattern_id", "agency_id", "route_id", "direction_id")
           .agg(F.countDistinct("trip_headsign_id").alias("_n"), F.min("trip_headsign_id").alias("_h"))
           .where(F.col("_n") == 1)
           .groupBy("pattern_id").agg(F.min("_h").alias("headsign_id")))
    return pats.join(one.hint("merge"), "pattern_id", "left")


def pattern_stops(tpsn: DataFrame, dst_agencies: DataFrame) -> DataFrame:
    return in_migrated_agencies(tpsn, dst_agencies).select(
        "agency_id", "pattern_id", "stop_order", "stop_id").distinct()


def timed_patterns_table(tpsn: DataFrame) -> DataFrame:
    return tpsn.select("agency_id", "timed_pattern_id", "pattern_id").distinct()


def timed_pattern_stops(tpsn: DataFrame) -> DataFrame:
    return tpsn.select("agency_id", "timed_pattern_id", "stop_order", "stop_id", "arrival_time",
                       "departure_time", "pickup_type", "drop_off_type",
                       F.col("stop_headsign_id").alias("headsign_id")).distinct()


def multi_route_patterns(patterns_base: DataFrame) -> DataFrame:
    """Patterns used by several agencies, routes or directions, counted
    over the patterns table, which has each combination once."""
    return (patterns_base.groupBy("pattern_id")
            .agg(*[F.size(F.collect_set(f"{c}_id")).cast("bigint").alias(f"{c}_count") for c in ("agency", "route", "direction")]))
