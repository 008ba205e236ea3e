"""Trip materialisation: each trip becomes (timed pattern, start, calendar)
(D1-D9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.columns import flag_is_one, int_to_bool, ordered_join
from headway.operators.ids import dense_id, rank_within
from headway.operators.keydict import KeyDictionary
from headway.operators.losses import Losses, drop
from headway.operators.reference_tables import WEEKDAYS
from headway.operators.scope import in_migrated_agencies, not_skipped

TRIP_COLUMNS = ["agency_id", "timed_pattern_id", "calendar_id", "start_time", "end_time", "headway_secs",
                "block_id", *WEEKDAYS, "in_seat_transfer"]


def first_arrival_rows(per_trip: DataFrame, cfg: MigrateConfig) -> DataFrame:
    """D1 before projection: among a trip's stop rows of migrated agencies,
    the row(s) holding the smallest stop_sequence; ties keep every row.
    Read off the per-trip arrays, so stop_times is not shuffled again."""
    rows = F.filter("rows", lambda r: r["in_dst"])
    first_seq = F.array_min(F.transform(rows, lambda r: r["seq"]))
    firsts = F.filter(rows, lambda r: r["seq"] == first_seq)
    return (per_trip.where(not_skipped("trip_id", cfg.skip_trips))
            .select("trip_id", F.explode(firsts).alias("r"))
            .select("trip_id", F.col("r.seq").alias("stop_sequence"), F.col("r.arr").alias("arrival_time")))


def first_arrivals(per_trip: DataFrame, cfg: MigrateConfig) -> DataFrame:
    return first_arrival_rows(per_trip, cfg).select(
        "trip_id", F.col("arrival_time").alias("first_arrival_time"))


def first_arrival_duplicates(rows: DataFrame) -> DataFrame:
    """Trips with more than one first-arrival row."""
    agg = rows.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("stop_sequence", "arrival_time"))).alias("_r"))
    return agg.where(F.col("n_rows") > 1).select(
        "trip_id", "n_rows",
        ordered_join(F.transform("_r", lambda r: r["stop_sequence"].cast("string")), ",").alias("stop_sequences"),
        ordered_join(F.transform("_r", lambda r: r["arrival_time"].cast("string")), ",").alias("arrival_times"))


def patterns_trips(members: DataFrame, tpsn: DataFrame, dst_agencies: DataFrame) -> DataFrame:
    """D3: (timed pattern, agency, trip) for timed patterns that survived
    into the wide table."""
    tp = in_migrated_agencies(tpsn.select("timed_pattern_id", "agency_id").distinct(), dst_agencies)
    return members.join(tp.hint("merge"), "timed_pattern_id").select("timed_pattern_id", "agency_id", "trip_id").distinct()


def _weekdays(cal) -> list:
    return [int_to_bool(cal[d]).alias(d) for d in WEEKDAYS]


# Tables with a row per trip, frequency or pattern grow with the run.  They meet by sort-merge joins: compressed,
# such a table can look small enough to broadcast while its rows fill the driver.
def _freq_ids(src) -> DataFrame:
    return src["frequencies"].select(F.col("trip_id").alias("_fid")).hint("merge")


def scheduled_trips(src, dst_agencies, first_arr, pt, losses: Losses | None = None) -> DataFrame:
    """Base trips without frequencies; one row per trip and distinct
    start time (the original GROUP BY includes trip_id)."""
    t = in_migrated_agencies(src["trips"].where(F.col("based_on").isNull()), dst_agencies)
    freq = _freq_ids(src)
    t = t.join(freq, t.trip_id == freq["_fid"], "left_anti")
    cal = src["calendar"]
    first = first_arr.select("trip_id", "first_arrival_time", F.lit(True).alias("_first"))
    j = (t.join(cal, t.service_id == cal.calendar_id, "left")
         .join(first.hint("merge"), "trip_id", "left")
         .join(pt.select("trip_id", "timed_pattern_id").hint("merge"), "trip_id", "left"))
    j = drop(j, losses, "scheduled trips", {
        "no service": t.service_id.isNull(),
        "no calendar": cal.calendar_id.isNull(),
        "no first stop row": F.col("_first").isNull(),
        "first stop without an arrival": F.col("first_arrival_time").isNull(),
        "no timed pattern": F.col("timed_pattern_id").isNull(),
        "calendar without a schedule group": cal.service_schedule_group_id.isNull()})
    out = j.select(
        t.agency_id, F.col("timed_pattern_id"), cal.service_schedule_group_id.alias("calendar_id"),
        F.col("first_arrival_time").cast("bigint").alias("start_time"),
        F.lit(None).cast("bigint").alias("end_time"), F.lit(None).cast("int").alias("headway_secs"),
        t.block_id, *_weekdays(cal), flag_is_one(t.in_seat_transfer).alias("in_seat_transfer"),
        t.trip_id.alias("_trip"), cal.calendar_id.alias("_cal"), t.in_seat_transfer.alias("_ist"))
    return out.dropDuplicates().select(*TRIP_COLUMNS)


def _child_base(src, dst_agencies):
    trips = src["trips"]
    b = trips.select(*[F.col(c).alias("b_" + c) for c in trips.columns])
    base = in_migrated_agencies(trips, dst_agencies)
    return b.join(base.hint("merge"), b.b_based_on == base.trip_id), base


def based_on_trips(src, dst_agencies, pt, losses: Losses | None = None) -> DataFrame:
    """A child trip reuses its base trip's timed pattern; start is
    ``coalesce(child, base)``.  Frequencies are checked on the base (T12)
    and children identical in the grouping columns collapse."""
    j, base = _child_base(src, dst_agencies)
    freq = _freq_ids(src)
    j = j.join(freq, F.col("trip_id") == freq["_fid"], "left_anti")
    cal = src["calendar"]
    start = F.coalesce(F.col("b_trip_start_time"), F.col("trip_start_time")).cast("bigint")
    j = (j.join(pt.select(F.col("trip_id").alias("_pt_trip"), "timed_pattern_id").hint("merge"),
                F.col("trip_id") == F.col("_pt_trip"), "left")
         .join(cal, F.col("b_service_id") == cal.calendar_id, "left"))
    j = drop(j, losses, "based-on trips", {
        "no service": F.col("b_service_id").isNull(),
        "no calendar": cal.calendar_id.isNull(),
        "no start time": start.isNull(),
        "no timed pattern": F.col("timed_pattern_id").isNull(),
        "calendar without a schedule group": cal.service_schedule_group_id.isNull()})
    out = j.select(
        F.col("b_agency_id").alias("agency_id"), "timed_pattern_id",
        cal.service_schedule_group_id.alias("calendar_id"), start.alias("start_time"),
        F.lit(None).cast("bigint").alias("end_time"), F.lit(None).cast("int").alias("headway_secs"),
        F.col("b_block_id").alias("block_id"), *_weekdays(cal),
        flag_is_one(F.col("in_seat_transfer")).alias("in_seat_transfer"),
        cal.calendar_id.alias("_cal"), F.col("trip_id").alias("_base"), F.col("b_in_seat_transfer").alias("_ist"))
    key = ["agency_id", "timed_pattern_id", "_cal", "start_time", "_base", "block_id", *WEEKDAYS, "_ist"]
    return out.dropDuplicates(key).select(*TRIP_COLUMNS)


def frequency_based_on_trips(src, dst_agencies, pt) -> DataFrame:
    """Frequency rows of child trips, pattern of the base; no schedule
    group filter and no deduplication."""
    j, base = _child_base(src, dst_agencies)
    freq = src["frequencies"].select(F.col("trip_id").alias("_f_trip"), "start_time", "end_time", "headway_secs")
    cal = src["calendar"]
    j = (freq.join(j.hint("merge"), freq["_f_trip"] == F.col("b_trip_id"))
         .where(F.col("b_service_id").isNotNull() & F.col("b_based_on").isNotNull())
         .join(pt.select(F.col("trip_id").alias("_pt_trip"), "timed_pattern_id").hint("merge"),
               F.col("trip_id") == F.col("_pt_trip"))
         .join(cal, F.col("b_service_id") == cal.calendar_id))
    return j.select(
        F.col("b_agency_id").alias("agency_id"), "timed_pattern_id",
        cal.service_schedule_group_id.alias("calendar_id"),
        freq["start_time"].cast("bigint").alias("start_time"), freq["end_time"].cast("bigint").alias("end_time"),
        freq["headway_secs"].cast("int").alias("headway_secs"), F.col("b_block_id").alias("block_id"),
        *_weekdays(cal), flag_is_one(F.col("b_in_seat_transfer")).alias("in_seat_transfer"))


def frequency_trips(src, dst_agencies, pt) -> DataFrame:
    """Frequency rows of base trips."""
    t = in_migrated_agencies(src["trips"].where(F.col("based_on").isNull() & F.col("service_id").isNotNull()),
                             dst_agencies)
    freq = src["frequencies"].select("trip_id", "start_time", "end_time", "headway_secs")
    cal = src["calendar"]
    j = (freq.join(t.hint("merge"), "trip_id").join(pt.select("trip_id", "timed_pattern_id").hint("merge"), "trip_id")
         .join(cal, t.service_id == cal.calendar_id))
    return j.select(
        t.agency_id, "timed_pattern_id", cal.service_schedule_group_id.alias("calendar_id"),
        freq["start_time"].cast("bigint").alias("start_time"), freq["end_time"].cast("bigint").alias("end_time"),
        freq["headway_secs"].cast("int").alias("headway_secs"), t.block_id, *_weekdays(cal),
        flag_is_one(t.in_seat_transfer).alias("in_seat_transfer"))


def trip_rows(src, dst_agencies, first_arr, pt, losses: Losses | None = None) -> DataFrame:
    """D8 without ids: the four branches as UNION ALL."""
    parts = [scheduled_trips(src, dst_agencies, first_arr, pt, losses),
             based_on_trips(src, dst_agencies, pt, losses),
             frequency_based_on_trips(src, dst_agencies, pt),
             frequency_trips(src, dst_agencies, pt)]
    tagged = None
    for i, p in enumerate(parts, start=1):
        p = p.withColumn("trip_source", F.lit(i))
        tagged = p if tagged is None else tagged.unionByName(p)
    return tagged


def trips(rows: DataFrame, known: KeyDictionary | None = None) -> DataFrame:
    """The union with its own dense ``trip_id`` (branch, then every
    column, NULLs last).  With a dictionary of earlier reloads (A9) a trip's
    key is every column and its number among equal rows."""
    key = ["trip_source", *TRIP_COLUMNS]
    if known is None:
        return dense_id(rows, key, "trip_id")
    return known.assign(rank_within(rows, key, [], "_hw_copy"), [*key, "_hw_copy"], "trip_id").drop("_hw_copy")


def trips_legacy_union(src, dst_agencies, first_arr, pt) -> DataFrame:
    """The older runner combined the branches with a set UNION."""
    parts = [scheduled_trips(src, dst_agencies, first_arr, pt),
             based_on_trips(src, dst_agencies, pt),
             frequency_based_on_trips(src, dst_agencies, pt),
             frequency_trips(src, dst_agencies, pt)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def trips_legacy_own_list(src, first_arr, lists: DataFrame) -> DataFrame:
    """D9 as the older runner did it, pattern by pattern: every branch takes
    only trips of the pattern's own list (``lists``: timed_pattern_id,
    trip_id, based-on trips included), a based-on trip starts at its own start
    time, and the branches are combined with a set UNION."""
    t = src["trips"].where(F.col("service_id").isNotNull()).join(lists.select("timed_pattern_id", "trip_id").hint("merge"), "trip_id")
    cal = src["calendar"]
    j = t.join(cal, t.service_id == cal.calendar_id)
    freq = src["frequencies"].select(F.col("trip_id").alias("_fid"), "start_time", "end_time", "headway_secs")

    def rows(df, start, end, headway):
        return df.select(t.agency_id, "timed_pattern_id", cal.service_schedule_group_id.alias("calendar_id"), start.cast("bigint").alias("start_time"),
                         end.cast("bigint").alias("end_time"), headway.cast("int").alias("headway_secs"), t.block_id, *_weekdays(cal),
                         flag_is_one(t.in_seat_transfer).alias("in_seat_transfer"))

    none = F.lit(None)
    plain = j.join(freq.select("_fid").hint("merge"), t.trip_id == F.col("_fid"), "left_anti")
    base = plain.where(F.col("based_on").isNull()).join(first_arr.where(F.col("first_arrival_time").isNotNull()).hint("merge"), "trip_id")
    by_frequency = j.join(freq.hint("merge"), t.trip_id == F.col("_fid"))
    return (rows(base, F.col("first_arrival_time"), none, none)
            .union(rows(plain.where(F.col("based_on").isNotNull()), F.col("trip_start_time"), none, none))
            .union(rows(by_frequency, F.col("start_time"), F.col("end_time"), F.col("headway_secs"))).distinct())
