"""Plans and counts of the pattern jobs."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.operators import patterns as pat
from headway.operators.losses import Losses
from headway.plans.pipeline import Migration
from headway.plans.registry import FIXTURE_CONFIG, migration
from headway.sources.catalog import SourceCatalog

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exploded_row_is_shuffled(spark):
    """Above the Generate of the wide table no Exchange takes its rows (only broadcast dimensions join it)."""
    m = Migration(spark, SourceCatalog.from_testdata(spark, SF), FIXTURE_CONFIG)      # its own: no test has persisted its wide table
    wide = pat.assemble_tpsn(m.timed_pattern_rows, m.resolved_patterns, m.src)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "dense_rank" not in plan and plan.count("Generate explode(rows") == 1
    physical = wide._jdf.queryExecution().executedPlan().toString()
    above = physical.split("Generate explode(rows")[0]
    assert not re.search(r"(?<!Broadcast)Exchange", above), above


def test_stop_order_is_the_dense_rank(spark):
    m = migration(spark, SF)
    rank = F.dense_rank().over(Window.partitionBy("timed_pattern_id").orderBy(F.col("stop_sequence").asc_nulls_last()))
    assert m.tpsn.withColumn("want", rank).where("stop_order <> want OR stop_order IS NULL").count() == 0


def test_stop_order_with_ties_and_null_sequences(spark):
    rows = [(1, "a", 7, None, [3, 3, 5, None, None])]
    seqs = spark.createDataFrame([(r[4],) for r in rows], "seqs array<int>")
    got = seqs.select(F.transform("seqs", lambda s: F.when(s.isNull(), F.size(F.array_distinct("seqs")).cast("bigint"))
                                  .otherwise(F.array_position(F.array_distinct("seqs"), s)))).first()[0]
    assert got == [1, 1, 2, 3, 3]


def per_trip_rows(spark, n, hot):
    """Trips with a pattern key each; ``hot`` of them share one."""
    key = F.when(F.col("id") < hot, F.lit("hot")).otherwise((F.col("id") % 200).cast("string"))
    return spark.range(n).select(
        F.col("id").alias("trip_id"), F.lit(True).alias("is_base"), F.lit(True).alias("has_kept"), F.lit(1).alias("agency_id"),
        key.alias("stops_pattern"), F.lit("0").alias("arrival_time_intervals"),
        F.when(F.col("id") % 2 == 0, F.lit("0")).alias("departure_time_intervals"), (F.col("id") % 3).alias("route_id"),
        F.lit(None).cast("int").alias("direction_id"), F.col("id").alias("min_arrival_time")).withColumn(
        "departure_time_intervals", F.when(F.col("stops_pattern") != "hot", F.col("departure_time_intervals"))).withColumn(
        "route_id", F.when(F.col("stops_pattern") == "hot", F.lit(0)).otherwise(F.col("route_id")))


def test_hot_pattern_is_spread(spark):
    n, hot = 40_000, 15_000
    agencies = spark.createDataFrame([(1,)], "agency_id int")
    trips = per_trip_rows(spark, n, hot)
    tp = trips.groupBy(*pat.PATTERN_KEY).agg(F.min("trip_id").alias("one_trip"), F.count(F.lit(1)).alias("trip_count")).withColumn(
        "timed_pattern_id", F.col("one_trip") + 1)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = pat.pattern_members(trips, tp, agencies)
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
        members = {(r.timed_pattern_id, r.trip_id) for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    want = trips.join(tp, [trips[k].eqNullSafe(tp[k]) for k in pat.PATTERN_KEY]).select("timed_pattern_id", "trip_id")
    assert members == {tuple(r) for r in want.collect()} and len(members) == n


def test_losses_need_no_further_scan(spark):
    """The counts come with the write: reporting starts no job that reads a source table."""
    m = Migration(spark, SourceCatalog.from_testdata(spark, SF), FIXTURE_CONFIG)
    m.resolved_patterns, m.trips
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("losses", "report")
    report = m.losses.report(spark)
    assert tracker.getJobIdsForGroup("losses") in ([], ())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert report.count() == 16 and report.where("n_rows > 0").count() > 4


def test_loss_reasons_are_exclusive_and_complete(spark):
    df = spark.createDataFrame([(1, None, 2), (None, None, 3), (1, 1, 5), (None, 1, 7)], "a int, b int, w int")
    losses = Losses()
    left = losses.drop(df, "step", {"no a": F.col("a").isNull(), "no b": F.col("b").isNull()}, F.col("w"))
    assert [tuple(r) for r in left.collect()] == [(1, 1, 5)]
    assert sorted(tuple(r) for r in losses.report(spark).collect()) == [("step", "no a", 2, 10), ("step", "no b", 1, 2)]


def test_every_base_trip_is_kept_or_counted(spark):
    """Trips of the timed patterns = trips in the wide table + trips counted as lost on the way there."""
    m = Migration(spark, SourceCatalog.from_testdata(spark, "/root/testdata/sf0.01"), MigrateConfig(skip_agencies=(3,)))
    total = m.pattern_time_intervals.agg(F.sum("trip_count")).first()[0]
    kept = m.timed_pattern_rows.join(m.resolved_patterns, "timed_pattern_id").agg(F.sum("trip_count")).first()[0]
    lost = m.losses.report(spark).agg(F.sum("n_trips")).first()[0]
    assert total == kept + lost and lost > 0
