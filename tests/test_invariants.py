"""Invariants of the migration on the driver's tables."""

from pyspark.sql import functions as F

from headway.operators import fares
from headway.plans.registry import migration

SF = "/root/testdata/sf0.001"


def test_every_base_trip_is_in_exactly_one_timed_pattern(spark):
    m = migration(spark, SF)
    members = m.pattern_members
    assert members.count() == members.select("trip_id").distinct().count()


def test_offset_plus_minimum_reproduces_arrivals(spark):
    m = migration(spark, SF)
    # rows of each representative trip: relative arrival + trip minimum = absolute arrival
    rep = m.timed_pattern_rows.select("timed_pattern_id", "min_arrival_time", F.explode("rows").alias("r"))
    wide = m.tpsn.select("timed_pattern_id", "stop_sequence", "stop_id", "arrival_time")
    # rows may tie on the sequence (D2); the stop tells them apart
    j = rep.join(wide, (rep.timed_pattern_id == wide.timed_pattern_id) & (F.col("r.seq") == wide.stop_sequence) & (F.col("r.stop_id") == wide.stop_id))
    assert j.count() == wide.count()
    bad = j.where(F.col("arrival_time") + F.col("min_arrival_time") != F.col("r.arr"))
    assert bad.count() == 0


def test_fare_balance_is_zero_without_duplicates(spark):
    m = migration(spark, SF)
    row = fares.fare_balance(m.fare_rules, m.fares_symmetric, m.fares_asymmetric).first()
    assert row.residue == 0


def test_ids_do_not_depend_on_shuffle_partitions(spark):
    from headway.plans.pipeline import Migration
    from headway.sources.catalog import SourceCatalog
    a = {(r.one_trip, r.timed_pattern_id) for r in migration(spark, SF).timed_pattern_rows.collect()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        m2 = Migration(spark, SourceCatalog.from_testdata(spark, SF))
        b = {(r.one_trip, r.timed_pattern_id) for r in m2.timed_pattern_rows.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_bucketed_per_trip_table_gives_the_same_wide_table(spark):
    from dataclasses import replace

    from headway.plans.registry import FIXTURE_CONFIG
    from headway.plans.pipeline import Migration
    from headway.sources.catalog import SourceCatalog
    cols = ["timed_pattern_id", "pattern_id", "stop_order", "stop_id", "arrival_time", "departure_time"]
    a = {tuple(r) for r in migration(spark, SF).tpsn.select(*cols).collect()}
    m2 = Migration(spark, SourceCatalog.from_testdata(spark, SF), replace(FIXTURE_CONFIG, materialize_per_trip=True))
    b = {tuple(r) for r in m2.tpsn.select(*cols).collect()}
    assert a == b
    assert not m2.per_trip.is_cached
