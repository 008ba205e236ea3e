"""Persisted tables are read again, not computed again, and growing tables don't go through the driver."""

import re

import pytest
from pyspark.sql import functions as F

from headway.operators import naming, patterns as pat, trips as trp
from headway.plans.pipeline import Migration
from headway.plans.registry import FIXTURE_CONFIG
from headway.sources.catalog import SourceCatalog

NATIONS = "n_nationkey int, n_name string, n_regionkey int"


@pytest.fixture
def folder(spark, tmp_path):
    """A few rows of every base table."""
    def put(name, df):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    n = spark.range(40)
    k = F.col("id")
    put("region", spark.range(5).select(k.alias("r_regionkey").cast("int"), F.concat(F.lit("R"), k).alias("r_name")))
    put("nation", spark.range(25).select(k.alias("n_nationkey").cast("int"), F.concat(F.lit("N"), k).alias("n_name"), (k % 5).alias("n_regionkey").cast("int")))
    put("customer", n.select(k.alias("c_custkey"), F.concat(F.lit("C"), k).alias("c_name"), (k % 25).alias("c_nationkey").cast("int"),
                             F.lit(1.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment")))
    put("supplier", spark.range(20).select(k.alias("s_suppkey"), F.concat(F.lit("S"), k).alias("s_name"), (k % 25).alias("s_nationkey").cast("int"), F.lit(1.0).alias("s_acctbal")))
    put("part", n.select(k.alias("p_partkey"), F.lit("P").alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"),
                         (k % 50).alias("p_size").cast("int"), F.lit(1.0).alias("p_retailprice")))
    put("orders", n.select(k.alias("o_orderkey"), (k % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
                           F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1").alias("o_orderpriority")))
    put("lineitem", n.select(k.alias("l_orderkey"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("l_linenumber")))
    return str(tmp_path)


def cached_plan(df) -> str:
    """The plan that fills ``df``'s cache, up to the next cached table."""
    text = df.select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert text.startswith("InMemoryRelation")
    return text.split("InMemoryRelation")[1]


def test_loading_a_source_leaves_earlier_caches_in_use(spark, folder):
    m = Migration(spark, SourceCatalog.from_testdata(spark, folder), FIXTURE_CONFIG)
    m.tpsn, m.patterns_base, m.timed_patterns, m.pattern_stops
    m.stops_base, m.src["transfers"], m.src["blocks"]                 # read supplier and orders, which the wide table reads as well
    for name in ("patterns_base", "timed_patterns", "pattern_stops"):
        plan = cached_plan(getattr(m, name))
        assert "InMemoryTableScan" in plan and "Generate explode" not in plan, name


def test_rows_of_the_wide_table_are_moved_by_no_second_key(spark, folder):
    """Resolved patterns meet the row arrays on the representative trip, where they lie."""
    m = Migration(spark, SourceCatalog.from_testdata(spark, folder), FIXTURE_CONFIG)
    physical = pat.assemble_tpsn(m.timed_pattern_rows, m.resolved_patterns, m.src)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[one_trip", physical)) == 2 and "SortMergeJoin [timed_pattern_id" not in physical


def test_growing_tables_are_not_broadcast(spark):
    def ids(*names):
        return spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"{n} bigint" for n in names))
    members, tpsn = ids("timed_pattern_id", "trip_id", "min_arrival_time"), ids("timed_pattern_id", "agency_id")
    counts = naming.pattern_trip_counts(ids("timed_pattern_id", "start_time", "end_time", "headway_secs"), ids("timed_pattern_id", "pattern_id"),
                                        ids("pattern_id", "route_id", "direction_id"))
    lists = trp.patterns_trips(members, tpsn, spark.createDataFrame([(1,)], "agency_id bigint"))
    for df, keys in ((counts, ["pattern_id", "timed_pattern_id"]), (lists, ["timed_pattern_id"])):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        for key in keys:
            assert re.search(rf"SortMergeJoin \[{key}", plan) and not re.search(rf"BroadcastHashJoin \[{key}", plan), plan


def test_patterns_without_a_migrated_representative_vanish(spark):
    rows = [(1, True, True, False, 1, "a"), (2, True, True, True, 1, "a"), (3, True, True, True, 1, "b")]
    trips = spark.createDataFrame(rows, "trip_id bigint, is_base boolean, has_kept boolean, has_dst boolean, agency_id int, stops_pattern string").select(
        "*", F.lit("0").alias("arrival_time_intervals"), F.lit("0").alias("departure_time_intervals"), F.lit(1).alias("route_id"), F.lit(0).alias("direction_id"))
    pti = pat.pattern_time_intervals(trips, spark.createDataFrame([(1,)], "agency_id int"))
    keys = pat.timed_pattern_keys(pti)
    assert [(r.one_trip, r.timed_pattern_id) for r in keys.collect()] == [(3, 1)]
