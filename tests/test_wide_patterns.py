"""tables of ids come from one row per timed pattern, which says what the wide table's stop rows would."""

import pytest
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.operators import naming, patterns as pat
from headway.plans.pipeline import Migration

COLUMNS = ["agency_id", "timed_pattern_id", "pattern_id", "route_id", "direction_id", "direction_name", "trip_headsign_id"]


@pytest.fixture
def src(spark, catalog):
    """Trips 1 and 2 share a pattern and no headsign; 3 has no headsign in the source and no direction label; the stop rows
    of 4 name an agency that the source lacks; 5 has no route; 6 a frequency."""
    trips = [(1, 5, 1, 0, 7, 10), (2, 5, 1, 0, 8, 10), (3, 6, 1, 1, 99, 10), (4, 6, 2, 0, 7, 10), (5, 9, 1, 0, 7, 10), (6, 6, 1, 0, 7, 20)]
    st = [(t, a, seq, stop + 10 * seq, 100 * t + 60 * seq, 100 * t + 60 * seq) for t, _, a, _, _, stop in trips for seq in (1, 2)]
    weekdays = ", ".join(f"{d} int" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"))
    return catalog(
        stop_times=spark.createDataFrame(st, "trip_id bigint, agency_id int, stop_sequence int, stop_id bigint, arrival_time bigint, departure_time bigint")
        .select("*", *[F.lit(None).cast("int").alias(c) for c in ("pickup_type", "drop_off_type")], F.lit(None).cast("bigint").alias("headsign_id")),
        trips=spark.createDataFrame([(*t[:5], None, 3, None, 1, 0) for t in trips],
                                    "trip_id bigint, route_id bigint, agency_id int, direction_id int, headsign_id bigint, based_on bigint, "
                                    "service_id int, block_id bigint, trip_start_time bigint, in_seat_transfer int"),
        routes=spark.createDataFrame([(5, "a", "A"), (6, "b", "B")], "route_id bigint, route_short_name string, route_long_name string"),
        directions=spark.createDataFrame([(0, "Out")], "direction_id int, direction_label string"),
        headsigns=spark.createDataFrame([(7, "To 7"), (8, "To 8"), (8, "To 8")], "headsign_id bigint, headsign string"),
        agency=spark.createDataFrame([(1, "A1")], "agency_id int, agency_name string"),
        calendar=spark.createDataFrame([(3, 30, 1, *[1] * 7)], f"calendar_id int, service_schedule_group_id int, agency_id int, {weekdays}"),
        frequencies=spark.createDataFrame([(6, 0, 3600, 600)], "trip_id bigint, start_time int, end_time int, headway_secs int"),
        stops=spark.createDataFrame([(20,), (30,), (40,)], "stop_id bigint"))


@pytest.fixture
def migration(spark, src):
    m = Migration(spark, src, MigrateConfig())
    m.agencies = spark.createDataFrame([(1,), (2,)], "agency_id int")
    return m


def rows(df):
    return sorted(map(repr, df.distinct().collect()))


def test_patterns_without_stop_rows_are_those_of_the_wide_table(migration):
    m = migration
    assert rows(m.wide_patterns.select(*COLUMNS)) == rows(m.tpsn.select(*COLUMNS)) and m.wide_patterns.count() == 3
    assert rows(m.patterns_base) == rows(pat.pattern_headsigns(pat.patterns(m.tpsn), m.tpsn))
    assert rows(m.timed_patterns) == rows(pat.timed_patterns_table(m.tpsn))
    assert rows(m.directions) == rows(naming.directions(m.tpsn, m.agencies))


def test_counting_trips_builds_no_stop_rows(migration):
    got = {(r.route_id, r.direction_id): r.num_trips for r in migration.pattern_trip_counts.collect()}
    assert got == {(5, 0): 2, (6, 1): 1, (6, 0): 7}
    assert "tpsn" not in vars(migration)


def test_stop_times_are_kept_once(spark, tmp_path):
    """The per-trip table is persisted; the stop rows that it holds aren't kept beside it."""
    from headway.sources.catalog import SourceCatalog
    table = lambda name, cols: spark.createDataFrame([], cols).write.parquet(f"{tmp_path}/{name}.parquet")
    table("supplier", "s_suppkey bigint")
    table("customer", "c_custkey bigint, c_nationkey int, c_name string, c_mktsegment string")
    table("orders", "o_orderkey bigint, o_custkey bigint")
    table("lineitem", "l_orderkey bigint, l_linenumber int")
    source = SourceCatalog.from_testdata(spark, str(tmp_path))
    assert not source["stop_times"].is_cached and source["trips"].is_cached
