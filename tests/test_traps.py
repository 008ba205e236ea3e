"""Hand-made frames for the semantic traps (README, "Semantics")."""

from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.columns import array_minus, is_valid_css_color, normalise_route_color
from headway.operators.losses import Losses
from headway.operators import patterns as pat

ST_SCHEMA = ("trip_id bigint, agency_id int, stop_sequence int, stop_id bigint, arrival_time bigint, "
             "departure_time bigint, pickup_type int")
TRIP_SCHEMA = "trip_id bigint, route_id bigint, agency_id int, direction_id int, headsign_id bigint, based_on bigint"


def _agencies(spark, ids=(1,)):
    return spark.createDataFrame([(i, f"A{i}", 0) for i in ids], "agency_id int, agency_name string, feed_id int")


def test_departure_signature_is_gated_on_arrival(spark, catalog):
    st = spark.createDataFrame([
        (1, 1, 1, 10, 100, 110, None), (1, 1, 2, 20, 200, None, 0), (1, 1, 3, 30, None, 330, 0)], ST_SCHEMA)
    trips = spark.createDataFrame([(1, 5, 1, 0, None, None)], TRIP_SCHEMA)
    src = catalog(stop_times=st, trips=trips, agency=_agencies(spark))
    row = pat.trip_stop_rows(src, _agencies(spark), MigrateConfig()).first()
    assert row.stops_pattern == "10, 20, 30"
    assert row.arrival_time_intervals == "0,100,"
    # '0' for the first row, nothing for arrival-without-departure, '' for no arrival
    assert row.departure_time_intervals == "0,"


def test_all_null_stop_list_is_null_not_empty(spark, catalog):
    st = spark.createDataFrame([(1, 1, 1, None, 100, 110, None), (1, 1, 2, None, 200, 210, 0)], ST_SCHEMA)
    trips = spark.createDataFrame([(1, 5, 1, 0, None, None)], TRIP_SCHEMA)
    row = pat.trip_stop_rows(catalog(stop_times=st, trips=trips, agency=_agencies(spark)), _agencies(spark), MigrateConfig()).first()
    assert row.stops_pattern is None


def test_skip_list_filters_stop_time_agency(spark, catalog):
    # agency 7 is skipped: its stop rows vanish from the signature
    st = spark.createDataFrame([(1, 1, 1, 10, 100, 100, None), (1, 7, 2, 20, 200, 200, 0)], ST_SCHEMA)
    trips = spark.createDataFrame([(1, 5, 1, 0, None, None)], TRIP_SCHEMA)
    row = pat.trip_stop_rows(catalog(stop_times=st, trips=trips, agency=_agencies(spark)), _agencies(spark), MigrateConfig(skip_agencies=(7,))).first()
    assert row.stops_pattern == "10"
    assert row.stops_pattern_all == "10, 20"


def test_route_colour_needs_exactly_six_hex_digits(spark):
    df = spark.createDataFrame([("ABCDEF",), ("00ff00\n",), ("red",), (None,), ("#00ff00",)], "c string")
    got = [r[0] for r in df.select(normalise_route_color("c", "#ffffff")).collect()]
    assert got == ["#abcdef", "#ffffff", "#ffffff", "#ffffff", "#ffffff"]


def test_css_colour_names_and_bare_hex(spark):
    df = spark.createDataFrame([("Red",), ("ff00AA",), ("#ff00aa",), ("notacolour",), (None,)], "c string")
    got = [r[0] for r in df.select(is_valid_css_color("c")).collect()]
    assert got == [True, True, False, False, None]


def test_array_minus_keeps_null_and_returns_null_when_empty(spark):
    df = spark.createDataFrame([([3, 1, 1, None], [1]), ([1], [1]), ([2, 1], [])], "a array<int>, b array<int>")
    got = [r[0] for r in df.select(array_minus("a", "b")).collect()]
    assert got == [[3, None], None, [1, 2]]


def test_null_direction_patterns_drop_out_of_wide_table(spark, catalog):
    st = spark.createDataFrame([(1, 1, 1, 10, 100, 100, None), (2, 1, 1, 10, 100, 100, None)], ST_SCHEMA)
    trips = spark.createDataFrame([(1, 5, 1, 0, None, None), (2, 6, 1, None, None, None)], TRIP_SCHEMA)
    routes = spark.createDataFrame([(5, "a", "A"), (6, "b", "B")], "route_id bigint, route_short_name string, route_long_name string")
    src = catalog(
        stop_times=st.withColumn("drop_off_type", F.lit(None).cast("int")).withColumn("headsign_id", F.lit(None).cast("bigint")),
        trips=trips, routes=routes,
        directions=spark.createDataFrame([(0, "Out")], "direction_id int, direction_label string"),
        headsigns=spark.createDataFrame([], "headsign_id bigint, headsign string"),
        agency=spark.createDataFrame([(1, "A1")], "agency_id int, agency_name string"),
        stops=spark.createDataFrame([(10,)], "stop_id bigint"))
    ag = _agencies(spark)
    per_trip = pat.trip_stop_rows(src, ag, MigrateConfig())
    tp = pat.timed_patterns(pat.pattern_time_intervals(per_trip, ag), per_trip)
    wide = pat.assemble_tpsn(tp, pat.resolve_patterns(tp, pat.stop_patterns(per_trip, ag), src), src)
    assert tp.count() == 2
    assert [r.route_id for r in wide.collect()] == [5]


def test_patterns_with_a_missing_stop_are_removed_whole(spark, catalog):
    st = spark.createDataFrame([(1, 1, 1, 10, 100, 100, None), (1, 1, 2, 99, 200, 200, None)], ST_SCHEMA)
    trips = spark.createDataFrame([(1, 5, 1, 0, None, None)], TRIP_SCHEMA)
    src = catalog(
        stop_times=st.withColumn("drop_off_type", F.lit(None).cast("int")).withColumn("headsign_id", F.lit(None).cast("bigint")),
        trips=trips,
        routes=spark.createDataFrame([(5, "a", "A")], "route_id bigint, route_short_name string, route_long_name string"),
        directions=spark.createDataFrame([(0, "Out")], "direction_id int, direction_label string"),
        headsigns=spark.createDataFrame([], "headsign_id bigint, headsign string"),
        agency=spark.createDataFrame([(1, "A1")], "agency_id int, agency_name string"),
        stops=spark.createDataFrame([(10,)], "stop_id bigint"))
    ag = _agencies(spark)
    per_trip = pat.trip_stop_rows(src, ag, MigrateConfig())
    tp = pat.timed_patterns(pat.pattern_time_intervals(per_trip, ag), per_trip)
    losses = Losses()
    assert pat.assemble_tpsn(tp, pat.resolve_patterns(tp, pat.stop_patterns(per_trip, ag), src, losses), src).count() == 0
    counts = {r.reason: (r.n_rows, r.n_trips) for r in losses.report(spark).collect()}
    assert counts.pop("stop not in the source") == (1, 1) and set(counts.values()) == {(0, 0)}
