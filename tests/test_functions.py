"""Library functions that are not registered queries."""


from headway.functions.columns import hms_to_seconds, null_means_all, seconds_to_hms
from headway.operators import audits, spatial
from headway.operators.scope import sample_agencies, scope_only, scope_skip
from headway.plans.registry import migration

SF = "/root/testdata/sf0.001"


def test_time_text_round_trip(spark):
    df = spark.createDataFrame([(0,), (3661,), (90061,), (None,)], "s bigint")
    out = df.select(seconds_to_hms("s").alias("t")).select("t", hms_to_seconds("t").alias("back")).collect()
    assert [r.t for r in out] == ["0:00:00", "1:01:01", "25:01:01", None]
    assert [r.back for r in out] == [0, 3661, 90061, None]


def test_null_means_all(spark):
    df = spark.createDataFrame([(None,), (-411,), (5,)], "x bigint")
    assert [r[0] for r in df.select(null_means_all("x")).collect()] == [-411, -411, 5]


def test_scope_skip_drops_null_agencies(spark):
    df = spark.createDataFrame([(1,), (7,), (None,)], "agency_id int")
    assert [r.agency_id for r in scope_skip(df, [7]).collect()] == [1]


def test_geojson_lines(spark):
    df = spark.createDataFrame([('{"type":"LineString","coordinates":[[1.5,2.5],[3.0,4.0]]}',),
                                ('{"type":"Point","coordinates":[1,2]}',)], "g string")
    out = spatial.geojson_lines(df, "g").collect()
    assert [(p.lon, p.lat) for p in out[0].linestring] == [(1.5, 2.5), (3.0, 4.0)]
    assert out[1].linestring is None


def test_scope_only_and_sample(spark):
    m = migration(spark, SF)
    skip = scope_only(m.src, 3)
    assert 3 not in skip and len(skip) == 24
    picked = [r.agency_id for r in sample_agencies(m.src, [5], 4, [1]).collect()]
    assert 1 not in picked and len(picked) <= 4 and 0 in picked


def test_stop_lookup_and_ring_edges(spark):
    m = migration(spark, SF)
    one = audits.stop_lookup(m, 1).collect()
    assert len(one) == 1 and one[0].stop_id == 1
    edges = spatial.polygon_edges(m.src["tz_polygons"])
    assert edges.count() == m.src["tz_polygons"].count()


def test_prune_orphans_keeps_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, parent bigint")
    parent = spark.createDataFrame([(10,)], "pid bigint")
    assert sorted(r.id for r in audits.prune_orphans(child, "parent", parent, "pid").collect()) == [1, 2]


def test_array_minus_property(spark):
    from hypothesis import given, settings, strategies as st

    from headway.functions.columns import array_minus

    elems = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=6)
    cases = []

    @settings(max_examples=60, deadline=None)
    @given(elems, elems)
    def collect(a, b):
        cases.append((a, b))

    collect()
    df = spark.createDataFrame(cases, "a array<int>, b array<int>")
    got = [r[0] for r in df.select(array_minus("a", "b")).collect()]
    for (a, b), g in zip(cases, got):
        keep = {x for x in a if x is None or x not in {y for y in b if y is not None}}
        want = sorted(x for x in keep if x is not None) + ([None] if None in keep else [])
        assert g == (want or None)
