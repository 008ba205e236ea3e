"""F8: polygons and their points aren't broadcast; a relation keyed by several columns takes a whole page of the driver."""

from headway.config import MigrateConfig
from headway.operators import cover, spatial
from headway.session import scratch_table


def spark_plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_polygons_and_points_are_not_broadcast(spark):
    boxes = spark.createDataFrame([("a", 0.0, 10.0, 0.0, 10.0), ("b", 10.0, 20.0, 0.0, 10.0)],
                                  "tzid string, min_lon double, max_lon double, min_lat double, max_lat double")
    points = spark.createDataFrame([(1.0, 1.0), (12.0, 3.0), (12.0, 3.0), (30.0, 3.0), (None, 1.0)], "lon double, lat double")
    edges = scratch_table(spatial.box_edges(boxes), "edges")                     # of a known, small size
    built = cover.build_cover(edges)
    cells, cuts = (scratch_table(df, "cover") for df in cover._first_level(edges, 5.0))
    fine, _ = cover._split(cells, cuts, 5.0)
    zones = spatial.point_timezone(points, built, MigrateConfig())
    for df in (cover._first_level(edges, 5.0)[0], fine, zones):
        plan = spark_plan(df)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert {(r.lon, r.tzid) for r in zones.collect()} == {(1.0, "a"), (12.0, "b"), (30.0, None)}


def test_zones_of_points_are_not_broadcast_to_the_stops(spark):
    stops = spark.createDataFrame([(1, (1.0, 1.0)), (2, (12.0, 3.0)), (3, (None, 1.0))], "stop_id bigint, point struct<lon: double, lat: double>")
    corners = [(0, 0.0, 0.0), (1, 10.0, 0.0), (2, 10.0, 10.0), (3, 0.0, 10.0)]
    polygons = spark.createDataFrame([("a", 0, n, x, y) for n, x, y in corners], "tzid string, ring_id int, vertex_no int, lon double, lat double")
    placed = spatial.assign_timezones(stops, polygons)
    assert "BroadcastHashJoin" not in spark_plan(placed)
    assert {(r.stop_id, r.timezone) for r in placed.collect()} == {(1, "a"), (2, None), (3, None)}
