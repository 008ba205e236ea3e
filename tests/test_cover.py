"""The quadtree cover against plain ray casting, and what it saves."""

import math
import random

from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.operators import spatial
from headway.operators.cover import build_cover, candidate_edges, containing_polygons


def inside(px, py, edges):
    return sum((y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) for x1, y1, x2, y2 in edges) % 2 == 1


def ring(points):
    return [(*a, *b) for a, b in zip(points, points[1:] + points[:1])]


def frame(spark, polygons):
    return spark.createDataFrame([(t, *map(float, e)) for t, es in polygons.items() for e in es], "tzid string, x1 double, y1 double, x2 double, y2 double")


def found(spark, polygons, points, **cfg):
    cover = build_cover(frame(spark, polygons), MigrateConfig(**cfg))
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in points], "lon double, lat double").distinct()
    return {(r.lon, r.lat, r.tzid) for r in containing_polygons(pts, cover, 2).collect()}


def want(polygons, points):
    return {(float(x), float(y), t) for x, y in points for t, es in polygons.items() if inside(x, y, es)}


def test_stars_with_holes_and_parts(spark):
    r = random.Random(1)
    polygons = {}
    for k in range(8):
        cx, cy = r.uniform(-40, 40), r.uniform(-25, 25)
        def star(n, low, high):
            return [(cx + rad * math.cos(a), cy + rad * math.sin(a)) for a, rad in
                    ((2 * math.pi * (i + r.random() * 0.8) / n, r.uniform(low, high)) for i in range(n))]
        polygons[f"tz{k}"] = ring(star(70, 6, 14)) + ring(star(9, 1, 4)[::-1]) + ring([(x + 30, y + 3) for x, y in star(12, 1, 5)])
    points = [(r.uniform(-60, 80), r.uniform(-45, 45)) for _ in range(1500)]
    for cell, levels in ((5.0, 6), (11.0, 3), (3.0, 0)):
        assert found(spark, polygons, points, tz_cell_degrees=cell, tz_cover_levels=levels) == want(polygons, points)


def test_whole_numbers_touch_vertices_edges_and_cell_borders(spark):
    """Points on vertices, on edges and on cell borders follow the half-open rule of ray casting."""
    polygons = {"square": ring([(0, 0), (8, 0), (8, 8), (0, 8)]), "next": ring([(8, 0), (16, 0), (16, 8), (8, 8)]),
                "house": ring([(-8, -8), (0, -8), (0, -4), (-4, 0), (-8, -4)]) + ring([(-6, -6), (-2, -6), (-4, -4)][::-1]),
                "steps": ring([(x, y) for i in range(12) for x, y in ((20 + i, -i), (21 + i, -i))] + [(32, -20), (20, -20)])}
    points = [(x / 2, y / 2) for x in range(-24, 70) for y in range(-42, 24)]
    got = found(spark, polygons, points, tz_cell_degrees=4.0, tz_cover_levels=4)
    assert got == want(polygons, points)
    shared = [p for p in got if p[2] in ("square", "next") and p[0] == 8.0]
    assert shared and all(t == "next" for *_, t in shared)                 # a shared edge belongs to one of them


def test_null_points_and_empty_maps(spark):
    none = frame(spark, {"a": ring([(0, 0), (1, 0), (1, 1)])}).where("false")
    pts = spark.createDataFrame([(0.5, 0.2), (None, 1.0), (0.5, 0.2)], "lon double, lat double")
    assert [tuple(r) for r in spatial.point_timezone(pts, none).collect()] == [(0.5, 0.2, None)]


def test_map_of_28000_polygons(spark):
    """A grid of 28,000 twenty-sided polygons: rows as by ray casting in the polygon's own neighbourhood, few edges a point."""
    nx, ny, sides = 200, 140, 20
    step_x, step_y = 360 / nx, 160 / ny
    i = F.col("i")
    angle = (2 * math.pi) * i / sides
    def vertex(a):
        # squeezed circle around the cell's centre, deterministic wobble
        rad = 0.40 + 0.08 * F.sin(a * 3 + F.col("id"))
        return ((F.col("id") % nx + 0.5) * step_x - 180 + rad * step_x * F.cos(a), (F.floor(F.col("id") / nx) + 0.5) * step_y - 80 + rad * step_y * F.sin(a))
    ids = spark.range(nx * ny).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    x1, y1 = vertex(angle)
    x2, y2 = vertex((2 * math.pi) * ((i + 1) % sides) / sides)
    edges = ids.select(F.col("id").cast("string").alias("tzid"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")).persist()
    pts = spark.range(20_000).select((F.pmod(F.col("id") * 48271, F.lit(360_000)) / 1000.0 - 180).alias("lon"),
                                     (F.pmod(F.col("id") * 69621, F.lit(160_000)) / 1000.0 - 80).alias("lat")).persist()
    cover = build_cover(edges)
    got = {(r.lon, r.lat, r.tzid) for r in containing_polygons(pts, cover).collect()}
    # brute force: a point only meets the polygon of its own grid square, which holds it whole
    near = pts.withColumn("tzid", (F.floor((F.col("lat") + 80) / step_y) * nx + F.floor((F.col("lon") + 180) / step_x)).cast("string"))
    crossing = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (
        F.col("lon") < F.col("x1") + F.try_divide((F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    brute = (near.join(edges, "tzid").where(crossing).groupBy("lon", "lat", "tzid").count().where("count % 2 = 1"))
    assert got == {(r.lon, r.lat, r.tzid) for r in brute.collect()}
    compared = candidate_edges(pts, cover).count() / pts.count()
    in_band = edges.count() * 2 * 1.0 / 160 / 1            # edges that a 1 degree band holds on average
    print(f"edges compared per point: {compared:.1f}; edges in a 1 degree latitude band: {in_band:.0f}")
    assert compared < 12
