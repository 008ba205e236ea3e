"""Spatial jobs without geo types.

Point in polygon (I1) looks points up in a quadtree cover of the polygons
(``cover``): cells inside a polygon answer without an edge, border cells by the
edges that cut them.  Points are deduplicated first, and a salt spreads a
crowded cell over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.geo import METRES_TO_MILES, make_point, segment_metres
from headway.operators.cover import Cover, build_cover, containing_polygons

# Legacy time zone text clean-up.
LEGACY_TZ_RENAMES = {"US/Eastern": "America/New_York"}


def box_edges(boxes: DataFrame) -> DataFrame:
    """Axis-aligned boxes (tzid, min_lon, max_lon, min_lat, max_lat) -> edges."""
    corners = [("min_lon", "min_lat", "max_lon", "min_lat"), ("max_lon", "min_lat", "max_lon", "max_lat"),
               ("max_lon", "max_lat", "min_lon", "max_lat"), ("min_lon", "max_lat", "min_lon", "min_lat")]
    edges = F.array(*[F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
                      for a, b, c, d in corners])
    return boxes.select("tzid", F.explode(edges).alias("e")).select("tzid", "e.*")


def ring_edges(rings: DataFrame) -> DataFrame:
    """Polygons as (tzid, ring: array<struct<lon,lat>>, closed) -> edges."""
    idx = F.sequence(F.lit(1), F.size("ring") - 1)
    e = F.transform(idx, lambda i: F.struct(
        F.element_at("ring", i)["lon"].alias("x1"), F.element_at("ring", i)["lat"].alias("y1"),
        F.element_at("ring", i + 1)["lon"].alias("x2"), F.element_at("ring", i + 1)["lat"].alias("y2")))
    return rings.where(F.size("ring") > 1).select("tzid", F.explode(e).alias("e")).select("tzid", "e.*")


def vertex_rings(vertices: DataFrame) -> DataFrame:
    """Rows (tzid, ring_id, vertex_no, lon, lat) -> closed rings; a ring's vertices make one array."""
    points = F.transform(F.array_sort(F.collect_list(F.struct("vertex_no", "lon", "lat"))), lambda v: make_point(v["lon"], v["lat"]))
    rings = vertices.groupBy("tzid", "ring_id").agg(points.alias("ring"))
    return rings.select("tzid", F.concat("ring", F.slice("ring", 1, 1)).alias("ring"))


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """Edges of polygons given as vertex rows, as ring arrays or as boxes.

    A polygon is all rings of its ``tzid``: several parts, and holes, which
    run against the outer ring's direction where areas are taken.
    """
    if "vertex_no" in polygons.columns:
        return ring_edges(vertex_rings(polygons))
    return ring_edges(polygons) if "ring" in polygons.columns else box_edges(polygons)


def point_timezone(points: DataFrame, polygons: DataFrame | Cover, cfg: MigrateConfig | None = None) -> DataFrame:
    """(lon, lat) distinct points -> (lon, lat, tzid); ``min(tzid)`` when
    several polygons contain the point, NULL when none does.  ``polygons``
    are edges, or their cover where it serves several calls."""
    cfg = cfg or MigrateConfig()
    cover = polygons if isinstance(polygons, Cover) else build_cover(polygons, cfg)
    pts = points.select("lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()
    inside = (containing_polygons(pts, cover, max(1, int(cfg.tz_band_salt)))
              .groupBy("lon", "lat").agg(F.min("tzid").alias("tzid")))
    return pts.join(inside.hint("merge"), ["lon", "lat"], "left")


def assign_timezones(stops: DataFrame, tz_polygons: DataFrame, cfg: MigrateConfig | None = None) -> DataFrame:
    """B4 + I1: stops get the time zone of the polygon holding their point."""
    with_xy = stops.select("*", F.col("point.lon").alias("_lon"), F.col("point.lat").alias("_lat"))
    tz = point_timezone(with_xy.select(F.col("_lon").alias("lon"), F.col("_lat").alias("lat")),
                        polygon_edges(tz_polygons), cfg)
    tz = tz.select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), F.col("tzid").alias("timezone"))
    return with_xy.join(tz.hint("merge"), ["_lon", "_lat"], "left").drop("_lon", "_lat")


def timezone_clean(tz):
    """Legacy time zone text: '' is none, old names get their present ones."""
    cleaned = F.when(F.length(tz) == 0, F.lit(None).cast("string"))
    for old, new in LEGACY_TZ_RENAMES.items():
        cleaned = cleaned.when(tz == old, F.lit(new))
    return cleaned.otherwise(tz)


def timezone_fallback(src) -> DataFrame:
    """I10 (legacy): '' -> NULL, legacy names renamed, then the agency's
    time zone for stops still without one."""
    s, a = src["stops"], src["agency"].select("agency_id", "agency_timezone")
    cleaned = timezone_clean(F.col("stop_timezone"))
    return s.join(a, "agency_id", "left").select(
        "stop_id", F.coalesce(cleaned, F.col("agency_timezone")).alias("timezone"))


def stop_agencies(src) -> DataFrame:
    """The link table of stops and the agencies whose trips call there."""
    return src["stop_times"].select("stop_id", "agency_id").where(F.col("agency_id").isNotNull()).distinct()


def timezone_by_link(src, dst_agencies: DataFrame, link: DataFrame) -> DataFrame:
    """I10 over a stop-agency link: a stop without a time zone takes the
    smallest one of its migrated agencies (the original took any)."""
    own = timezone_clean(F.col("stop_timezone"))
    of_agency = (link.join(dst_agencies.select("agency_id", "agency_timezone"), "agency_id")
                 .groupBy("stop_id").agg(F.min("agency_timezone").alias("_tz")))
    return src["stops"].join(of_agency, "stop_id", "left").select("stop_id", F.coalesce(own, F.col("_tz")).alias("timezone"))


def shape_segments(src, dst_stops: DataFrame) -> DataFrame:
    """The newest segment (largest id) of each (start, end) stop pair as
    an ordered line; both stops must be migrated."""
    ss, pts = src["shape_segments"], src["shape_points"]
    newest = ss.groupBy("start_coordinate_id", "end_coordinate_id").agg(
        F.max("shape_segment_id").alias("shape_segment_id")).select("shape_segment_id")
    stops = dst_stops.select(F.col("stop_id").alias("_sid"))
    seg = (ss.join(newest.hint("merge"), "shape_segment_id")
           .where(F.col("start_coordinate_id").isNotNull() & F.col("end_coordinate_id").isNotNull())
           .join(stops, F.col("start_coordinate_id") == stops["_sid"], "left_semi")
           .join(stops, F.col("end_coordinate_id") == stops["_sid"], "left_semi"))
    j = seg.join(pts.hint("merge"), "shape_segment_id")
    line = (j.groupBy("start_coordinate_id", "end_coordinate_id", "last_modified")
            .agg(F.array_sort(F.collect_list(F.struct(
                F.col("shape_pt_sequence").isNull().alias("last"), "shape_pt_sequence", "lon", "lat"))).alias("_p")))
    return line.select(F.col("start_coordinate_id").alias("from_stop_id"),
                       F.col("end_coordinate_id").alias("to_stop_id"), "last_modified",
                       F.transform("_p", lambda p: make_point(p["lon"], p["lat"])).alias("linestring"))


def dump_points(lines: DataFrame, keys=("from_stop_id", "to_stop_id")) -> DataFrame:
    """I7 ``ST_DumpPoints``: one row per vertex with its 1-based index."""
    return lines.select(*keys, F.posexplode("linestring").alias("_i", "_p")).select(
        *keys, (F.col("_i") + 1).cast("bigint").alias("path"),
        F.col("_p.lon").alias("lon"), F.col("_p.lat").alias("lat"))


def line_length_miles(line) -> "F.Column":
    """I8: sum of ellipsoidal segment lengths, in miles."""
    c = F.col(line) if isinstance(line, str) else line
    idx = F.sequence(F.lit(2), F.greatest(F.size(c), F.lit(2)))
    legs = F.transform(idx, lambda i: F.when(i <= F.size(c), segment_metres(
        F.element_at(c, i - 1)["lon"], F.element_at(c, i - 1)["lat"],
        F.element_at(c, i)["lon"], F.element_at(c, i)["lat"])).otherwise(F.lit(0.0)))
    return F.aggregate(legs, F.lit(0.0), lambda acc, x: acc + x) * F.lit(METRES_TO_MILES)


def null_timezones(stops: DataFrame) -> DataFrame:
    """Stops left without a time zone."""
    return stops.groupBy().agg(
        F.count(F.lit(1)).cast("bigint").alias("n_stops"),
        F.sum(F.when(F.col("timezone").isNull(), 1).otherwise(0)).cast("bigint").alias("n_null_timezone"))


def stop_feed_link(src, dst_agencies: DataFrame) -> DataFrame:
    """I11 (legacy): feed of a stop through its agency's group."""
    s = src["stops"].select("stop_id", "agency_id")
    return s.join(dst_agencies.select("agency_id", "feed_id"), "agency_id", "left").select("stop_id", "feed_id")


# Earth's surface area in square metres used for the coverage
# fraction, and the sphere radius of the ring-area approximation.
EARTH_AREA_M2 = 510072000000000.0
SPHERE_RADIUS_M = 6378137.0


def polygon_areas(edges: DataFrame) -> DataFrame:
    """I9 helper: spherical area per polygon from its closed edge list,
    ``R^2 |sum (lon2 - lon1) (2 + sin lat1 + sin lat2)| / 2`` (edges taken as
    rhumb-free great-circle approximations).  A partial aggregate per tzid."""
    term = (F.radians(F.col("x2")) - F.radians(F.col("x1"))) * (
        2 + F.sin(F.radians(F.col("y1"))) + F.sin(F.radians(F.col("y2"))))
    return edges.groupBy("tzid").agg(
        (F.abs(F.sum(term)) * F.lit(SPHERE_RADIUS_M ** 2) / 2).alias("area_m2"))


def tz_coverage(edges: DataFrame, stops: DataFrame) -> DataFrame:
    """Fraction of the Earth covered by time zone polygons and the
    number of stops left without a time zone."""
    area = polygon_areas(edges).groupBy().agg((F.sum("area_m2") / F.lit(EARTH_AREA_M2)).alias("fraction_covered"))
    nulls = stops.groupBy().agg(
        F.sum(F.when(F.col("timezone").isNull(), 1).otherwise(0)).cast("bigint").alias("n_null_timezone"))
    return _one_row(area, nulls)


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two single-row aggregates into one row without a join: union
    them with typed NULLs in the other's columns, then a global ``max``."""
    cols_a, cols_b = a.columns, b.columns
    ua = a.select(*cols_a, *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in cols_b])
    ub = b.select(*[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in cols_a], *cols_b)
    return ua.unionByName(ub).groupBy().agg(*[F.max(c).alias(c) for c in cols_a + cols_b])


GEOJSON_LINE_SCHEMA = "struct<type:string,coordinates:array<array<double>>>"


def geojson_lines(df: DataFrame, col: str, out: str = "linestring") -> DataFrame:
    """A GeoJSON LineString text column -> array<struct<lon,lat>>."""
    parsed = F.from_json(F.col(col), GEOJSON_LINE_SCHEMA)
    pts = F.transform(parsed["coordinates"], lambda c: make_point(F.element_at(c, 1), F.element_at(c, 2)))
    return df.withColumn(out, F.when(F.lower(parsed["type"]) == "linestring", pts))
