"""Geography helpers without geo types: point = struct<lon,lat>,
line = array<struct<lon,lat>> (I4-I8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres -> miles factor, WGS84 axes.
METRES_TO_MILES = 0.000621371192237
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def make_point(lon, lat) -> Column:
    return F.struct(_c(lon).cast("double").alias("lon"), _c(lat).cast("double").alias("lat"))


def lon(point) -> Column:
    return _c(point).getField("lon")


def lat(point) -> Column:
    return _c(point).getField("lat")


def n_points(line) -> Column:
    return F.size(_c(line))


def point_text(point) -> Column:
    return F.format_string("%.6f %.6f", lon(point), lat(point))


def line_text(line) -> Column:
    """'LINESTRING(lon lat, ...)' with six decimals."""
    pts = F.transform(_c(line), lambda p: F.format_string("%.6f %.6f", p["lon"], p["lat"]))
    return F.concat(F.lit("LINESTRING("), F.array_join(pts, ", "), F.lit(")"))


def segment_metres(lon1, lat1, lon2, lat2) -> Column:
    """Geodesic distance on the WGS84 ellipsoid, Lambert's formula.

    Within a few metres of the exact geodesic for the lengths a transit
    shape segment has; everything stays a Column expression.
    """
    r = F.lit(WGS84_A)
    f = WGS84_F
    b1 = F.atan((1 - f) * F.tan(F.radians(_c(lat1))))
    b2 = F.atan((1 - f) * F.tan(F.radians(_c(lat2))))
    dlon = F.radians(_c(lon2) - _c(lon1))
    # central angle of the reduced latitudes (haversine form, stable)
    h = (F.pow(F.sin((b2 - b1) / 2), 2)
         + F.cos(b1) * F.cos(b2) * F.pow(F.sin(dlon / 2), 2))
    sigma = 2 * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
    p = (b1 + b2) / 2
    q = (b2 - b1) / 2
    x = (sigma - F.sin(sigma)) * F.pow(F.sin(p) * F.cos(q), 2) / F.pow(F.cos(sigma / 2), 2)
    y = (sigma + F.sin(sigma)) * F.pow(F.cos(p) * F.sin(q), 2) / F.pow(F.sin(sigma / 2), 2)
    dist = r * (sigma - f / 2 * (x + y))
    return F.when(sigma == 0, F.lit(0.0)).otherwise(dist)
