"""A quadtree cover of polygons by grid cells.

Every polygon is covered by square cells of ``tz_cell_degrees``.  A cell that
no edge cuts lies inside or outside as a whole; inside cells are kept without
edges.  A cell that edges cut is a border cell: it keeps just those edges, and
whether its centre is inside.  Cells that more than ``CELL_EDGES`` edges of all
polygons cut are split into four, up to ``tz_cover_levels`` times.

A point looks its cell up on every level.  In an inside cell it needs no edge.
In a border cell it is reached from the centre by a horizontal and a vertical
step within the cell; every edge crossed on the way changes sides.  Points and
edges are compared as if each point were shifted by an infinitesimal amount
east and a much smaller one north, which is the half-open rule of ray casting,
so touching vertices and edges need no special case and holes, several parts
and neighbouring polygons that share an edge come out right.

All steps are sort-merge joins on cell keys and partial aggregates: the cover
grows with the map, and a broadcast of cells keyed by several columns takes a
whole memory page (64 MB) of the driver however few they are.  Each level is
written once under the checkpoint folder; the driver asks once a level whether to go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.session import scratch_table

CELL_EDGES = 16
KEY = ["level", "cx", "cy"]
_EDGE = ["x1", "y1", "x2", "y2"]
_SLACK = 1e-9               # a cell may keep an edge that only comes this near; it changes nothing


@dataclass(frozen=True)
class Cover:
    """``cells`` (level, cx, cy, tzid, is_border, centre_inside) and ``cuts``, the border cells' edges."""

    cells: DataFrame
    cuts: DataFrame
    size: float
    levels: int


def crosses_east(x: Column, y: Column) -> Column:
    """An edge that a ray from (x, y) to the east crosses."""
    at = F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))
    return ((F.col("y1") > y) != (F.col("y2") > y)) & (x < at)


def _crosses_step(x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """How often an edge is crossed on the way from (x0, y0) east or west to x, then north or south to y."""
    xc = F.col("x1") + F.try_divide((y0 - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))
    level = ((F.col("y1") > y0) != (F.col("y2") > y0)) & ((x0 < xc) != (x < xc))
    slope = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    yc = F.col("y1") + (x - F.col("x1")) * slope
    def below(v):
        return (yc < v) | ((yc == v) & (slope <= 0))
    upright = ((F.col("x1") > x) != (F.col("x2") > x)) & (below(y0) != below(y))
    # level and upright edges have no xc or slope; the test before them fails there
    return F.coalesce(level, F.lit(False)).cast("int") + F.coalesce(upright, F.lit(False)).cast("int")


def _cuts_cell(size: Column | float) -> Column:
    """Whether the edge meets the closed cell (cx, cy): boxes overlap, and the corners lie on both sides of its line."""
    s = F.lit(size) if isinstance(size, float) else size
    w, b = F.col("cx") * s, F.col("cy") * s
    e, t = w + s, b + s
    side = [(F.col("x2") - F.col("x1")) * (v - F.col("y1")) - (F.col("y2") - F.col("y1")) * (u - F.col("x1")) for u in (w, e) for v in (b, t)]
    return ((F.least("x1", "x2") <= e + _SLACK) & (F.greatest("x1", "x2") >= w - _SLACK)
            & (F.least("y1", "y2") <= t + _SLACK) & (F.greatest("y1", "y2") >= b - _SLACK)
            & (F.least(*side) <= _SLACK) & (F.greatest(*side) >= -_SLACK))


def _range(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def _first_level(edges: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Cells and cuts of the coarsest level."""
    x_low, x_high = F.least("x1", "x2"), F.greatest("x1", "x2")
    y_low, y_high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.select("tzid", *_EDGE, _range(y_low, y_high, size).alias("cy"))
    cuts = (rows.select("*", _range(x_low, x_high, size).alias("cx")).where(_cuts_cell(size))
            .select(F.lit(0).alias("level"), "cx", "cy", "tzid", *_EDGE))
    box = edges.groupBy("tzid").agg(F.min(x_low).alias("w"), F.max(x_high).alias("e"), F.min(y_low).alias("s"), F.max(y_high).alias("n"))
    boxes = (box.select("*", _range(F.col("w"), F.col("e"), size).alias("cx"))
             .select("tzid", "cx", _range(F.col("s"), F.col("n"), size).alias("cy")))
    east = crosses_east((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size)
    odd = (boxes.join(rows.hint("merge"), ["tzid", "cy"]).where(east).groupBy("tzid", "cx", "cy")
           .agg((F.count(F.lit(1)) % 2 == 1).alias("centre_inside")))
    border = cuts.groupBy("tzid", "cx", "cy").agg(F.count(F.lit(1)).alias("n_cuts"))
    cells = (border.join(odd, ["tzid", "cx", "cy"], "full")
             .select(F.lit(0).alias("level"), "cx", "cy", "tzid", F.coalesce("n_cuts", F.lit(0)).alias("n_cuts"),
                     F.coalesce("centre_inside", F.lit(False)).alias("centre_inside"))
             .where((F.col("n_cuts") > 0) | F.col("centre_inside")))
    return cells, cuts


def _split(cells: DataFrame, cuts: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """The quarters of ``cells`` (all of one level, ``size`` wide) and the edges that cut them."""
    half = size / 2
    quarters = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)])
    parted = (cuts.join(cells.select(*KEY, "tzid", "centre_inside").hint("merge"), [*KEY, "tzid"])
              .select("*", F.explode(quarters).alias("q"))
              .select(*_EDGE, "tzid", "centre_inside", ((F.col("cx") + 0.5) * size).alias("x0"), ((F.col("cy") + 0.5) * size).alias("y0"),
                      (F.col("level") + 1).alias("level"), (2 * F.col("cx") + F.col("q.dx")).alias("cx"), (2 * F.col("cy") + F.col("q.dy")).alias("cy")))
    steps = _crosses_step(F.col("x0"), F.col("y0"), (F.col("cx") + 0.5) * half, (F.col("cy") + 0.5) * half)
    marked = parted.select("*", steps.alias("steps"), _cuts_cell(half).alias("cut"))
    fine = (marked.groupBy(*KEY, "tzid").agg(
        F.count_if("cut").alias("n_cuts"), (F.first("centre_inside") != (F.sum("steps") % 2 == 1)).alias("centre_inside"))
        .where((F.col("n_cuts") > 0) | F.col("centre_inside")))
    return fine.select(*KEY, "tzid", "n_cuts", "centre_inside"), marked.where("cut").select(*KEY, "tzid", *_EDGE)


def build_cover(edges: DataFrame, cfg: MigrateConfig | None = None) -> Cover:
    """Cover of the polygons given by their edges (tzid, x1, y1, x2, y2)."""
    cfg = cfg or MigrateConfig()
    size, most = float(cfg.tz_cell_degrees), max(0, int(cfg.tz_cover_levels))
    edges = edges.select("tzid", *_EDGE)
    cells, cuts = (scratch_table(df, "cover") for df in _first_level(edges, size))
    done_cells, done_cuts, level = [], [], 0
    while True:
        # a point in a cell meets the edges of all its polygons
        crowded = cells.groupBy(*KEY).agg(F.sum("n_cuts").alias("n")).where(F.col("n") > CELL_EDGES).select(*KEY).hint("merge")
        if level == most or crowded.isEmpty():
            done_cells.append(cells)
            done_cuts.append(cuts)
            break
        border = F.col("n_cuts") > 0
        split = cells.where(border).join(crowded, KEY, "left_semi")
        done_cells.append(cells.where(~border).unionByName(cells.where(border).join(crowded, KEY, "left_anti")))
        done_cuts.append(cuts.join(crowded, KEY, "left_anti"))
        cells, cuts = (scratch_table(df, "cover") for df in _split(split, cuts, size / 2 ** level))
        level += 1
    every_cell, every_cut = done_cells[0], done_cuts[0]
    for c, e in zip(done_cells[1:], done_cuts[1:]):
        every_cell, every_cut = every_cell.unionByName(c), every_cut.unionByName(e)
    return Cover(every_cell.select(*KEY, "tzid", (F.col("n_cuts") > 0).alias("is_border"), "centre_inside"), every_cut, size, level)


def _placed(points: DataFrame, cover: Cover, salts: int) -> DataFrame:
    """Points beside the cells that hold them; a crowded cell is dealt over ``salts``."""
    keys = F.array(*[F.struct(F.lit(i).alias("level"), F.floor(F.col("lon") / (cover.size / 2 ** i)).alias("cx"),
                              F.floor(F.col("lat") / (cover.size / 2 ** i)).alias("cy")) for i in range(cover.levels + 1)])
    salt = F.pmod(F.xxhash64("lon", "lat"), F.lit(salts)).cast("int").alias("salt")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    return (points.select("lon", "lat", salt, F.explode(keys).alias("k")).select("lon", "lat", "salt", "k.*")
            .join(cover.cells.select("*", copies).hint("merge"), [*KEY, "salt"]))


def candidate_edges(points: DataFrame, cover: Cover, salts: int = 1) -> DataFrame:
    """Points in border cells beside every edge that they are compared with."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    return _placed(points, cover, salts).where("is_border").join(cover.cuts.select("*", copies).hint("merge"), [*KEY, "salt", "tzid"])


def containing_polygons(points: DataFrame, cover: Cover, salts: int = 1) -> DataFrame:
    """(lon, lat, tzid) for every polygon that holds a point; ``points`` are distinct and have no NULL."""
    inside = _placed(points, cover, salts).where(~F.col("is_border")).select("lon", "lat", "tzid")
    size = F.lit(cover.size) / F.pow(F.lit(2.0), F.col("level"))
    steps = _crosses_step((F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size, F.col("lon"), F.col("lat"))
    border = (candidate_edges(points, cover, salts).groupBy("lon", "lat", "tzid")
              .agg(F.first("centre_inside").alias("centre_inside"), F.sum(steps).alias("steps"))
              .where(F.col("centre_inside") != (F.col("steps") % 2 == 1)).select("lon", "lat", "tzid"))
    return inside.unionByName(border)
