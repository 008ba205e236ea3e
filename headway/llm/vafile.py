"""Centroid clustering with exact integer sums over a vector-approximation file.

Vectors become integers floor(1024 * x).  Equal vectors are grouped (partial
aggregation first, so a third of all rows with one vector is one row with a
weight) and written once, bucketed by a 128-bit hash.  Beside them stands the
approximation file: per vector and dimension the number of one of 16 cells
(4 bits), whose marks are quantiles of a sample and whose outer ends are the
exact least and largest component, so every cell is a closed interval.

A round of Lloyd's algorithm reads the approximations only.  Tables of the
squared distance from each centroid to the near and far end of every cell give
a distance interval per centroid.  A vector is settled where one centroid's
upper bound lies below all other lower bounds, both for the centroids of this
round and for those of the last, and both agree: it adds nothing to the change
of the sums.  The others, whose intervals overlap or whose centroid changed, are
fetched from the bucketed table (only their keys are shuffled), assigned
exactly, and move their components between the sums.  The driver holds the
centroids and the sums, never a vector beyond the sample and the seeds.

Ties go to the smaller centroid number.  All sums and distances are exact:
int64 while every component is below 2**27, Python integers beyond (there the
approximations settle nothing).

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; a null id is kept (its vector sorts last
among the seeds); equal ids are separate rows, seeds tied by hash are ordered by
vector; with fewer vectors than centroids there are fewer centroids; centroids
may be equal, the later one then stays empty where it is; a distance or
inertia beyond 64 bits is given as 2**63 - 1; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .store import bucketed_table, drop_table, ship, write_table

DIM, SCALE = 64, 1024
CELLS = 16                 # of every dimension
SAMPLE = 20_000            # vectors that place the marks between cells, at most
NARROW = 1 << 27           # components below it are summed in int64
LARGEST = (1 << 63) - 1
BATCH = 4096

_SUMS = "cluster int, weight string, sums array<string>"


def integers(column: pd.Series, narrow: bool) -> np.ndarray:
    """floor(1024 * x) of every component: int64, or Python integers where they may be large."""
    if narrow:
        return np.floor(np.stack(column.to_numpy()).astype(np.float64) * SCALE).astype(np.int64)
    exact = [[int(x) * SCALE if abs(x) >= 2.0 ** 52 else int(np.floor(x * SCALE)) for x in map(float, v)] for v in column]
    return np.array(exact, dtype=object).reshape(len(column), DIM)


def squared(vectors: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Squared distance of every vector to every centroid."""
    return np.stack([((vectors - np.array(c, dtype=vectors.dtype)) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(distance: np.ndarray) -> np.ndarray:
    """Number of the smallest distance in each row, the first of equal ones."""
    if distance.dtype != object:
        return distance.argmin(axis=1)
    return np.array([min(range(len(row)), key=lambda c: (row[c], c)) for row in distance], dtype=np.int64)


def cells_of(vectors: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Cell numbers; ``marks`` (dimension x 15) are the least values of the cells 1 to 15."""
    return np.stack([np.searchsorted(marks[d], vectors[:, d], side="right") for d in range(vectors.shape[1])], axis=1).astype(np.uint8)


def packed(cells: np.ndarray) -> list[bytes]:
    """Two cells a byte."""
    both = cells[:, 0::2] << 4 | cells[:, 1::2]
    return [row.tobytes() for row in both]


def unpacked(column: pd.Series) -> np.ndarray:
    both = np.frombuffer(b"".join(column), np.uint8).reshape(len(column), DIM // 2)
    return np.stack([both >> 4, both & 15], axis=2).reshape(len(column), DIM)


def lookup(marks: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Tables (dimension x cell x centroid) of the least and largest squared distance to a cell."""
    first = np.concatenate([low[:, None], marks], axis=1)[:, :, None]
    last = np.concatenate([marks - 1, high[:, None]], axis=1)[:, :, None]
    c = np.array(centroids, dtype=np.int64).T[:, None, :]
    out = np.maximum(np.maximum(first - c, c - last), 0)
    far = np.maximum(np.abs(c - first), np.abs(c - last))
    return out ** 2, far ** 2


def settled(cells: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The centroid that the intervals single out, or -1 where they overlap."""
    lower = np.zeros((len(cells), near.shape[2]), dtype=np.int64)
    upper = np.zeros_like(lower)
    for d in range(cells.shape[1]):
        lower += near[d][cells[:, d]]
        upper += far[d][cells[:, d]]
    best = upper.argmin(axis=1)
    rows = np.arange(len(cells))
    bound = upper[rows, best]
    number = np.arange(lower.shape[1])
    # an equal distance leaves the vector with the smaller number
    beaten = np.where(number[None] < best[:, None], lower > bound[:, None], lower >= bound[:, None])
    beaten[rows, best] = True
    return np.where(beaten.all(axis=1), best, -1)


class Totals:
    """Weights and component sums by centroid, in Python integers."""

    def __init__(self, k: int):
        self.weight = [0] * k
        self.sums = [[0] * DIM for _ in range(k)]

    def add(self, cluster: np.ndarray, vectors: np.ndarray, weight: np.ndarray, sign: int) -> None:
        for c in np.unique(cluster):
            of = cluster == c
            times = weight[of].astype(object)
            self.weight[c] += sign * int(times.sum())
            if vectors.dtype != object and int(times.max()) < 1 << 20:
                total = (vectors[of] * weight[of, None]).sum(axis=0)         # below 2**12 * 2**20 * 2**27
            else:
                total = (vectors[of].astype(object) * times[:, None]).sum(axis=0)
            self.sums[c] = [a + sign * int(b) for a, b in zip(self.sums[c], total)]

    def frames(self) -> Iterator[pd.DataFrame]:
        if used := [c for c, w in enumerate(self.weight) if w or any(self.sums[c])]:
            yield pd.DataFrame({"cluster": used, "weight": [str(self.weight[c]) for c in used],
                                "sums": [[str(x) for x in self.sums[c]] for c in used]})


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for at in range(0, len(pdf), BATCH):
            yield pdf.iloc[at:at + BATCH]


def _collected(partial: DataFrame, k: int) -> Totals:
    """Sums the tasks' totals: at most ``k`` rows a task in, ``k`` rows to the driver."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = [sum(map(int, column)) for column in zip(*pdf["sums"])]
        return pd.DataFrame({"cluster": [pdf["cluster"].iloc[0]], "weight": [str(sum(map(int, pdf["weight"])))],
                             "sums": [[str(x) for x in sums]]})

    out = Totals(k)
    for row in partial.groupBy("cluster").applyInPandas(add, _SUMS).collect():
        out.weight[row["cluster"]] = int(row["weight"])
        out.sums[row["cluster"]] = [int(x) for x in row["sums"]]
    return out


def _first_totals(exact: DataFrame, centroids: list[list[int]], narrow: bool) -> Totals:
    """Sums of the first round, which needs every vector."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = Totals(len(centroids))
        for pdf in _batches(frames):
            vectors = integers(pdf["embedding"], narrow)
            totals.add(nearest(squared(vectors, centroids)), vectors, pdf["weight"].to_numpy(), 1)
        yield from totals.frames()

    return _collected(exact.select("embedding", "weight").mapInPandas(work, _SUMS), len(centroids))


def _changes(approx: DataFrame, exact: DataFrame, before: list[list[int]], now: list[list[int]], marks: np.ndarray, low: np.ndarray,
             high: np.ndarray, narrow: bool) -> Totals:
    """What the totals change by when ``now`` takes the place of ``before``."""
    def overlap(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = [lookup(marks, low, high, c) for c in (before, now)] if narrow else []
        for pdf in _batches(frames):
            if narrow:
                cells = unpacked(pdf["cells"])
                old, new = (settled(cells, *t) for t in tables)
                pdf = pdf[(old < 0) | (new < 0) | (old != new)]
            yield pdf[["a", "b"]]

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = Totals(len(now))
        for pdf in _batches(frames):
            vectors = integers(pdf["embedding"], narrow)
            old, new = nearest(squared(vectors, before)), nearest(squared(vectors, now))
            moved = old != new
            if moved.any():
                weight = pdf["weight"].to_numpy()[moved]
                totals.add(old[moved], vectors[moved], weight, -1)
                totals.add(new[moved], vectors[moved], weight, 1)
        yield from totals.frames()

    fetched = approx.mapInPandas(overlap, "a long, b long").join(exact, ["a", "b"])
    return _collected(fetched.select("embedding", "weight").mapInPandas(move, _SUMS), len(now))


def _moved(totals: Totals, centroids: list[list[int]]) -> list[list[int]]:
    return [[s // n for s in sums] if n else c for c, n, sums in zip(centroids, totals.weight, totals.sums)]


def fit(vectors: DataFrame, seeds: list, rounds: int) -> tuple[list[list[int]], bool]:
    """Centroids after ``rounds`` rounds, and whether the components are narrow."""
    exact = bucketed_table(
        vectors.select(F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit(1), "embedding").alias("b"), "embedding")
        .groupBy("a", "b").agg(F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("weight")), ["a", "b"], "va-exact")
    ends = {r["d"]: (r["low"], r["high"]) for r in
            exact.select(F.posexplode("embedding").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    low, high = ([ends[d][i] for d in range(DIM)] for i in (0, 1))
    narrow = max(map(abs, low + high)) * SCALE < NARROW - 1
    centroids = [list(map(int, v)) for v in integers(pd.Series(seeds), narrow)]
    marks, approx = None, exact.select("a", "b")
    if narrow:
        low, high = (np.floor(np.array(x, dtype=np.float64) * SCALE).astype(np.int64) for x in (low, high))
        sample = integers(exact.orderBy("a", "b").limit(SAMPLE).select("embedding").toPandas()["embedding"], True)
        marks = np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="higher").T.astype(np.int64)
        marks = np.clip(marks, low[:, None] + 1, high[:, None] + 1)

        def approximate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in _batches(frames):
                yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "cells": packed(cells_of(integers(pdf["embedding"], True), marks))})

        approx = write_table(exact.select("a", "b", "embedding").mapInPandas(approximate, "a long, b long, cells binary"), "va-cells")
    totals = _first_totals(exact, centroids, narrow)
    for _ in range(rounds - 1):
        before, centroids = centroids, _moved(totals, centroids)
        if before == centroids:
            break                                   # nothing moves any more
        change = _changes(approx, exact, before, centroids, marks, low, high, narrow)
        totals.weight = [a + b for a, b in zip(totals.weight, change.weight)]
        totals.sums = [[x + y for x, y in zip(a, b)] for a, b in zip(totals.sums, change.sums)]
    centroids = _moved(totals, centroids) if rounds else [list(map(int, v)) for v in integers(pd.Series(seeds), narrow)]
    drop_table(exact)
    drop_table(approx)
    return centroids, narrow


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, salt: int = 3) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    spark = vectors.sparkSession
    ship(spark)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == DIM) & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    seeds = [r["embedding"] for r in kept.orderBy(drawn.asc_nulls_last(), "embedding").limit(k).collect()]
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids, narrow = fit(kept, seeds, rounds)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _batches(frames):
            distance = squared(integers(pdf["embedding"], narrow), centroids)
            best = nearest(distance)
            reached = distance[np.arange(len(best)), best]
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "cluster": best.astype(np.int32),
                                "distance": [min(int(x), LARGEST) for x in reached]})

    assigned = write_table(kept.mapInPandas(assign, "vec_id long, cluster int, distance long"), "va-assigned")
    total = F.sum(F.col("distance").cast("decimal(19,0)"))
    by_cluster = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}   # k rows
    inertia = min(sum(by_cluster.values()), LARGEST)
    facts = spark.createDataFrame(
        [(c, min(t, LARGEST), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, t in by_cluster.items()],
        "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(            # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256")


def _oracle(k: int = 8, rounds: int = 10) -> str:
    """The rounds unrolled: centroids of a round as one row each, an assignment per round."""
    parts = [f"""
v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS w
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h NULLS LAST, w) - 1)::INTEGER AS cluster, w
  FROM (SELECT sha256('3:' || vec_id::VARCHAR) AS h, w FROM v ORDER BY 1 NULLS LAST, w LIMIT {k}) s)"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, w, cluster, distance FROM (
    SELECT v.r, v.vec_id, v.w, c.cluster, d.distance, row_number() OVER (PARTITION BY v.r ORDER BY d.distance, c.cluster) AS pos
    FROM v CROSS JOIN c{i} c, LATERAL (SELECT list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance) d) q
  WHERE pos = 1)""")
        if i < rounds:
            parts.append(f"""
m{i} AS MATERIALIZED (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS w FROM (
    SELECT cluster, d, sum(w[d])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i}, range(1, {DIM + 1}) t(d) GROUP BY cluster, d) q
  GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.w, c.w) AS w FROM c{i} c LEFT JOIN m{i} m USING (cluster))""")
    return "WITH" + ",".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.w, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


ORACLE_SQL = _oracle()
