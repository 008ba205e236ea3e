"""Centroid clustering: intervals hold the distances, results equal plain Lloyd rounds in Python integers."""

import hashlib
from collections import Counter
from fractions import Fraction
from math import floor, isfinite

import numpy as np

from headway.llm import vafile


def plain_version(rows, k=8, rounds=10):
    kept = [(i, [floor(Fraction(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    def seed(row):
        return (row[0] is None, "" if row[0] is None else hashlib.sha256(f"3:{row[0]}".encode()).hexdigest(), row[1])
    centroids = [v for _, v in sorted(kept, key=seed)[:k]]
    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)))
        return out
    for _ in range(rounds):
        cluster = [n for _, n in assign()]
        for n in set(cluster):
            members = [v for (_, v), c in zip(kept, cluster) if c == n]
            centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    last = assign()
    by = Counter()
    for d, n in last:
        by[n] += d
    top = vafile.LARGEST
    return sorted(((i, n, min(d, top), min(by[n], top), min(sum(by.values()), top), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, last)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "w") for i, v in rows], "vec_id long, embedding array<double>, cluster int, weight string").repartition(3)


def test_intervals_hold_every_distance():
    r = np.random.default_rng(0)
    vectors = r.integers(-3000, 3000, (500, 64))
    marks = np.quantile(vectors[:100], np.arange(1, 16) / 16, axis=0, method="higher").T.astype(np.int64)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    marks = np.clip(marks, low[:, None] + 1, high[:, None] + 1)
    centroids = [list(map(int, v)) for v in vectors[:8] // 2]
    cells = vafile.cells_of(vectors, marks)
    assert (vafile.unpacked(vafile.packed(cells)) == cells).all()
    near, far = vafile.lookup(marks, low, high, centroids)
    exact = vafile.squared(vectors, centroids)
    lower = sum(near[d][cells[:, d]] for d in range(64))
    upper = sum(far[d][cells[:, d]] for d in range(64))
    assert (lower <= exact).all() and (exact <= upper).all()
    found = vafile.settled(cells, near, far)
    assert (found[found >= 0] == exact.argmin(axis=1)[found >= 0]).all()


def test_settled_leaves_ties_to_the_smaller_number():
    """One-value cells: intervals are the distances themselves."""
    marks = np.array([np.arange(1, 16)] * 64)
    low, high = np.zeros(64, dtype=np.int64), np.full(64, 15)
    cells = np.full((1, 64), 4, dtype=np.uint8)
    near, far = vafile.lookup(marks, low, high, [[5] * 64, [3] * 64, [5] * 64])
    assert vafile.settled(cells, near, far).tolist() == [0]


def test_clusters_settle_most_vectors():
    r = np.random.default_rng(5)
    centres = r.integers(-4000, 4000, (4, 64))
    vectors = centres[r.integers(0, 4, 2000)] + r.integers(-50, 50, (2000, 64))
    marks = np.quantile(vectors, np.arange(1, 16) / 16, axis=0, method="higher").T.astype(np.int64)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    marks = np.clip(marks, low[:, None] + 1, high[:, None] + 1)
    near, far = vafile.lookup(marks, low, high, [list(map(int, c)) for c in centres])
    assert (vafile.settled(vafile.cells_of(vectors, marks), near, far) >= 0).mean() > 0.9


def test_equals_plain_rounds(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(5, 64))
    rows = [(i, (centres[i % 5] + 0.4 * r.normal(size=64)).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(60)] + [(7, rows[8][1]), (7, rows[8][1]), (7, rows[9][1]), (None, rows[3][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [None] + [1.0] * 63), (304, [float("nan")] * 64), (305, [float("inf")] * 64)]
    assert result(vafile.cluster(frame(spark, rows))) == plain_version(rows)


def test_components_beyond_int64(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=64) * 10.0 ** (i % 4 * 100)).tolist()) for i in range(30)]
    assert result(vafile.cluster(frame(spark, rows), rounds=3)) == plain_version(rows, rounds=3)


def test_few_equal_or_no_vectors(spark):
    one = [0.5] * 64
    for rows in ([(1, one)], [(1, one), (2, one), (3, [-0.5] * 64)], [(i, one) for i in range(20)]):
        assert result(vafile.cluster(frame(spark, rows))) == plain_version(rows)
    assert vafile.cluster(frame(spark, [(1, None)])).count() == 0
    assert vafile.cluster(frame(spark, rows).where("false")).count() == 0
