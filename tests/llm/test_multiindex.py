"""Multi-index search: recall and exact scores against brute force, copies, blocks, defined results."""

import numpy as np
import pytest

from headway.llm import multiindex

SF = "/root/testdata/sf0.1"
INF = float("inf")


def brute(rows, k, every):
    """Every query row's neighbours; rows are (id, vector)."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, v) in enumerate(good):
        if q % every == 0:
            scores = []
            for other, (c, w) in enumerate(good):
                if other != at:
                    n = max(len(v), len(w))
                    scores.append((-multiindex.cosine(multiindex.scaled(np.pad(v, (0, n - len(v)))[None])[0],
                                                      multiindex.scaled(np.pad(w, (0, n - len(w)))[None])[0]), c))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_heap_walk_takes_pairs_in_order():
    r = np.random.default_rng(1)
    near, far, counts = r.random(7), r.random(5), r.integers(0, 4, (7, 5))
    total = (near[:, None] + far[None]).ravel()
    order = np.argsort(total)
    for want in range(1, counts.sum() + 3):
        enough = np.searchsorted(np.cumsum(counts.ravel()[order]), want)
        assert multiindex.walk(near, far, counts, want) == total[order[min(enough, 34)]]


def test_block_plan_splits_large_lists():
    first, parts = multiindex._block_plan(np.array([3, 4, 25, 1, 9, 2]), 10)
    assert parts == [1, 1, 3, 1, 1, 1]
    assert first == [0, 0, 1, 4, 4, 5]


@pytest.mark.parametrize("block_rows,pack_queries", [(16384, 512), (7, 2)])
def test_defined_results(spark, block_rows, pack_queries):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]                      # copies, some of them queries
    rows += [(10, rows[3][1]), (10, rows[3][1]), (20, [2 * x for x in rows[7][1]]), (40, [1.0]), (41, [1e-320, 0.0]), (42, [1e300, 1e300])]
    rows += [(50, None), (51, []), (60, [0.0] * 6), (70, [1.0, None]), (80, [1.0, INF]), (90, [float("nan")]), (None, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, a int").repartition(3)
    assert found(multiindex.search(df, 5, 10, block_rows, pack_queries, share=1.0)) == brute(rows, 5, 10)
    assert found(multiindex.search(df.where("false"), 5, 10)) == []
    assert found(multiindex.search(df.limit(0).unionByName(df.where("vec_id = 7")), 5, 7)) == []
    assert len(found(multiindex.search(df.where("vec_id in (30, 1, 2)"), 5, 10))) == 2           # fewer than k candidates


def test_recall_and_exact_scores(spark, monkeypatch):
    """sf0.1, with the least number of visited entries taken away."""
    monkeypatch.setattr(multiindex, "WHOLE", 1)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(x.vec_id, x.embedding) for x in df.collect()]
    want = brute(rows, 5, 50)
    got = found(multiindex.search(df, 5, 50))
    truth = {(q, c): s for q, _, c, s in want}
    assert len(got) == len(want) and len({(q, c) for q, _, c, _ in got}) == len(got)
    hits = [(q, c) for q, _, c, _ in got if (q, c) in truth]
    assert len(hits) >= 0.9 * len(truth)
    assert all(s == truth[q, c] for q, _, c, s in got if (q, c) in truth)
    assert all(a[0] != b[0] or (-a[3], a[2]) < (-b[3], b[2]) for a, b in zip(got, got[1:]))


def test_share_is_small_where_vectors_cluster():
    r = np.random.default_rng(4)
    centres = r.normal(size=(100, 16)) * 4
    loose = multiindex.Index.fitted(r.normal(size=(4000, 16)), 4000, 5)
    tight = multiindex.Index.fitted(centres[r.integers(0, 100, 4000)] + 0.3 * r.normal(size=(4000, 16)), 4000, 5)
    assert tight.share < loose.share


def test_driver_gets_one_sample_however_many_tasks_there_are(spark, monkeypatch):
    monkeypatch.setattr(multiindex, "SAMPLE", 1000)
    conf, held = spark.sparkContext._jsc.sc().conf(), {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r.normal(size=(9600, 16)))], "vec_id long, embedding array<double>")
    limit = conf.get("spark.driver.maxResultSize", "1g")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # a file per task
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        conf.set("spark.driver.maxResultSize", "500k")
        assert multiindex.search(df, 5, 400).count() == 24 * 5
    finally:
        conf.set("spark.driver.maxResultSize", limit)
        for k, v in held.items():
            spark.conf.set(k, v)


def test_sample_is_of_the_smallest_hashes(spark):
    """Whether or not the cutoff lets enough through at first."""
    df = spark.createDataFrame([(h, b, [float(b)]) for b, h in enumerate([2**63 - 1, -2**63, 5, 2**62, 2**62 + 1, 2**62, 7, 2**61])],
                               "a long, b long, embedding array<double>")
    order = [1.0, 2.0, 6.0, 7.0, 3.0, 5.0, 4.0, 0.0]
    for size in (1, 2, 5, 7, 8, 20):
        assert [x[0] for x in multiindex._sample(df, 8, size)["embedding"]] == order[:size]


@pytest.mark.parametrize("shelves,tile_bytes", [(1, 1 << 20), (1, 100), (3, 400), (100, 100)])
def test_shelves_of_several_blocks_and_tiles_of_queries(spark, monkeypatch, shelves, tile_bytes):
    monkeypatch.setattr(multiindex, "SHELVES", shelves)
    monkeypatch.setattr(multiindex, "TILE_BYTES", tile_bytes)
    r = np.random.default_rng(6)
    rows = [(i, r.normal(size=6 - i % 2).tolist()) for i in range(80)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(10, rows[3][1]), (20, [2 * x for x in rows[7][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert found(multiindex.search(df, 5, 10, 7, 2, share=1.0)) == brute(rows, 5, 10)


def _moved(df):
    """Bytes that the plan of ``df`` sent through shuffles."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("dataSize").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_entries_are_not_sent_once_for_each_pack_of_queries(spark, monkeypatch):
    moved, write = [], multiindex.write_table
    monkeypatch.setattr(multiindex, "write_table", lambda df, name: (moved.append(_moved(df)) if name == "multi-index-found" else None) or write(df, name))
    r = np.random.default_rng(7)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r.normal(size=(3000, 16)))], "vec_id long, embedding array<double>")
    assert multiindex.search(df, 5, 25, pack_queries=2).count() == 120 * 5
    assert 0 < moved[0] < 4 * 3000 * 16 * 8
