"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import decontam, html, jaccard, langid, licenses, lines, lm, mixing, sharding, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, mark long, label string, host string, key string, n int"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def messy():
    long = " ".join(f"w{i % 5000}" for i in range(120_000))
    texts = [None, "", " \n\t ", "one", "One", "a b c d e f g h i j k", "a b c d e f g h i j k", long, long + " tail",
             "x" * 200_000, f"Zero {ITEM.upper()} end of it", "MIT License here", "é è ü ß 你好 世界", "12345 !!! ???"]
    rows = [(i, t, None if i % 4 == 0 else "en" if i % 2 else "fr", None if i % 3 == 0 else f"s{i % 2}") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "a b c d e f g h i j k", None, None), (None, None, None, None), (None, None, None, None)]
    return [(*r, None, 7, 7, 7, "l", "h", "k", 7) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(messy(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "one", 0), (4, "one", 0), (None, ITEM + " lambda", 0)],
                                 "item_id long, text string, n int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 0, 0), (7, 1, 1), (9, None, None), (None, 1, 0), (999, 1, 0), (13, 0, 0)],
                                 "doc_id long, quality int, toxic int")


N = len(messy())


def test_mixing(docs, labels, nothing):
    rows = mixing.rates(docs, labels).collect()
    assert len(rows) == N
    assert all(r["rate"] >= 0 and abs(sum(r["p"]) - 1) < 1e-9 for r in rows)
    assert len({(r["rate"], *r["p"]) for r in rows if r["doc_id"] == 5}) == 1
    assert mixing.mixed(docs, labels).columns == docs.columns
    assert mixing.rates(nothing, labels).count() == 0
    none = labels.where("false")
    assert {tuple(r["p"]) for r in mixing.rates(docs, none).collect()} == {(1.0,)}


def test_decontamination(docs, items, nothing):
    rows = sorted((tuple(r) for r in decontam.search(docs, items).collect()), key=str)
    assert [(r[0], r[1]) for r in rows] == [(10, 1), (10, None), (3, 4), (3, 4), (4, 4), (4, 4)]
    assert rows[1][2:4] == (7, 6)
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == N - 3
    assert decontam.search(nothing, items).count() == 0
    assert decontam.search(docs, items.where("false")).count() == 0
    assert decontam.clean(docs, items.where("false")).count() == N


def test_license_scan(docs, nothing):
    rows = {r["doc_id"]: r for r in licenses.digest(docs).collect()}
    assert licenses.digest(docs).count() == N
    assert (rows[0]["n_words"], rows[0]["first_word"], rows[0]["labels"], rows[0]["score"]) == (0, None, "", 0.0)
    assert (rows[11]["n_base"], rows[11]["first_word"], rows[11]["base_labels"]) == (1, 0, "mit")
    assert rows[7]["n_words"] == 120_000
    assert licenses.digest(nothing).count() == 0


def test_language_id(docs, nothing):
    rows = langid.identify(langid._documents(docs, F.struct("doc_id", "text").alias("k")), langid.fit(docs)).collect()
    assert len(rows) == N
    for r in rows:
        if not (r["key"]["text"] or "").strip() or r["key"]["doc_id"] == 13:
            assert not r["accepted"] and r["lang"] is None
        else:
            assert r["accepted"] and r["lang"] in ("en", "fr")
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == N - 6
    assert langid.accepted(nothing).count() == 0
    assert langid.accepted(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_jaccard(docs, nothing):
    rows = jaccard.join(docs).collect()
    assert len(rows) == N
    by = {r["doc_id"]: r for r in rows}
    assert (by[0]["n_shingles"], by[0]["component_id"]) == (0, 0) and by[2]["n_shingles"] == 0
    assert by[4]["component_id"] == 3 and by[6]["component_id"] == 5 and by[8]["component_id"] == 7
    assert sum(r["component_id"] == 5 for r in rows) == 5                   # with the repeats and the null id
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 5, 7, 9, 10, 11, 12, 13]
    assert kept.where("doc_id IS NULL").count() == 2                        # the empty ones
    assert jaccard.join(nothing).count() == 0 and jaccard.keep_one(nothing).count() == 0


def test_lines(docs, nothing, spark):
    rows = {r["doc_id"]: r for r in lines.clean(docs).collect()}
    assert lines.clean(docs).count() == N
    assert (rows[0]["n_lines"], rows[0]["text"]) == (0, None) and (rows[1]["n_lines"], rows[1]["text"]) == (1, "")
    assert lines.clean(nothing).count() == 0
    shared = spark.createDataFrame([(i, f"own {i}\n  menu \n\nmenu\nalmost {i % 9}", f"s{i}") for i in range(12)], "doc_id long, text string, source string")
    assert {r["text"] for r in lines.clean(shared).collect()} == {f"own {i}\n\nalmost {i % 9}" for i in range(12)}


def test_sharding(docs, nothing):
    rows = sharding.digest(docs, 3).collect()
    assert len(rows) == N
    for s in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 0} == {(16, 0)}
    assert sharding.digest(nothing, 3).count() == 0


def test_lm(docs):
    rows = lm.score(docs).collect()
    assert len(rows) == N
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (20, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [], 1), (7, [-1.0], 1), (40, [], 1), (None, [1.0, 2.0], 1), (8, [0.5, -0.5, 9.0], 1), (0, [0.0, -1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    valid = [(i, [int(np.floor(64 * x)) for x in v]) for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in {(i, tuple(q)) for i, q in valid if i % 20 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in valid if j != i)[:4]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    for shard_rows in (2, 100):
        got = [tuple(r) for r in topk.search(table, k=4, shard_rows=shard_rows, block_queries=2).collect()]
        assert sorted(got) == sorted(want)
    assert topk.search(table.where("false")).count() == 0


def test_html(spark):
    def page(i, extra=""):
        return (i, f"https://site.example/{i}", f"<body><nav>menu</nav><article><h1>T{i}</h1><p>body &amp; text {i}</p><p>Follow   us</p>{extra}</article></body>", 1)

    rows = [page(i) for i in range(30)]
    rows += [(100, None, None, 1), (101, "x", "", 1), (102, "https://site.example/z", "<p>", 1), (103, "https://other.example", "<p>Follow us", 1),
             (None, None, "plain", 1), rows[0]]
    rows += [(200 + i, "https://copies.example/a", "<article><p>same text</p></article>", 1) for i in range(40)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html.extract(table).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[3]["text"] == "T3\n\nbody & text 3" and by[3]["n_template_blocks"] == 1 and by[3]["n_chars"] == len(by[3]["text"])
    assert [by[i]["text"] for i in (100, 101, 102)] == ["", "", ""]
    assert by[103]["text"] == "Follow us" and by[None]["text"] == "plain" and by[200]["text"] == "same text"
    assert html.extract(table.where("false")).count() == 0
