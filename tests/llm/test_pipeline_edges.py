"""The five stages one after the other on nulls, empty and repeated rows, clashing columns and empty tables."""

from collections import Counter

import corpus_pipeline
from headway.llm.store import write_table

from .test_decontam import brute
from .test_edge_cases import ITEM, SCHEMA, messy
from .test_jaccard import components

LABELS = [(5, 1, 0), (5, 0, 0), (7, 1, 1), (9, None, None), (None, 1, 0), (999, 1, 0), (13, 0, 0)]
ITEMS = [(1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "one", 0), (4, "one", 0), (None, ITEM + " lambda", 0)]


def tables(spark, folder, labels=LABELS, items=ITEMS):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string, n int").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_on_messy_rows(spark, tmp_path):
    folder = tables(spark, tmp_path)
    docs = spark.createDataFrame(messy(), SCHEMA).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, after = rows(docs), write_table(stage(spark, docs, folder), name)
        kept = rows(after)
        assert after.columns == docs.columns and not kept - before
        if name == "language":                          # no letters, no language
            assert not any(not (r[1] or "").strip() or r[0] == 13 for r in kept) and sum(before.values()) - sum(kept.values()) == 6
        if name == "near_duplicates":                   # equal rows and ids count once; a null id never names a group
            found = components([(10**9 if r[0] is None else r[0], r[1]) for r in before.elements()])
            assert sorted(r[0] for r in kept.elements()) == sorted({c for _, _, c in found})
        if name == "decontaminate":
            leaked = {d for d, *_ in brute([(r[0], r[1]) for r in before], [i[:2] for i in ITEMS])}
            assert leaked and kept == Counter({r: n for r, n in before.items() if r[0] not in leaked})
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in docs.collect())
    for shard in {r["shard"] for r in last}:
        slots = sorted(r["slot"] for r in last if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_stages_on_empty_tables(spark, tmp_path):
    folder = tables(spark, tmp_path, [], [])
    nothing = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, folder)
        assert out.count() == 0
        assert name == "shard" or out.columns == nothing.columns
