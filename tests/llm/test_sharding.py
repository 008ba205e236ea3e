"""The assignment against a plain recount and a plain packing of the same items."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import sharding
from headway.llm.queries import table

MORE = "/root/testdata/sf0.01"


def plain_pack(items, n_shards):
    """Largest share first, to the shard whose residual capacity has the highest dot product; in plain Python."""
    total = [max(1.0, sum(i[d] for i in items)) for d in range(3)]
    share = [[i[d] / total[d] for d in range(3)] for i in items]
    left, out = [[1 / n_shards] * 3 for _ in range(n_shards)], [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-max(share[i]), i)):
        best = max(range(n_shards), key=lambda s: (sum(left[s][d] * share[i][d] * sharding.WEIGHTS[d] for d in range(3)), -s))
        out[i] = best
        left[best] = [a - b for a, b in zip(left[best], share[i])]
    return out


def test_packing_equals_plain_python():
    rng = np.random.default_rng(8)
    for n_shards in (1, 3, 40):
        items = rng.integers(1, 10_000, (300, 3)) * rng.choice([1, 1, 1, 50], (300, 1))
        assert sharding.pack(items.astype(float), n_shards).tolist() == plain_pack(items.tolist(), n_shards)


@pytest.mark.parametrize("rows_per_bundle", [sharding.ROWS_PER_BUNDLE, 40])
def test_a_group_of_a_third_of_all_rows(spark, rows_per_bundle):
    """Level shards, gapless slots, every row once, whatever number of rows one task may sort."""
    docs = table(spark, MORE, "documents").select("doc_id", "text")
    n = docs.count()
    hot = spark.range(n // 2).select((-F.col("id") - 1).alias("doc_id"), F.lit("the same text again").alias("text"))
    rows = sharding.assign(docs.union(hot), 8, rows_per_bundle).toPandas()
    truth = docs.union(hot).toPandas()
    assert sorted(rows["doc_id"]) == sorted(truth["doc_id"])
    by = rows.set_index("doc_id").loc[truth["doc_id"]]
    assert by["size"].tolist() == [len(t.encode()) + 16 for t in truth["text"]]
    assert by["text_crc32"].tolist() == [zlib.crc32(t.encode()) for t in truth["text"]]
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    load = rows.groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() / load.mean() < 1.02

