"""Sharding by vector bin packing over bytes, tokens and rows.

Rows with equal texts form a group.  A group beyond 1/64 of a shard in bytes,
tokens or rows is an item of its own; only beyond a quarter of a shard is it
cut into pieces of about that size.  Smaller groups are bundled by their hash
into coarse and fine bundles, so the packer sees a number of items that depends
on the shard count and grows only by one bundle per million rows.  Items go, largest
first, to the shard whose residual capacity vector has the highest dot product
with the item.  An item of more than ``ROWS_PER_BUNDLE`` rows is numbered in
runs of about that many rows, drawn by a hash of the row, whose offsets follow
from their counts; no task sorts more.  Nothing of the size of the corpus
reaches the driver: it sees the totals, the groups beyond a 1/64 share (at most
3 * 64 * shards) and one row per run.

Defined results: null texts have size 16, no tokens and the checksum of the
empty text; all null and empty texts are one group; repeated rows are kept as
rows of their group; ids may be null or repeat; an empty table gives no rows;
further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .store import write_table

TOKEN = r"[^\x20\x09-\x0D]+"
PARTS_PER_SHARD = 64          # a group beyond this share of a shard is an item of its own
WHOLE_PARTS = 16              # of which a group may have so many before it is cut
BUNDLES_PER_SHARD = 32        # coarse bundles and as many fine ones
ROWS_PER_BUNDLE = 1_000_000   # more bundles, and more runs of an item, once they would hold more rows than this
DIMENSIONS = ("size", "n_tokens", "n_rows")
WEIGHTS = (8.0, 1.0, 1.0)     # of the dimensions in the dot product; the law is on bytes


def sizes(docs: DataFrame) -> DataFrame:
    """One row per document: id, size, tokens, checksum and the two halves of its group key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("n_tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(text, F.lit(11)).alias("g2"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def pack(items: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item (rows of ``items``: its sizes in every dimension)."""
    total = np.maximum(items.sum(axis=0), 1)
    share = items / total
    capacity = np.full((n_shards, items.shape[1]), 1.0 / n_shards)
    out = np.zeros(len(items), np.int32)
    for i in np.lexsort((np.arange(len(items)), -share.max(axis=1))):
        out[i] = np.argmax(capacity @ (share[i] * WEIGHTS))
        capacity[out[i]] -= share[i]
    return out


def assign(docs: DataFrame, n_shards: int = 40, rows_per_bundle: int = ROWS_PER_BUNDLE) -> DataFrame:
    """``doc_id, size, n_tokens, text_crc32, shard, slot`` for every row."""
    spark = docs.sparkSession
    rows = write_table(sizes(docs), "shard-sizes")
    groups = rows.groupBy("g1", "g2").agg(
        F.sum("size").alias("size"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows"))
    total = rows.agg(F.sum("size"), F.sum("n_tokens"), F.count("*")).first()
    limit = [max(1.0, (t or 0) / (n_shards * PARTS_PER_SHARD)) for t in total]
    share = F.greatest(*[F.col(c) / F.lit(m) for c, m in zip(DIMENSIONS, limit)])
    # at most 3 * 64 * n_shards groups can exceed a 64th of a shard in one of three dimensions
    large = groups.where(share > 1).select("g1", "g2", "n_rows", F.ceil(share / WHOLE_PARTS).cast("int").alias("n_pieces")).toPandas()
    large = large.sort_values(["g1", "g2"], ignore_index=True)
    per_shard = max(BUNDLES_PER_SHARD, (total[2] or 0) // (n_shards * rows_per_bundle))
    n_bundles = int(n_shards * per_shard)
    large["base"] = 2 * n_bundles + large["n_pieces"].cumsum() - large["n_pieces"]
    large["n_runs"] = -(-large["n_rows"] // (large["n_pieces"] * rows_per_bundle))
    large = large[["g1", "g2", "n_pieces", "base", "n_runs"]].astype({"g1": "int64", "g2": "int64", "n_pieces": "int32", "base": "int64", "n_runs": "int32"})
    large = spark.createDataFrame(large, "g1 long, g2 long, n_pieces int, base long, n_runs int")

    bundle = F.pmod(F.shiftrightunsigned("g2", 8), F.lit(n_bundles))
    fine = F.pmod("g2", F.lit(10)) == 0        # a tenth of the groups levels the shards at the end
    unit = F.when(F.col("n_pieces").isNotNull(),
                  F.col("base") + F.pmod(F.xxhash64("row_no"), F.col("n_pieces"))
                  ).otherwise(bundle + F.when(fine, F.lit(n_bundles)).otherwise(F.lit(0)))
    run = F.coalesce(F.pmod(F.xxhash64("row_no", F.lit(7)), F.col("n_runs")), F.lit(0))
    placed = rows.join(F.broadcast(large), ["g1", "g2"], "left").withColumn("unit", unit.cast("long")).withColumn("run", run.cast("int"))
    runs = placed.groupBy("unit", "run").agg(
        F.sum("size").alias("size"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows")
    ).toPandas().sort_values(["unit", "run"], ignore_index=True)
    items = runs.groupby("unit", as_index=False)[list(DIMENSIONS)].sum()
    items["shard"] = pack(items[list(DIMENSIONS)].to_numpy(float).reshape(-1, 3), n_shards)
    runs = runs.merge(items[["unit", "shard"]], on="unit")
    runs["first_slot"] = runs.groupby("shard")["n_rows"].cumsum() - runs["n_rows"] if len(runs) else []
    plan = spark.createDataFrame(
        runs[["unit", "run", "shard", "first_slot"]].astype({"unit": "int64", "run": "int32", "shard": "int32", "first_slot": "int64"}),
        "unit long, run int, shard int, first_slot long")
    in_run = F.row_number().over(Window.partitionBy("unit", "run").orderBy("g1", "g2", "doc_id", "row_no"))
    return placed.join(F.broadcast(plan), ["unit", "run"]).select(
        "doc_id", "size", "n_tokens", "text_crc32", "shard",
        (F.col("first_slot") + in_run - 1).cast("long").alias("slot"))


def digest(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The columns of ``op7``; the law is ``bytes``."""
    return assign(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "n_tokens")
