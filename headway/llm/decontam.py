"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is a set of 5-word shingles, far smaller than a long document, so
the resemblance of the two sets says nothing; what counts is the share of the
item's shingles that the document holds.  Items are partitioned by size (powers
of two).  An item's sketch is its bottom-k MinHash sample, k fixed per
partition as a fifth of the partition's greatest size and ``HITS`` more.  An item
contained to 80 % lacks at most a fifth of its shingles, so its sketch must hit
k less that many times: no contained item can be missed, at any size.
Candidates are verified by their exact containment.

Items of up to ``BLOCK_BYTES`` of text are one index, which is broadcast, and
documents are read once.  Beyond that documents are read three times, however
many items there are: the sketches are a table, and documents send their
distinct shingles to it by a join on the shingle, whose items' side is repeated
``SALTS`` times so that a shingle of very many documents spreads; pairs with
enough hits are counted before the candidates' texts are read for verification.
Equal texts are one document there, and one item, until the end.

Defined results: null and empty texts hold and are nothing; a text of one to
four words is one shingle, so such an item is found in documents of just these
words; repeated rows and equal items are all reported; a null id is reported
as null; an empty table gives no rows; further columns are kept by ``clean``
and ignored by ``search``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text
from .packing import slices
from .store import drop_table, ship, write_table

WORDS, PERCENT = 5, 80
HITS = 4                        # sketch hits that an item contained to 80 % has at least, if it is large enough
BLOCK_BYTES = 16 << 20
ROW_BYTES = 64                  # an item's share of a block beside its text
SALTS = 8
_BITS = 22                      # size of the membership table before the binary search


def sketch_size(size: int) -> int:
    """Bottom-k sample of an item of ``size`` shingles: the same for all of its partition, but never more than it has."""
    greatest = 1 << (size - 1).bit_length() if size else 0
    return min(size, greatest * (100 - PERCENT) // 100 + HITS)


def least_hits(size: int) -> int:
    """Sketch hits of an item of which at least 80 % of the shingles are present: all but those that may be absent."""
    return max(1, sketch_size(size) - size * (100 - PERCENT) // 100)


@dataclass
class Index:
    """Items of one block: shingles of each (ascending), the sketches as ascending (hash, item) postings."""
    shingles: np.ndarray
    offsets: np.ndarray
    ids: list
    hashes: np.ndarray
    items: np.ndarray
    least: np.ndarray

    @classmethod
    def build(cls, ids: list, texts: list) -> "Index":
        column = pa.array(texts, pa.string())
        found, at = text.shingle_hashes(*text.word_hashes(column, text.PLAIN), WORDS)
        sets = [np.unique(found[a:b]) for a, b in zip(at[:-1], at[1:])]
        size = np.array([len(s) for s in sets], np.int64)
        k = [sketch_size(n) for n in size.tolist()]
        hashes = np.concatenate([s[:m] for s, m in zip(sets, k)] or [np.zeros(0, np.uint64)])   # bottom-k: ascending hashes
        items = np.repeat(np.arange(len(sets)), k)
        order = np.argsort(hashes, kind="stable")
        return cls(np.concatenate(sets or [np.zeros(0, np.uint64)]), np.append(0, np.cumsum(size)), ids, hashes[order], items[order],
                   np.array([least_hits(n) for n in size.tolist()], np.int64))

    def table(self) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        return out

    def find(self, column: pa.Array, table: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``row, item, shared shingles`` of every item contained to at least 80 %."""
        found, offsets = text.shingle_hashes(*text.word_hashes(column, text.PLAIN), WORDS)
        at = np.flatnonzero(table[(found >> np.uint64(64 - _BITS)).astype(np.int64)])
        first, last = (np.searchsorted(self.hashes, found[at], side) for side in ("left", "right"))
        at, first, last = (x[last > first] for x in (at, first, last))
        if not len(at):
            return
        rows = np.searchsorted(offsets, at, side="right") - 1
        n = last - first
        posting = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hits = np.unique(np.stack([np.repeat(rows, n), self.items[posting], posting]), axis=1)    # a sketch hash counts once
        pairs, counts = np.unique(hits[:2], axis=1, return_counts=True)
        last_row, held = -1, None
        for row, item in pairs[:, counts >= self.least[pairs[1]]].T:
            if row != last_row:
                last_row, held = row, np.unique(found[offsets[row]:offsets[row + 1]])
            own = self.shingles[self.offsets[item]:self.offsets[item + 1]]
            shared = len(own) - len(np.setdiff1d(own, held, assume_unique=True))
            if 100 * shared >= PERCENT * len(own):
                yield int(row), int(item), int(shared)


def _index(benchmark: DataFrame) -> Index | None:
    """Index of all items, or None where they exceed ``BLOCK_BYTES``."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    if total > BLOCK_BYTES:
        return None
    rows = items.orderBy("item_id", "text").collect()
    return Index.build([r["item_id"] for r in rows], [r["text"] for r in rows])


def _keys(prefix: str, column: Column) -> list[Column]:
    """128 bits of a text that stand for it."""
    return [F.xxhash64(column).alias(f"{prefix}1"), F.xxhash64(column, F.lit(11)).alias(f"{prefix}2")]


def _shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text.shingle_hashes(*text.word_hashes(column, text.PLAIN), WORDS)


def _document_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found, at = _shingles(part["text"])
            row = np.repeat(np.arange(part.num_rows), np.diff(at))
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            new = np.append(True, (row[1:] != row[:-1]) | (found[1:] != found[:-1]))[:len(row)]
            row, found = pa.array(row[new]), found[new].view(np.int64)
            yield pa.RecordBatch.from_arrays([part["d1"].take(row), part["d2"].take(row), pa.array(found)], names=["d1", "d2", "h"])


def _item_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found, at = _shingles(part["text"])
            sets = [np.unique(found[a:b]) for a, b in zip(at[:-1], at[1:])]
            sketches = [s[:sketch_size(len(s))] for s in sets]
            row = np.repeat(np.arange(part.num_rows), [len(s) for s in sketches])
            least = np.array([least_hits(len(s)) for s in sets], np.int64)
            hashes = np.concatenate(sketches).view(np.int64)
            yield pa.RecordBatch.from_arrays([part["i1"].take(pa.array(row)), part["i2"].take(pa.array(row)), pa.array(least[row]), pa.array(hashes)],
                                             names=["i1", "i2", "least", "h"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose containment is at least 80 %, with both counts."""
    for batch in batches:
        for part in slices(batch, "text"):
            (docs, at), (items, start) = _shingles(part["text"]), _shingles(part["item"])
            n, shared = np.zeros((2, part.num_rows), np.int64)
            for i in range(part.num_rows):
                own = np.unique(items[start[i]:start[i + 1]])
                n[i], shared[i] = len(own), np.isin(own, docs[at[i]:at[i + 1]]).sum()
            out = pa.RecordBatch.from_arrays([*(part[c] for c in ("d1", "d2", "i1", "i2")), pa.array(n), pa.array(shared)],
                                             names=["d1", "d2", "i1", "i2", "n", "shared"])
            yield out.filter(pa.array(100 * shared >= PERCENT * n))


def _joined(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``d1, d2, i1, i2, n, shared`` of every contained item, one row per pair of different texts."""
    texts = docs.where(F.col("text").isNotNull()).select("text", *_keys("d", F.col("text")))
    items = benchmark.where(F.col("text").isNotNull()).select("text", *_keys("i", F.col("text"))).dropDuplicates(["i1", "i2"])
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sketches = items.mapInArrow(_item_sketches, "i1 long, i2 long, least long, h long").withColumn("salt", salts)
    different = texts.dropDuplicates(["d1", "d2"])
    shingles = different.mapInArrow(_document_shingles, "d1 long, d2 long, h long").withColumn("salt", F.pmod("d2", F.lit(SALTS)).cast("int"))
    hits = shingles.join(sketches, ["h", "salt"])
    counts = hits.groupBy("d1", "d2", "i1", "i2").agg(F.count("*").alias("hits"), F.first("least").alias("least"))
    likely = write_table(counts.where("hits >= least").select("d1", "d2", "i1", "i2"), "decontam-candidates")
    read = texts.join(likely.select("d1", "d2").distinct(), ["d1", "d2"], "left_semi").dropDuplicates(["d1", "d2"])
    pairs = likely.join(read, ["d1", "d2"]).join(items.withColumnRenamed("text", "item"), ["i1", "i2"])
    found = write_table(pairs.select("d1", "d2", "i1", "i2", "text", "item").mapInArrow(
        _verified, "d1 long, d2 long, i1 long, i2 long, n long, shared long"), "decontam-found")
    drop_table(likely)
    return found


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment`` of every contained item."""
    spark = docs.sparkSession
    ship(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_shingles", pa.int64()),
                        ("n_shared", pa.int64()), ("containment", pa.float64())])
    index = _index(benchmark)
    if index is None:
        found = _joined(docs, benchmark)
        held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_keys("d", F.col("text"))).join(found, ["d1", "d2"])
        items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), *_keys("i", F.col("text")))
        return held.join(items, ["i1", "i2"]).select(
            "doc_id", "item_id", F.col("n").alias("n_item_shingles"), F.col("shared").alias("n_shared"), (F.col("shared") / F.col("n")).alias("containment"))
    shared_index = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared_index.value
        table = index.table()
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part["doc_id"]
                out = [(ids[row].as_py(), index.ids[item], int(index.offsets[item + 1] - index.offsets[item]), shared)
                       for row, item, shared in index.find(part["text"], table)]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, (*o, o[3] / o[2]))) for o in out], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item."""
    ship(docs.sparkSession)
    index = _index(benchmark)
    if index is None:
        gone = _joined(docs, benchmark).select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2")).distinct()
        first, second = _keys("d", docs["text"])
        return docs.join(gone, (first == gone["_d1"]) & (second == gone["_d2"]), "left_anti")
    shared_index = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared_index.value
        table = index.table()
        for batch in batches:
            for part in slices(batch, "text"):
                keep = np.ones(part.num_rows, bool)
                keep[[row for row, _, _ in index.find(part["text"], table)]] = False
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


ORACLE_SQL = """
WITH w AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
s AS (
  SELECT kind, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws FROM w),
e AS (
  SELECT kind, r, id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM s),
i AS (SELECT r, id, len(sh) AS n, unnest(sh) AS t FROM e WHERE kind = 'b'),
d AS (SELECT r, id, unnest(sh) AS t FROM e WHERE kind = 'd'),
p AS (SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n) AS n, count(*) AS c FROM d JOIN i USING (t) GROUP BY d.r, d.id, i.r, i.id)
SELECT doc_id, item_id, n::BIGINT AS n_item_shingles, c::BIGINT AS n_shared, c::DOUBLE / n AS containment
FROM p WHERE 100 * c >= 80 * n
"""
