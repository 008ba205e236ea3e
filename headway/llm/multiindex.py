"""Approximate nearest neighbours by largest cosine with an inverted multi-index.

Equal vectors are grouped first: an entry is a distinct vector with the k + 1
smallest ids of its rows, which is all that any answer can need, so a vector
that a third of all rows hold is one entry.  Entries are scaled to length one
and their two halves quantised separately: a codebook per half, fitted on a
sample, gives every entry a centroid pair.

A query walks the centroid pairs by summed distance with a heap until their
cells hold a share of all entries.  That share is measured when the index is
fitted: entries of the sample search the sample by brute force, and the share
is the one that holds ``RECALL`` of their true neighbours.  (Vectors without any
structure need a large share, clustered ones little.)  What a query takes along
is its vector and the summed distance of the last pair; shelves, which are blocks of
entries with neighbouring first centroids, meet the queries that reach them and
rerank the entries of the visited cells.  A shelf is sent once for each
``TILE_BYTES`` of its queries, a query once to each shelf that it reaches.  The
reranked cosine is exact (correctly rounded sums), and a window merges the shelves.

An index of fewer entries than ``WHOLE`` is walked to its end, so the result is
exact there.

Bounds: the codebooks and the number of entries by pair (at most 128 x 128)
travel with the tasks; a first centroid with more than ``BLOCK_ROWS`` entries
is dealt over several blocks; a block holds at most about ``BLOCK_BYTES``, a
shelf at most ``SHELF_BLOCKS`` of them.

Defined results: vectors that are null, zero, or hold a null or non-finite
component, and rows without an id, take no part; missing trailing components
count as zero; every row is a candidate, also rows with equal ids or vectors,
except the query's own row; repeated query rows are answered each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .store import drop_table, ship, shuffle_partitions, write_table

SAMPLE = 20_000            # entries that fit the codebooks, at most
CENTROIDS = 128            # of a half, at most
PER_CELL = 8               # entries a cell while there are fewer centroids than that
ROUNDS = 8                 # of the fit
TRIALS = 400               # sample entries that measure the share to be visited
RECALL = 0.97
WHOLE = 1000
BLOCK_ROWS, BLOCK_BYTES = 16_384, 8 << 20
SHELVES, SHELF_BLOCKS = 48, 8      # blocks stand alone up to that many
TILE_BYTES = 64 << 20
PACK_QUERIES = 512
SALTS = 8
MARGIN = 1e-9              # of a cosine in floating point


def matrix(column, dim: int) -> np.ndarray:
    """Vectors as rows, padded to one width."""
    column = list(column)
    if column and all(len(w) == dim for w in column):
        return np.stack(column).astype(np.float64)
    out = np.zeros((len(column), dim))
    for i, w in enumerate(column):
        out[i, :len(w)] = w
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two (exact) so that the largest component lies between a half and one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two scaled vectors; the sums are correctly rounded, so their order doesn't matter."""
    return math.fsum((a * b).tolist()) / (math.sqrt(math.fsum((a * a).tolist())) * math.sqrt(math.fsum((b * b).tolist())))


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, each summed on its own: equal for a row wherever it is computed."""
    out = np.empty((len(rows), len(centroids)))
    for at in range(0, len(rows), 256):
        out[at:at + 256] = ((rows[at:at + 256, None, :] - centroids[None]) ** 2).sum(axis=2)
    return out


def codebook(rows: np.ndarray, size: int) -> np.ndarray:
    """Lloyd's algorithm from evenly spread distinct rows."""
    distinct = np.unique(rows, axis=0)
    centroids = distinct[np.linspace(0, len(distinct) - 1, min(size, len(distinct))).astype(int)].copy()
    for _ in range(ROUNDS):
        code = _nearest(rows, centroids)
        count = np.bincount(code, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, code, rows)
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return centroids


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), dtype=np.int64)
    offset = (centroids * centroids).sum(axis=1)
    for at in range(0, len(rows), 4096):
        out[at:at + 4096] = (offset - 2 * rows[at:at + 4096] @ centroids.T).argmin(axis=1)
    return out


def walk(near: np.ndarray, far: np.ndarray, counts: np.ndarray, want: float) -> float:
    """Pops centroid pairs by summed distance until their cells hold ``want`` entries: the last sum."""
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    first, second = near[a].tolist(), far[b].tolist()
    held = counts[np.ix_(a, b)].tolist()
    heap = [(first[0] + second[0], 0, 0)]
    got, last = 0, -math.inf
    while heap and got < want:
        last, i, j = heapq.heappop(heap)
        got += held[i][j]
        if j + 1 < len(second):
            heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))
    return last


@dataclass
class Index:
    """Codebooks of the halves and the share of all entries that a query visits."""

    dim: int
    first: np.ndarray
    second: np.ndarray
    share: float

    @classmethod
    def fitted(cls, vectors: np.ndarray, n: int, k: int) -> "Index":
        rows = unit(vectors)
        half = rows.shape[1] // 2
        size = int(min(CENTROIDS, max(1, round(math.sqrt(n / PER_CELL)))))
        index = cls(rows.shape[1], codebook(rows[:, :half], size), codebook(rows[:, half:], size), 1.0)
        index.share = index.measured_share(rows, k)
        return index

    def measured_share(self, rows: np.ndarray, k: int) -> float:
        """Share of the sample in and before the cell of a true neighbour, at the quantile ``RECALL``."""
        if len(rows) <= k + 1:
            return 1.0
        i, j = self.codes(rows)
        asked = rows[np.linspace(0, len(rows) - 1, min(TRIALS, len(rows))).astype(int)]
        near, far = self.halves(asked)
        shares = []
        for q, a, b in zip(asked, near, far):
            closest = np.argpartition(-(rows @ q), k)[:k + 1]          # itself among them
            total = a[i] + b[j]
            shares.extend((total <= t).mean() for t in total[closest])
        return float(np.quantile(shares, RECALL))

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.dim // 2
        return distances(rows[:, :half], self.first), distances(rows[:, half:], self.second)

    def codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.dim // 2
        return _nearest(rows[:, :half], self.first), _nearest(rows[:, half:], self.second)


class Shelf:
    """Entries of some first centroids, sorted by centroid pair; the list of a first centroid is cut into pieces."""

    def __init__(self, index: Index, table: pa.Table, piece: int):
        code = table["i"].to_numpy(), table["j"].to_numpy()
        self.order = np.lexsort(code[::-1])
        self.i, self.j = (x[self.order] for x in code)
        self.vectors = _dense(table["embedding"], index.dim)
        self.rows = unit(self.vectors[self.order].astype(np.float64))
        self.keys = np.stack([table["a"].to_numpy(), table["b"].to_numpy()], axis=1)
        self.ids, lengths = _flat(table["ids"])
        self.ends = np.cumsum(lengths)
        starts = np.flatnonzero(np.diff(self.i, prepend=-1))
        self.own = self.i[starts]
        self.lists = [(at, min(at + piece, hi)) for lo, hi in zip(starts, [*starts[1:], len(self.i)]) for at in range(lo, hi, piece)]

    def top(self, index: Index, queries: np.ndarray, keys: np.ndarray, stop: np.ndarray, k: int) -> Iterator[tuple]:
        """``a, b, score, vec_id, same`` of each query's k + 1 best rows in the visited cells."""
        exact, rows = scaled(queries), unit(queries)
        half = index.dim // 2
        near, far = distances(rows[:, :half], index.first[self.own]), distances(rows[:, half:], index.second)
        closest = far.min(axis=1)
        floor = np.full(len(rows), -np.inf)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in self.lists:
            i = np.searchsorted(self.own, self.i[lo])
            active = np.flatnonzero(near[:, i] + closest <= stop)
            if not len(active):
                continue
            sims = rows[active] @ self.rows[lo:hi].T
            # only a row with more than k entries from its floor on can raise it
            rising = np.flatnonzero(np.count_nonzero(sims >= floor[active, None], axis=1) > k)
            if len(rising):
                q, visited = active[rising], sims[rising]
                visited[near[q, i][:, None] + far[np.ix_(q, self.j[lo:hi])] > stop[q, None]] = -np.inf
                floor[q] = np.maximum(floor[q], np.partition(visited, -(k + 1), axis=1)[:, -(k + 1)])
            q, e = np.divmod(np.flatnonzero(sims >= floor[active, None] - MARGIN), hi - lo)
            s, q = sims[q, e], active[q]
            seen = near[q, i] + far[q, self.j[lo + e]] <= stop[q]
            found.append((q[seen], lo + e[seen], s[seen]))
        if not found:
            return
        q, e, s = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-s, q))
        q, e, s = q[order], self.order[e[order]], s[order]
        lo, hi = _runs(q)
        floor[q[lo]] = np.where(hi - lo > k, s[np.minimum(lo + k, hi - 1)], -np.inf)
        keep = s >= floor[q] - MARGIN
        q, e = q[keep], e[keep]
        scores = np.concatenate([self.scores(exact[q[at:at + 4096]], e[at:at + 4096]) for at in range(0, len(q), 4096)]) if len(q) else np.zeros(0)
        same = (self.keys[e] == keys[q]).all(axis=1).tolist()
        for lo, hi in zip(*_runs(q)):
            a, b = keys[q[lo]].tolist()
            best = []
            for at, score, own in zip(e[lo:hi].tolist(), scores[lo:hi].tolist(), same[lo:hi]):
                begin = self.ends[at - 1] if at else 0
                best.extend((-score, x, own) for x in self.ids[begin:self.ends[at]].tolist())
            for score, x, own in heapq.nsmallest(k + 1, best):
                yield a, b, -score, x, own

    def scores(self, queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """``cosine`` of each of the scaled queries and its entry."""
        return np.array([cosine(a, b) for a, b in zip(queries, scaled(self.vectors[entries].astype(np.float64)))])


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and the lists' lengths."""
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False)


def _dense(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors as rows, padded to one width, in the column's own precision."""
    values, lengths = _flat(column)
    if not np.issubdtype(values.dtype, np.floating):
        values = values.astype(np.float64)
    if (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), values.dtype)
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.diff(values, prepend=values[0] - 1)) if len(values) else np.zeros(0, dtype=int)
    return starts, np.append(starts[1:], len(values)) if len(starts) else starts


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """``a, b, embedding, ids``: distinct vectors with the k + 1 smallest ids."""
    first = F.row_number().over(Window.partitionBy("a", "b").orderBy("vec_id"))
    return (rows.withColumn("pos", first).where(F.col("pos") <= k + 1)
            .groupBy("a", "b").agg(F.first("embedding").alias("embedding"), F.sort_array(F.collect_list("vec_id")).alias("ids")))


def _sample(entries: DataFrame, n: int, size: int) -> pd.DataFrame:
    """The ``size`` entries of the smallest hashes.

    The driver merges what the tasks return, each its smallest ``size``: entries beyond the hash that
    some more than ``size`` are expected below go first.
    """
    share = 1.1 * size / n
    while True:
        below = entries if share >= 1 else entries.where(F.col("a") < F.lit(int(share * 2.0 ** 64) - 2 ** 63))
        sample = below.orderBy("a", "b").limit(size).select("embedding").toPandas()
        if share >= 1 or len(sample) == size:
            return sample
        share *= 2


def _block_plan(held: np.ndarray, block_rows: int) -> tuple[list[int], list[int]]:
    """First block and number of blocks of every first centroid: small ones share a block, large ones are split."""
    first, parts, block, room = [], [], -1, 0
    for n in held:
        if n > block_rows:
            split = -(-int(n) // block_rows)
            first.append(block + 1)
            parts.append(split)
            block, room = block + split, 0
            continue
        if block < 0 or n > room:
            block, room = block + 1, block_rows
        first.append(block)
        parts.append(1)
        room -= int(n)
    return first, parts


def search(vectors: DataFrame, k: int = 5, every: int = 50, block_rows: int = BLOCK_ROWS, pack_queries: int = PACK_QUERIES,
           share: float | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id is divisible by ``every``.

    ``share`` sets the share of the entries that a query visits by hand.
    """
    spark = vectors.sparkSession
    ship(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole & F.exists("embedding", lambda x: x != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding",
        F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit(1), "embedding").alias("b"))
    asked = rows.where(F.col("vec_id") % every == 0)
    entries = write_table(_entries(rows, k), "multi-index-entries")
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    n, dim = size["n"], size["dim"]
    if not n:
        return spark.createDataFrame([], schema)
    sample = _sample(entries, n, max(k + 2, min(SAMPLE, 32 * BLOCK_BYTES // (8 * dim))))
    index = Index.fitted(matrix(sample["embedding"], dim), n, k)
    want = max(WHOLE, (index.share if share is None else share) * n)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            i, j = index.codes(unit(matrix(pdf["embedding"], dim)))
            yield pdf.assign(i=i, j=j)

    kind = entries.schema["embedding"].dataType.simpleString()
    coded = write_table(entries.mapInPandas(assign, f"a long, b long, embedding {kind}, ids array<long>, i long, j long"), "multi-index-coded")
    drop_table(entries)
    counts = np.zeros((len(index.first), len(index.second)), dtype=np.int64)
    for r in coded.groupBy("i", "j").count().collect():                      # a row per centroid pair
        counts[r["i"], r["j"]] = r["count"]
    piece = max(1, min(block_rows, BLOCK_BYTES // (8 * dim)))
    first, parts = _block_plan(counts.sum(axis=1), piece)
    shelf_blocks = min(SHELF_BLOCKS, -(-(first[-1] + parts[-1]) // SHELVES))
    at = F.col("i").cast("int") + 1
    block = F.element_at(F.array(*map(F.lit, first)), at) + F.pmod(F.col("a"), F.element_at(F.array(*map(F.lit, parts)), at))

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            near, far = index.halves(unit(matrix(pdf["embedding"], dim)))
            stop = [walk(a, b, counts, want) for a, b in zip(near, far)]
            reach = near + far.min(axis=1)[:, None] <= np.array(stop)[:, None]
            seen = [sorted({(first[i] + p) // shelf_blocks for i in np.flatnonzero(row) for p in range(parts[i])}) for row in reach]
            yield pdf.assign(stop=stop, shelves=seen)

    # few bytes but much work a row: spread over as many tasks as a shuffle has (by a key of its own, or the distinct rows stay where they are)
    questions = write_table(
        asked.dropDuplicates(["a", "b"]).select("a", "b", "embedding").repartition(shuffle_partitions(spark), F.xxhash64("b", "a")).mapInPandas(
            visit, f"a long, b long, embedding {kind}, stop double, shelves array<long>"), "multi-index-questions")
    most = questions.select(F.explode("shelves").alias("shelf")).groupBy("shelf").count().agg(F.max("count").alias("most")).first()["most"] or 0
    tiles = max(1, -(-most * 8 * dim // TILE_BYTES))

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64()), ("same", pa.bool_())])

    def rerank(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[list] = [[] for _ in out]
        if len(entries) and len(queries):
            shelf = Shelf(index, entries, piece)
            vectors, stop = _dense(queries["embedding"], dim), queries["stop"].to_numpy()
            keys = np.stack([queries["a"].to_numpy(), queries["b"].to_numpy()], axis=1)
            for at in range(0, len(stop), pack_queries):
                pack = slice(at, at + pack_queries)
                rows = shelf.top(index, vectors[pack].astype(np.float64), keys[pack], stop[pack], k)
                for column, type_, values in zip(found, out.types, zip(*rows)):
                    column.append(pa.array(values, type_))
        return pa.table([pa.chunked_array(x, type_) for x, type_ in zip(found, out.types)], schema=out)

    shelves = coded.select(F.floor(block / shelf_blocks).cast("long").alias("shelf"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"),
                           "i", "j", "a", "b", "embedding", "ids")
    callers = questions.select(F.explode("shelves").alias("shelf"), F.pmod(F.xxhash64("b"), F.lit(tiles)).cast("int").alias("tile"),
                               "a", "b", "embedding", "stop")
    found = shelves.groupBy("shelf", "tile").cogroup(callers.groupBy("shelf", "tile")).applyInArrow(
        rerank, "a long, b long, score double, vec_id long, same boolean")
    best = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id"))
    top = (found.withColumn("pos", best).where(F.col("pos") <= k + 1)
           .groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id", "same"))).alias("top")))
    # a vector may be asked for by many rows: its list goes to each of a few salts
    salted = top.withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])))
    own = F.array_position(F.transform("top", lambda t: t["same"] & (t["vec_id"] == F.col("query_id"))), True) - 1
    others = F.filter("top", lambda t, at: at != F.col("own"))
    ranked = (asked.select(F.col("vec_id").alias("query_id"), "a", "b", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"))
              .join(salted, ["a", "b", "salt"]).withColumn("own", own)
              .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "t")))
    result = write_table(ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"),
                                       (-F.col("t.less")).alias("score")), "multi-index-found")
    drop_table(coded)
    drop_table(questions)
    return result
