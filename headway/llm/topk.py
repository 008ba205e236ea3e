"""Exact top-k inner-product search with MaxScore over sharded postings.

A vector's component d is a posting of term d with weight floor(64 * x).  The
candidates are dealt into shards by id; every shard holds one posting list per
dimension (positions and weights, or a dense column where most are set).  The
query set is cut into blocks and every block meets every shard.  Per query and
shard, terms are ordered by their score bound; the trailing terms whose bounds
sum to less than the k-th score known so far are non-essential.  Essential
postings are traversed for all candidates; the others are probed term by term
only for candidates still able to reach the threshold.  A shard returns at most
k rows a query; a window merges the shards.

Defined results: vectors that are null or hold a null or non-finite component
take no part; missing trailing components count as zero, so an empty vector
scores zero; every row is a candidate, also rows with equal ids or vectors,
except rows with the query's own id; several queries with one id and different
vectors are ranked apart; weights are exact below 2**53; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .store import ship

SHARD_ROWS = 8192
BLOCK_QUERIES = 512
PROBE = 4        # terms traversed or probed between two tests of the threshold


class Postings:
    """Posting lists of one shard."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.lists: list[tuple[np.ndarray | None, np.ndarray]] = []
        for column in weights.T:
            at = np.flatnonzero(column)
            self.lists.append((at, column[at]) if 2 * len(at) < self.n else (None, np.ascontiguousarray(column)))
        self.rows = weights
        self.high = weights.max(axis=0, initial=0)
        self.low = weights.min(axis=0, initial=0)

    def traverse(self, term: int, weight: float, score: np.ndarray) -> None:
        at, values = self.lists[term]
        if at is None:
            score += weight * values
        else:
            score[at] += weight * values

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates, ties to smaller ids."""
        bound = np.maximum(query * self.high[:len(query)], query * self.low[:len(query)])
        terms = np.argsort(-bound, kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)    # what the terms from here on can add
        score = np.zeros(self.n)
        score[self.ids == own] = -np.inf
        floor, done = -np.inf, 0
        while done < len(terms) and rest[done] >= floor:            # essential terms
            for t in terms[done:done + PROBE]:
                self.traverse(t, query[t], score)
            done = min(done + PROBE, len(terms))
            if floor == -np.inf and 4 * done >= len(terms) and self.n > 4 * k:
                seeds = np.argpartition(-score, 2 * k)[:2 * k]
                seeds = seeds[score[seeds] > -np.inf]
                if len(seeds) >= k:
                    floor = np.sort(self.rows[seeds, :len(query)] @ query)[-k]
        alive = np.flatnonzero((score > -np.inf) & (score + rest[done] >= floor))
        score = score[alive]
        while done < len(terms) and len(alive):                     # non-essential terms
            some = terms[done:done + PROBE]
            score += self.rows[np.ix_(alive, some)] @ query[some]
            done += len(some)
            keep = score + rest[min(done, len(terms))] >= floor
            alive, score = alive[keep], score[keep]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][best], score[best]


def _unpack(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, dim) if dim else np.zeros((0, 0))


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: ids and the weights of its vectors, padded to one width."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = max(1, int(pdf["weights"].str.len().max()))
        out = np.zeros((len(pdf), dim))
        for i, w in enumerate(pdf["weights"]):
            out[i, :len(w)] = w
        return pd.DataFrame({key: [pdf[key].iloc[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "twins": [pdf["twin"].to_numpy(np.int64).tobytes()], "dim": [dim], "data": [out.tobytes()]})
    return rows.groupBy(key).applyInPandas(pack, f"{key} long, ids binary, twins binary, dim int, data binary")


def search(vectors: DataFrame, k: int = 20, every: int = 20, shard_rows: int = SHARD_ROWS,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double")).alias("weights"))
    rows = rows.withColumn("twin", F.xxhash64("weights"))
    n = rows.count()
    n_shards = max(1, -(-n // shard_rows))
    # rows of one id spread as well: the number within the partition is part of the key
    shards = _packed(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_shards)).cast("long")), "shard")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "twin"])
    n_blocks = max(1, -(-(n // every) // block_queries))
    blocks = _packed(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "twin"), F.lit(n_blocks))), "block")
    pairs = (blocks.select("block", F.col("ids").alias("q_ids"), F.col("twins").alias("q_twins"), F.col("dim").alias("q_dim"),
                           F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"))
             .join(shards.drop("twins"), "shard"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, postings = None, None
        for pdf in frames:
            for r in pdf.itertuples():
                if last != r.shard:
                    last, postings = r.shard, Postings(np.frombuffer(r.ids, np.int64), _unpack(r.data, r.dim))
                out: list[pd.DataFrame] = []
                queries = _unpack(r.q_data, r.q_dim)
                for own, twin, q in zip(np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_twins, np.int64), queries):
                    ids, scores = postings.top(q[:r.dim], own, k)
                    out.append(pd.DataFrame({"query_id": own, "twin": twin, "vec_id": ids, "score": scores.astype(np.int64)}))
                yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "twin": [], "vec_id": [], "score": []})

    found = pairs.repartition(F.col("shard"), F.col("block")).mapInPandas(
        score, "query_id long, twin long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
