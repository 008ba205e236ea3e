"""N-gram language model over sharded Elias-Fano tries, trained and queried in Spark.

Tokens are the words of a text and one end.  The model interpolates with
absolute discounting: trigram over bigram over the add-0.1 unigram; the first
token of a text has no context.  No part of the model is held whole by any task:

1.  Chunks of documents send their distinct word hashes with training counts
    to the shards of the vocabulary; a shard keeps counts and gives ids, the
    more frequent the smaller.
2.  Chunks ask the shards for the ids and counts of their words.  A chunk then
    knows the base score of its documents and sends their n-grams, sorted and
    packed, to the shard of the middle word v of (u, v, w).  A middle word with
    more than ``CELL`` occurrences is split into cells by the hash of u, so no
    shard grows with a frequent word.  Only trigrams are split: the distinct
    (v, w) of split words are counted over all cells in shards of their own,
    which send the totals, and the sums and kinds per v, to the cells.
3.  A shard counts its training n-grams and builds a trie: (v, cell) -> w -> u,
    and (v, cell) -> u for the context weights.  Pointers and ids are
    Elias-Fano sequences, probabilities 8-bit codes of log10; the levels lie in
    a memory-mapped scratch file.  It looks up the distinct n-grams of all its
    documents by successor search relative to their context and returns sums
    per document.

Defined results: null and empty texts hold one token, the end; a null doc_id
counts as the empty text in the split; repeated rows train and are scored as
often as they stand; an empty table gives no rows; other columns are ignored.
The chunks rely on the input being read alike in both passes (a table of files).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import text
from .eliasfano import EliasFano, TrieLevel, memory_map
from .packing import pack, slices, unpack
from .store import ship, shuffle_partitions, write_table

DISCOUNT = 0.75
STEP = 1 / 16                  # width of a probability code in log10; 255 codes reach 10**-15.9
CELL = 500_000                 # occurrences of a middle word per cell
UNKNOWN, START, FIRST_ID = 0, 1, 2
END = np.uint64(text.mix_one(0x656E64))
_U = np.uint64


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p / STEP), 0, 255).astype(np.uint8)


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, index of every token, token offsets of the rows, held-out flags, ids."""
    words, offsets = text.word_hashes(part["text"], text.SPACED)
    n = part.num_rows
    out = np.empty(len(words) + n, np.uint64)
    ends = offsets[1:] + np.arange(n)
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end], out[~is_end] = END, words
    distinct, index = np.unique(out, return_inverse=True)
    ids = part["doc_id"].to_pylist()
    held = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i in ids], bool)
    return distinct, index, np.append(0, ends + 1), held, ids


def _cuts(n: int) -> np.ndarray:
    return np.array([(i << 64) // n for i in range(n)], dtype=np.uint64)


_WORDS = "shard int, hashes binary, counts binary, types long, tokens long"
_ROWS = "chunk long, shard int, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
_SCHEMA = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32())] + [(x, pa.binary()) for x in "abcdef"])
_VOCABULARY, _ASK, _STREAM, _ANSWER, _GRAMS, _PARTIAL, _PAIRS, _BIGRAMS, _CONTEXTS = range(9)


def _row(chunk: int, shard: int, kind: int, *data: bytes) -> tuple:
    return (chunk, shard, kind, *data, *[None] * (6 - len(data)))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_SCHEMA.names)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def vocabulary(docs: DataFrame, n_shards: int) -> DataFrame:
    """Sorted word hashes and training counts of every shard, written once."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, index, offsets, held, _ = _tokens(part)
                train = np.repeat(~held, np.diff(offsets))
                counts = np.bincount(index[train], minlength=len(distinct)).astype(np.uint64)
                distinct, counts = distinct[counts > 0], counts[counts > 0]
                cuts = np.append(np.searchsorted(distinct, _cuts(n_shards)), len(distinct))
                rows = [(s, pack(np.diff(distinct[a:b], prepend=_U(0))), pack(counts[a:b]), 0, 0)
                        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))],
                        names=["shard", "hashes", "counts", "types", "tokens"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([np.cumsum(unpack(h), dtype=np.uint64) for h in pdf["hashes"]])
        counts = np.concatenate([unpack(c) for c in pdf["counts"]])
        distinct, index = np.unique(hashes, return_inverse=True)
        total = np.bincount(index, counts).astype(np.uint64)
        return pd.DataFrame([(pdf["shard"].iloc[0], pack(np.diff(distinct, prepend=_U(0))), pack(total), len(distinct), int(total.sum()))],
                            columns=list(pdf.columns))

    return write_table(docs.mapInArrow(count, _WORDS).groupBy("shard").applyInPandas(merge, _WORDS), "lm-vocabulary")


def _ask(n_shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, index, offsets, held, ids = _tokens(part)
                null = np.array([i is None for i in ids], bool)
                ids = np.array([0 if i is None else i for i in ids], np.int64)
                # frequent words get small numbers, which pack well
                order = np.argsort(-np.bincount(index, minlength=len(distinct)), kind="stable")
                number = np.empty(len(order), np.int64)
                number[order] = np.arange(len(order))
                rows = [_row(chunk, int(chunk % n_shards), _STREAM, ids.tobytes(), pack(number[index]), pack(number), pack(np.diff(offsets)),
                             np.packbits(held).tobytes(), np.packbits(null).tobytes())]
                cuts = np.append(np.searchsorted(distinct, _cuts(n_shards)), len(distinct))
                rows += [_row(chunk, s, _ASK, pack(np.diff(distinct[a:b], prepend=_U(0))))
                         for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                yield _batch(rows)
                chunk += 1
    return ask


def _answer(n_shards: int):
    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf[pdf["kind"] == _VOCABULARY]
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(known):
            hashes, counts = np.cumsum(unpack(known["a"].iloc[0]), dtype=np.uint64), unpack(known["b"].iloc[0])
        rank = np.empty(len(hashes), np.uint64)
        rank[np.lexsort((hashes, -counts.astype(np.int64)))] = np.arange(len(hashes), dtype=np.uint64)
        out = []
        for r in pdf[pdf["kind"] == _ASK].itertuples():
            asked = np.cumsum(unpack(r.a), dtype=np.uint64)
            at = np.minimum(np.searchsorted(hashes, asked), max(len(hashes) - 1, 0))
            hit = hashes[at] == asked if len(hashes) else np.zeros(len(asked), bool)
            ids, c = np.zeros(len(asked), np.uint64), np.zeros(len(asked), np.uint64)
            ids[hit] = rank[at[hit]] * _U(n_shards) + _U(r.shard) + _U(FIRST_ID)
            c[hit] = counts[at[hit]]
            out.append(_row(r.chunk, r.shard, _ANSWER, pack(ids), pack(c)))
        return pd.concat([pdf[pdf["kind"] == _STREAM], _frame(out)], ignore_index=True)
    return answer


def _resolve(pdf: pd.DataFrame) -> tuple:
    """A chunk's stream, ids and counts of its distinct words, its tokens, and lengths and starts of its documents."""
    stream = pdf[pdf["kind"] == _STREAM].iloc[0]
    answers = pdf[pdf["kind"] == _ANSWER].sort_values("shard")
    number = unpack(stream["c"]).astype(np.int64)
    ids, counts = np.empty(len(number), np.uint64), np.empty(len(number), np.uint64)
    ids[number] = np.concatenate([unpack(x) for x in answers["a"]])
    counts[number] = np.concatenate([unpack(x) for x in answers["b"]])
    token, lengths = unpack(stream["b"]).astype(np.int64), unpack(stream["d"]).astype(np.int64)
    return stream, ids, counts, token, lengths, np.cumsum(lengths) - lengths


def _ngrams(ids: np.ndarray, counts: np.ndarray, token: np.ndarray, starts: np.ndarray, size: int) -> tuple:
    """u, v, w of every token, the number of cells of v and the cell."""
    w, c = ids[token], counts[token]
    v, cv = np.roll(w, 1), np.roll(c, 1)
    v[starts] = START
    u = np.roll(v, 1)
    cells = cv // _U(size) + _U(1)
    return u, v, w, cells, text.mix(u + _U(77)) % cells


def _held(stream: pd.Series, lengths: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.frombuffer(stream["e"], np.uint8), count=len(lengths))


def _place(v: np.ndarray, second: np.ndarray, n_shards: int) -> np.ndarray:
    return (text.mix(v * _U(1000003) + second) % _U(n_shards)).astype(np.int64)


def _by_shard(chunk: int, kind: int, shard: np.ndarray, n_shards: int, *columns: np.ndarray) -> list[tuple]:
    """A row per shard; ``shard`` ascends."""
    cuts = np.append(np.searchsorted(shard, np.arange(n_shards)), len(shard))
    return [_row(chunk, int(s), kind, *[pack(x[cuts[s]:cuts[s + 1]]) for x in columns]) for s in np.flatnonzero(np.diff(cuts))]


def _pairs(n_shards: int):
    """Distinct (v, w, cell) of a chunk's split words with training counts, to the shards of (v, w)."""
    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        if all(unpack(x).max(initial=0) < CELL for x in pdf.loc[pdf["kind"] == _ANSWER, "b"]):
            return _frame([])                                        # no word of this chunk is split
        stream, ids, counts, token, lengths, starts = _resolve(pdf)
        u, v, w, cells, cell = _ngrams(ids, counts, token, starts, CELL)
        split = cells > 1
        split[starts] = False
        train = np.repeat(_held(stream, lengths) == 0, lengths)[split]
        v, w, cells, cell = (x[split] for x in (v, w, cells, cell))
        if not len(v):
            return _frame([])
        shard = _place(v, w, n_shards)
        order = np.lexsort((cell, w, v, shard))
        v, w, cells, cell, shard, train = (x[order] for x in (v, w, cells, cell, shard, train))
        first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1]) | (cell[1:] != cell[:-1])))
        count = np.add.reduceat(train, first, dtype=np.int64)
        return _frame(_by_shard(stream["chunk"], _PAIRS, shard[first], n_shards, v[first], w[first], cell[first], count, cells[first]))
    return pairs


def _bigrams(n_shards: int):
    """Counts of (v, w) over all cells for every cell that asks, and this shard's part of the sums and kinds per v for every cell."""
    def bigrams(pdf: pd.DataFrame) -> pd.DataFrame:
        v, w, cell, count, cells = (np.concatenate([unpack(x) for x in pdf[c]]) for c in "abcde")
        order = np.lexsort((cell, w, v))
        v, w, cell, count, cells = (x[order] for x in (v, w, cell, count, cells))
        new_v = np.append(True, v[1:] != v[:-1])
        new_pair = new_v | np.append(True, w[1:] != w[:-1])
        new = new_pair | np.append(True, cell[1:] != cell[:-1])
        total = np.add.reduceat(count, np.flatnonzero(new_pair))
        each = total[np.cumsum(new_pair) - 1][new]
        shard = _place(v[new], cell[new], n_shards)
        order = np.argsort(shard, kind="stable")
        out = _by_shard(-1, _BIGRAMS, shard[order], n_shards, *[x[order] for x in (v[new], cell[new], w[new], each)])
        lead = np.flatnonzero(new_v[new_pair])
        sums, kinds = np.add.reduceat(total, lead), np.add.reduceat(total > 0, lead, dtype=np.int64)
        v, cells = v[new_v], cells[new_v].astype(np.int64)
        cell = (np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)).astype(np.uint64)
        v, sums, kinds = (np.repeat(x, cells) for x in (v, sums, kinds))
        shard = _place(v, cell, n_shards)
        order = np.argsort(shard, kind="stable")
        return _frame(out + _by_shard(-1, _CONTEXTS, shard[order], n_shards, *[x[order] for x in (v, cell, sums, kinds)]))
    return bigrams


def _ranks(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of every value among the distinct ones, and the bits that hold it."""
    distinct, rank = np.unique(x, return_inverse=True)
    return rank.astype(np.uint64), max(1, int(len(distinct) - 1).bit_length())


def _order(shard: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Order by shard, v and w: one sort of numbers that hold the ranks and the position, where they fit."""
    place = max(1, int(len(shard) - 1).bit_length())
    (first, bits1), (second, bits2) = _ranks(shard.astype(np.uint64) << _U(48) | v), _ranks(w)
    if int(v.max()) >> 48 or bits1 + bits2 + place > 64:
        return np.lexsort((w, v, shard))
    key = (first << _U(bits2) | second) << _U(place) | np.arange(len(shard), dtype=np.uint64)
    key.sort()
    return (key & _U((1 << place) - 1)).astype(np.int64)


def _grams(n_shards: int, total: float):
    def grams(pdf: pd.DataFrame) -> pd.DataFrame:
        stream, ids, counts, token, lengths, starts = _resolve(pdf)
        value = np.log10(counts + 0.1)
        stats = np.stack([np.add.reduceat(value[token], starts), np.add.reduceat(counts[token] > 0, starts, dtype=np.int64), lengths,
                          value[token[starts]] - np.log10(total)])      # a text's first token has no context
        chunk = stream["chunk"]
        out = [_row(chunk, int(chunk % n_shards), _STREAM, stream["a"], stats.astype(np.float64).tobytes(), stream["e"], stream["f"])]

        u, v, w, _, cell = _ngrams(ids, counts, token, starts, CELL)
        code = quantise(value - np.log10(total))[token]
        doc = np.repeat(np.arange(len(lengths), dtype=np.uint64) * _U(2) + _held(stream, lengths).astype(np.uint64), lengths)
        shard = _place(v, cell, n_shards)
        shard[starts] = n_shards                                     # goes nowhere
        order = _order(shard, v, w)[:len(shard) - len(starts)]
        v, w, u, cell, doc, code, shard = (x[order] for x in (v, w, u, cell, doc, code, shard))
        cuts = np.append(np.searchsorted(shard, np.arange(n_shards)), len(shard))
        for s in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[s], cuts[s + 1]
            same = np.append(False, v[a + 1:b] == v[a:b - 1])        # w ascends within v
            dw = np.where(same, w[a:b] - np.append(_U(0), w[a:b - 1]), w[a:b])
            out.append(_row(chunk, int(s), _GRAMS, pack(np.diff(v[a:b], prepend=_U(0))), pack(dw), pack(u[a:b]),
                            pack(cell[a:b]), pack(doc[a:b]), pack(code[a:b])))
        return _frame(out)
    return grams


class Model:
    """The trie of one shard."""

    def __init__(self, root: np.ndarray, parents: np.ndarray, w: np.ndarray, count2: np.ndarray, p1: np.ndarray,
                 grams: np.ndarray, u: np.ndarray, count3: np.ndarray, universe: int, sums: np.ndarray, kinds: np.ndarray):
        """Sorted training contexts with their sums and kinds; bigrams (context, w) with counts and unigram log10; trigrams (bigram, u) with counts."""
        n = len(root)
        weight = DISCOUNT * kinds / sums
        p2 = (count2 - DISCOUNT) / sums[parents] + weight[parents] * 10.0 ** p1
        pair = parents[grams].astype(np.uint64) * _U(universe) + u.astype(np.uint64)
        pairs, of = np.unique(pair, return_inverse=True)
        sums3, kinds3 = np.bincount(of, count3), np.bincount(of)
        weight3 = DISCOUNT * kinds3 / sums3 if len(pairs) else np.zeros(0)
        p3 = (count3 - DISCOUNT) / sums3[of] + weight3[of] * p2[grams]
        self.root = EliasFano(root)
        self.level2 = TrieLevel(parents, w, n, universe)
        self.level3 = TrieLevel(grams, u, len(parents), universe)
        self.context = TrieLevel((pairs // _U(universe)).astype(np.int64), (pairs % _U(universe)).astype(np.int64), n, universe)
        codes = [quantise(np.log10(x)) for x in (weight, weight3, p2, p3)]
        parts = [self.root, self.level2.pointers, self.level2.ids, self.level3.pointers, self.level3.ids, self.context.pointers, self.context.ids]
        mapped = memory_map([a for p in parts for a in p.arrays()] + codes)
        for p, at in zip(parts, range(0, 3 * len(parts), 3)):
            p.low, p.bits, p.ones = mapped[at:at + 3]
        self.codes = mapped[3 * len(parts):]

    def score(self, root: np.ndarray, w: np.ndarray, u: np.ndarray, code1: np.ndarray) -> np.ndarray:
        """log10 p(w | u, v); ``root`` is the key of (v, cell), ascending, ``code1`` the unigram's code."""
        weight, weight3, p2, p3 = self.codes
        out = -STEP * code1.astype(np.float64)
        if not self.root.n:
            return out
        new = np.append(True, root[1:] != root[:-1])
        at, seen = self.root.ascending_successor(root[new].astype(np.uint64))
        parent = np.where(seen, at, -1)[np.cumsum(new) - 1]
        known = np.flatnonzero(parent >= 0)
        parent, w, u = parent[known], w[known], u[known]
        gram = self.level2.find(parent, w)
        hit = gram >= 0
        value = out[known] - STEP * weight[parent]
        value[hit] = -STEP * p2[gram[hit]].astype(np.float64)
        context = self.context.find(parent, u)
        value[context >= 0] -= STEP * weight3[context[context >= 0]]
        full = self.level3.find(gram[hit], u[hit])
        best = np.flatnonzero(hit)[full >= 0]
        value[best] = -STEP * p3[full[full >= 0]].astype(np.float64)
        out[known] = value
        return out


def score_grams(root, w, u, code, held, universe, whole=None):
    """log10 of every n-gram occurrence, the model being built from those not held out.

    ``whole`` has the figures that cover more than these occurrences: the
    split roots with sums and kinds, and the ascending bigrams root * universe
    + w of these with counts.
    """
    at2 = np.unique(root.astype(np.uint64) * _U(universe) + w, return_inverse=True)[1]
    grams, first, at3 = np.unique(at2.astype(np.uint64) * _U(universe) + u, return_index=True, return_inverse=True)
    count3 = np.bincount(at3, ~held, len(grams))
    root3, w3, u3, code3, gram3 = root[first], w[first], u[first], code[first], at2[first]
    trained = count3 > 0
    lead = np.flatnonzero(np.append(True, np.diff(gram3) > 0))
    root2, w2, count2 = root3[lead], w3[lead], np.bincount(gram3, count3, len(lead))
    roots, sums, kinds, bigrams, counts = whole or [np.zeros(0, np.int64)] * 5
    count2[np.searchsorted(root2.astype(np.uint64) * _U(universe) + w2, bigrams.astype(np.uint64))] = counts
    known = count2 > 0
    contexts = np.union1d(root2[known], roots.astype(root2.dtype))
    parents = np.searchsorted(contexts, root2[known])
    sums2, kinds2 = np.bincount(parents, count2[known], len(contexts)), np.bincount(parents, minlength=len(contexts))
    at = np.searchsorted(contexts, roots)
    sums2[at], kinds2[at] = sums, kinds
    model = Model(contexts, parents.astype(np.int64), w2[known].astype(np.int64), count2[known], -STEP * code3[lead][known].astype(np.float64),
                  (np.cumsum(known) - 1)[gram3[trained]], u3[trained].astype(np.int64), count3[trained], universe, sums2, kinds2)
    return model.score(root3, w3.astype(np.int64), u3.astype(np.int64), code3)[at3]


def _whole(pdf: pd.DataFrame, roots: np.ndarray, n_cells: int, universe: int) -> tuple | None:
    """What the shards of (v, w) know of this shard's split roots; ``roots`` are ascending keys v * n_cells + cell."""
    def read(kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = pdf[pdf["kind"] == kind]
        if not len(rows):
            return tuple([np.zeros(0, np.uint64)] * 3)
        v, cell, x, y = (np.concatenate([unpack(r) for r in rows[c]]) for c in "abcd")
        here = cell < n_cells
        key = v[here] * _U(n_cells) + cell[here]
        at = np.minimum(np.searchsorted(roots, key), len(roots) - 1)
        hit = roots[at] == key
        return at[hit].astype(np.uint64), x[here][hit], y[here][hit]

    root, sums, kinds = read(_CONTEXTS)
    if not len(root):
        return None
    root, of = np.unique(root, return_inverse=True)
    at, w, count = read(_BIGRAMS)
    bigrams = at * _U(universe) + w
    order = np.argsort(bigrams)
    return root, np.bincount(of, sums), np.bincount(of, kinds), bigrams[order], count[order]


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x


def _scores(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = pdf[pdf["kind"] == _GRAMS]
    out = pdf[pdf["kind"] == _STREAM]
    if not len(rows):
        return out
    parts = []
    for r in rows.itertuples():
        v, dw = np.cumsum(unpack(r.a), dtype=np.uint64), unpack(r.b)
        first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        run = np.cumsum(dw, dtype=np.uint64)
        run -= np.repeat(run[first] - dw[first], np.diff(np.append(first, len(v))))
        parts.append((_narrow(v), _narrow(run), *[_narrow(unpack(x)) for x in (r.c, r.d, r.e)], unpack(r.f).astype(np.uint8)))
    sizes = [len(p[0]) for p in parts]
    v, w, u, cell, doc, code = (np.concatenate([p[i] for p in parts]) for i in range(6))
    del parts
    n_cells = int(cell.max()) + 1
    roots, of = np.unique(v.astype(np.uint64) * _U(n_cells) + cell, return_inverse=True)
    of = of.astype(np.uint32)
    del v, cell
    universe = int(max(w.max(), u.max())) + 1
    value = score_grams(of, w, u, code, (doc & 1).astype(bool), universe, _whole(pdf, roots, n_cells, universe))
    doc = doc >> 1
    found, at = [], 0
    for r, n in zip(rows.itertuples(), sizes):
        # values are whole steps, so the sums are exact
        found.append(_row(r.chunk, 0, _PARTIAL, pack(np.rint(np.bincount(doc[at:at + n], value[at:at + n]) / -STEP))))
        at += n
    return pd.concat([out, _frame(found)], ignore_index=True)


def _finish(n_train: int, total: float):
    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        meta = pdf[pdf["kind"] == _STREAM].iloc[0]
        ids = np.frombuffer(meta["a"], np.int64)
        base, known, length, first = np.frombuffer(meta["b"], np.float64).reshape(4, -1)
        flags = [np.unpackbits(np.frombuffer(meta[x], np.uint8), count=len(ids)).astype(bool) for x in "cd"]
        score = first.copy()
        for part in pdf.loc[pdf["kind"] == _PARTIAL, "a"]:
            part = unpack(part)
            score[:len(part)] -= STEP * part.astype(np.float64)
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids, flags[1]), "held_out": flags[0], "n_tokens": length.astype(np.int64),
                             "n_known": known.astype(np.int64), "train_tokens": n_train,
                             "base_score": base - length * np.log10(total), "score": score})
    return finish


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    ship(docs.sparkSession)
    n_shards = 2 * shuffle_partitions(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = vocabulary(docs, n_shards)
    n_train, n_types = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    total = max(n_train + 0.1 * (n_types + 1), 0.1)
    none = F.lit(None).cast("binary")
    known = words.select(F.lit(-1).cast("long").alias("chunk"), "shard", F.lit(_VOCABULARY).alias("kind"), F.col("hashes").alias("a"),
                         F.col("counts").alias("b"), *[none.alias(x) for x in "cdef"])
    answers = docs.mapInArrow(_ask(n_shards), _ROWS).union(known).groupBy("shard").applyInPandas(_answer(n_shards), _ROWS)
    grams = answers.groupBy("chunk").applyInPandas(_grams(n_shards, total), _ROWS)
    bigrams = answers.groupBy("chunk").applyInPandas(_pairs(n_shards), _ROWS).groupBy("shard").applyInPandas(_bigrams(n_shards), _ROWS)
    scores = grams.union(bigrams).groupBy("shard").applyInPandas(_scores, _ROWS)
    return scores.groupBy("chunk").applyInPandas(
        _finish(n_train, total), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
