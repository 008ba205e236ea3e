"""Words and word shingles of whole texts as 64-bit hashes, vectorised over an Arrow batch.

Bytes are folded A-Z to a-z.  Two word definitions are used by the operators:
``SPACED`` words are runs of ``[^\\x20\\x09-\\x0D]``, ``PLAIN`` words are runs
of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (digits, letters, all non-ASCII).
Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SLICE = 1 << 16   # bytes hashed at a time; bounds the temporaries, not the text
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)

SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
PLAIN = np.zeros(256, bool)
PLAIN[ord("0"):ord("9") + 1] = PLAIN[ord("a"):ord("z") + 1] = PLAIN[ord("A"):ord("Z") + 1] = True
PLAIN[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mix_one(x: int) -> int:
    return int(mix(np.array([x], dtype=np.uint64))[0])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (n + 1)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every row, and the word offsets of the rows (n + 1)."""
    buf, offsets = text_bytes(column)
    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = words[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(buf)]
    first[row_starts] = inside[row_starts]
    starts = np.flatnonzero(first)
    row_offsets = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), row_offsets
    table = np.where(words, _BYTE, np.uint64(0))
    ends = np.append(starts[1:], len(buf))
    out = np.empty(len(starts), np.uint64)
    power = _powers(_P, 64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SLICE)))
        a, b = starts[i], ends[j - 1]
        part = starts[i:j] - a
        place = np.arange(b - a) - np.repeat(part, np.diff(np.append(part, b - a)))
        if (top := int(place.max()) + 1) > len(power):
            power = _powers(_P, top)
        out[i:j] = np.add.reduceat(table[buf[a:b]] * power[place], part)
        i = j
    return mix(out), row_offsets


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, k: int,
                   short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every row in text order, and their row offsets.

    A row with 1 to k - 1 words is one shingle of all its words when ``short``,
    else has none.
    """
    n_words = np.diff(offsets)
    n = np.where(n_words >= k, n_words - k + 1, ((n_words > 0) & short).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(n)])
    q = _powers(_Q, k)
    rows = np.flatnonzero(n)
    total = int(out_offsets[-1])
    out = np.zeros(total, np.uint64)
    long_rows = n_words >= k
    if len(hashes) >= k:
        m = len(hashes) - k + 1
        rolled = hashes[:m].copy()
        for j in range(1, k):
            rolled += hashes[j:j + m] * q[j]
        at = np.repeat(offsets[:-1] - out_offsets[:-1], n) + np.arange(total)
        keep = np.repeat(long_rows, n)
        out[keep] = rolled[at[keep]]
    for r in rows[~long_rows[rows]]:
        w = hashes[offsets[r]:offsets[r + 1]]
        with np.errstate(over="ignore"):
            out[out_offsets[r]] = (w * q[:len(w)]).sum() + np.uint64(len(w))
    return mix(out), out_offsets
