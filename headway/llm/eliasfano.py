"""Elias-Fano sequences over numpy arrays, and a trie level built from them.

A non-decreasing sequence of n values below u keeps floor(log2(u / n)) low
bits of each value packed, and the high parts in unary: value i sets bit
high(i) + i.  All queries are vectorised.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator

import numpy as np


class EliasFano:
    def __init__(self, values: np.ndarray):
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = min(57, max(0, (top // max(self.n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        self.low = _pack_bits(values & np.uint64((1 << self.low_bits) - 1), self.low_bits)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        size = int(high[-1]) + self.n + 2 if self.n else 2
        bits = np.zeros((size + 63) // 64 * 64, bool)
        bits[high + np.arange(self.n)] = True
        self.bits = np.packbits(bits, bitorder="little")
        self._index()

    def _index(self) -> None:
        ones = np.bitwise_count(self.bits.view("<u8")).astype(np.int64)
        self.ones = np.append(0, np.cumsum(ones)).astype(np.uint32 if self.n < 1 << 31 else np.uint64)    # ones before each 64-bit word

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.bits, self.ones]

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        words = len(self.ones) - 1
        before = self.ones if one else np.arange(words + 1, dtype=np.int64) * 64 - self.ones
        at = np.searchsorted(before, k.astype(before.dtype), side="right") - 1
        left = k - before[at].astype(np.int64)
        at = np.minimum(at, words - 1)
        word = self.bits.view("<u8")[at]
        if not one:
            word = ~word
        out = at * 64
        for half in (32, 16, 8):
            low = word & np.uint64((1 << half) - 1)
            here = np.bitwise_count(low).astype(np.int64)
            move = left >= here
            word = np.where(move, word >> np.uint64(half), low)
            left -= here * move
            out += half * move
        return out + _SELECT[word & np.uint64(0xFF), np.minimum(left, 7)]

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | _read_bits(self.low, i, self.low_bits)

    def successor(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the first value >= x among the indices from ``begin`` to ``end``; ``end`` where there is none."""
        x = np.asarray(x, np.uint64)
        last = np.broadcast_to(np.asarray(self.n if end is None else end, np.int64), len(x))
        if not self.n or not len(x):
            return last.copy()
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        zeros = len(self.bits) * 8 - int(self.ones[-1])
        # the values with this high part stand between the zeros before and after them
        low = np.where(high == 0, 0, self._select(np.clip(high - 1, 0, zeros - 1), False) + 1 - high)
        top = self._select(np.clip(high, 0, zeros - 1), False) - high
        low, top = (np.where(high >= zeros, self.n, y) for y in (low, top))
        low, top = np.clip(low, begin, last), np.clip(top, begin, last)
        open_ = np.flatnonzero(low < top)
        while len(open_):
            middle = (low[open_] + top[open_]) >> 1
            less = self.access(middle) < x[open_]
            low[open_[less]] = middle[less] + 1
            top[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < top[open_]]
        return low


    def decode(self, begin: int, end: int) -> np.ndarray:
        """The values from index ``begin`` to ``end``."""
        first, last = self._select(np.array([begin, end - 1]), True)
        byte = int(first) >> 3
        ones = np.flatnonzero(np.unpackbits(self.bits[byte:(int(last) >> 3) + 1], bitorder="little")) + 8 * byte
        ones = ones[np.searchsorted(ones, first):][:end - begin]
        at = np.arange(begin, end)
        return ((ones - at).astype(np.uint64) << np.uint64(self.low_bits)) | _read_bits(self.low, at, self.low_bits)

    def _blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        for begin in range(0, self.n, BLOCK):
            yield begin, self.decode(begin, min(begin + BLOCK, self.n))

    def ascending_access(self, i: np.ndarray) -> np.ndarray:
        """``access`` for ascending indices, a block of the sequence at a time."""
        out = np.empty(len(i), np.uint64)
        for begin, values in self._blocks():
            a, b = np.searchsorted(i, [begin, begin + len(values)])
            out[a:b] = values[i[a:b] - begin]
        return out

    def ascending_successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value >= x (n where there is none) for ascending x, and whether it equals x."""
        out, equal, at = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool), 0
        for begin, values in self._blocks():
            to = at + int(np.searchsorted(x[at:], values[-1], side="right"))
            here = np.searchsorted(values, x[at:to])
            out[at:to], equal[at:to] = begin + here, values[here] == x[at:to]
            at = to
        return out, equal


BLOCK = 1 << 16                # values decoded at a time by an ascending search

_SELECT = np.zeros((256, 8), np.int64)         # place of the k-th one of a byte
for _byte in range(256):
    _places = [i for i in range(8) if _byte >> i & 1]
    _SELECT[_byte, :len(_places)] = _places


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    if not width or not len(values):
        return np.zeros(16, np.uint8)
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1) if len(values) * width <= 1 << 22 else None
    if bits is None:                                                 # in slices, to bound the temporaries
        step = 8 * max(1, (1 << 19) // width)
        return np.concatenate([_pack_bits(values[a:a + step], width)[:step * width // 8] for a in range(0, len(values), step)]
                              + [np.zeros(16, np.uint8)])
    return np.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"), np.zeros(16, np.uint8))


def _read_bits(data: np.ndarray, i: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(i), np.uint64)
    start = i * width
    # eight bytes from any byte on hold every value of up to 57 bits
    at_byte = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    return (at_byte[start >> 3] >> (start & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class TrieLevel:
    """Children of trie nodes: pointers and child ids as Elias-Fano sequences, one payload code per child.

    Ids are strictly ascending within a node; offset by node * universe the
    whole level ascends, so a child is found by a successor search relative to
    its node.
    """

    def __init__(self, parents: np.ndarray, ids: np.ndarray, n_parents: int, universe: int):
        counts = np.bincount(parents, minlength=n_parents)
        self.pointers = EliasFano(np.append(0, np.cumsum(counts)))
        self.universe = universe
        self.ids = EliasFano(parents.astype(np.uint64) * np.uint64(universe) + ids.astype(np.uint64))

    def find(self, parents: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Position of child ``ids`` of node ``parents``; -1 where absent.

        The queries are put in ascending order, so the level is read front to
        back, a block at a time, and the successor of each query is held
        against the pointers of its node.
        """
        if not self.ids.n or not len(ids):
            return np.full(len(ids), -1, np.int64)
        target = parents.astype(np.uint64) * np.uint64(self.universe) + ids.astype(np.uint64)
        back = None
        if (target[1:] < target[:-1]).any():
            target, back = np.unique(target, return_inverse=True)
        at, equal = self.ids.ascending_successor(target)
        node = (target // np.uint64(self.universe)).astype(np.int64)
        new = np.append(True, node[1:] != node[:-1])                     # queries come in runs of one node
        nodes, run = node[new], np.cumsum(new) - 1
        begin, end = (self.pointers.ascending_access(nodes + k).astype(np.int64)[run] for k in (0, 1))
        found = np.where(equal & (begin <= at) & (at < end), at, -1)
        return found if back is None else found[back]

    def arrays(self) -> list[np.ndarray]:
        return self.pointers.arrays() + self.ids.arrays()


def memory_map(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays moved into one memory-mapped scratch file that is gone from its folder at once.

    The system drops and rereads its pages at will; nothing stays behind when
    the task ends or dies.
    """
    offsets = np.cumsum([0] + [(a.nbytes + 63) // 64 * 64 for a in arrays])
    if not offsets[-1]:
        return arrays
    handle, path = tempfile.mkstemp(prefix="trie-")
    try:
        os.unlink(path)
        os.truncate(handle, int(offsets[-1]))
        mapped = mmap.mmap(handle, int(offsets[-1]))
    finally:
        os.close(handle)
    out = []
    for a, at in zip(arrays, offsets):
        view = np.frombuffer(mapped, a.dtype, len(a), int(at))
        view[:] = a
        out.append(view)
    return out
