"""Packed integer columns and bounded chunks of documents for exchanges between tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from . import text

CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 30_000     # a chunk holds whole documents, more bytes only if one alone does


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, compressed; ascending ones are best given as differences."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``limit`` bytes of text each."""
    _, offsets = text.text_bytes(batch[column])
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to
