"""Fill-in-the-middle rearrangement of documents, one Arrow batch at a time.

A text is cut into units (white space before a word belongs to the word).  Two
hashed draws cut the units into prefix, middle and suffix; two more decide
whether the text is rearranged at all and in which order.  The work is a
pipeline of Arrow kernels over a batch: mark the end of every unit and split
into list arrays, flatten them with the index of their parent, number the units
within the parent, filter them by role, rebuild one list array per role, and
join lists and markers into texts.  ``restore`` undoes it from output and form.

The kernels see bytes, so a unit never cuts a code point (white space is
ASCII) and any bytes pass unchanged.  A batch is worked off in slices of at
most ``SLICE_BYTES`` of text (one text where it alone is longer).

Defined results: a null text counts as empty; an empty text, and one that
holds a marker, stays plain; a null id draws like the empty string; rows with
equal ids draw alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .store import ship

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
EMPTY = pa.scalar(b"", pa.large_binary())
END = b"\xff"                  # stands in no UTF-8 text
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SLICE_BYTES = 16 << 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


def _chars(data: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(data.view(pa.large_string())), pa.int64())


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def cut(text: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every text: units before ``first``, between, from ``second`` on."""
    marked = pc.replace_substring_regex(text, pattern=UNIT, replacement=rb"\0" + END)
    units = pc.split_pattern(marked, pattern=END)            # the last one is empty
    sizes = pc.list_value_length(units).to_numpy()
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    start = _long(np.cumsum(sizes) - sizes)
    ordinal = pc.subtract(_long(np.arange(len(flat))), pc.take(start, parent))
    low, high = pc.take(_long(first), parent), pc.take(_long(second), parent)
    roles = [(pc.less(ordinal, low), first),
             (pc.and_(pc.greater_equal(ordinal, low), pc.less(ordinal, high)), second - first),
             (pc.greater_equal(ordinal, high), sizes - second)]
    return [pc.binary_join(_lists(flat.filter(mask), count), EMPTY) for mask, count in roles]


def _join(*pieces) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_binary()) if isinstance(p, bytes) else p for p in pieces], EMPTY)


def rearranged(text: pa.Array, draws: np.ndarray, rate: int, spm_share: int) -> dict[str, pa.Array]:
    """Columns of one slice: ``draws`` holds the four draws of every row."""
    n = pc.cast(pc.count_substring_regex(text, UNIT), pa.int64())
    units = n.to_numpy()
    held = np.zeros(len(text), dtype=bool)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held |= pc.match_substring(text, marker).to_numpy(zero_copy_only=False)
    moved = (units > 0) & ~held & (draws[:, 2] % 100 < rate)
    spm = moved & (draws[:, 3] % 100 < spm_share)
    cuts = np.sort(draws[:, :2] % (units[:, None] + 1), axis=1)[moved]
    prefix, middle, suffix = cut(text.filter(pa.array(moved)), cuts[:, 0], cuts[:, 1])
    by_suffix = pa.array(spm[moved])
    changed = pc.if_else(by_suffix, _join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                         _join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    at = pa.array(np.where(moved, np.cumsum(moved) - 1, 0), mask=~moved)          # null where plain
    return {"n": n, "form": pa.array(np.where(spm, "spm", np.where(moved, "psm", "plain"))),
            "prefix_chars": pc.take(_chars(prefix), at), "middle_chars": pc.take(_chars(middle), at),
            "output": pc.coalesce(pc.take(changed, at), text)}


def _after(data: pa.Array, marker: bytes) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first ``marker``."""
    pieces = pc.split_pattern(data, pattern=marker, max_splits=1)
    return pc.list_element(pieces, 0), pc.list_element(pieces, 1)


def _between(data: pa.Array, *markers: bytes) -> list[pa.Array]:
    """The pieces that follow each of the markers."""
    found, rest = [], data
    for marker in markers:
        before, rest = _after(rest, marker)
        found.append(before)
    return [*found[1:], rest]


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text that every output came from."""
    psm = pc.equal(form, "psm")
    spm = pc.equal(form, "spm")
    prefix, suffix, middle = _between(output.filter(psm), PREFIX, SUFFIX, MIDDLE)
    from_psm = _join(prefix, middle, suffix)
    suffix, prefix, middle = _between(output.filter(spm), SUFFIX, PREFIX, MIDDLE)
    from_spm = _join(prefix, middle, suffix)
    both = pa.concat_arrays([from_psm, from_spm])
    is_psm, is_spm = (m.to_numpy(zero_copy_only=False) for m in (psm, spm))
    at = np.where(is_psm, np.cumsum(is_psm) - 1, len(from_psm) + np.cumsum(is_spm) - 1)
    plain = ~(is_psm | is_spm)
    return pc.coalesce(pc.take(both, pa.array(np.where(plain, 0, at), mask=plain)), output)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with at most ``SLICE_BYTES`` of text, with that text as bytes."""
    text = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(text).to_numpy())
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(lo, hi - lo), text.slice(lo, hi - lo)
        lo = hi


def _string(data: pa.Array) -> pa.Array:
    return data.view(pa.large_string()).cast(pa.string())


def rearrange(docs: DataFrame, seed: int = 42, rate: int = 50, spm_share: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    ``rate`` of a hundred texts are rearranged, ``spm_share`` of a hundred of
    those with the suffix first.
    """
    ship(docs.sparkSession)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", draw.alias("draw"))
    rows = rows.select("doc_id", "text", *[F.conv(F.substring("draw", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text in _slices(batch, "text"):
                draws = np.stack([part.column(f"h{i + 1}").to_numpy() for i in range(4)], axis=1)
                out = rearranged(text, draws, rate, spm_share)
                out["output"] = _string(out["output"])
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **out})

    return rows.mapInArrow(work, SCHEMA)


def restore(rows: DataFrame) -> DataFrame:
    """Rows of ``rearrange`` with the column ``restored``, the text rebuilt from ``output`` and ``form``."""
    ship(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, output in _slices(batch, "output"):
                yield part.append_column("restored", _string(restored(output, part.column("form"))))

    return rows.mapInArrow(work, f"{SCHEMA}, restored string")


def digest(docs: DataFrame) -> DataFrame:
    return restore(rearrange(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
f AS (
  SELECT doc_id, text, units, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM f)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
