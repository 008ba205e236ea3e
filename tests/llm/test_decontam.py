"""Containment search against brute force, on both sides of the broadcast bound."""

import re

import numpy as np
import pytest

from headway.llm import decontam
from headway.llm.queries import table

WORD = re.compile(r"[0-9a-z\x80-\U0010FFFF]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items):
    held = [(d, shingles(t)) for d, t in docs]
    out = []
    for i, t in items:
        own = shingles(t)
        out += [(d, i, len(own), len(own & s)) for d, s in held if own and 100 * len(own & s) >= 80 * len(own)]
    return sorted(out, key=str)


def planted():
    """Items of 1 to 600 words; documents that hold some 60 to 100 % of one, cut at random places or at one end."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    items, docs = [], []
    for i, size in enumerate([1, 3, 5, 6, 9, 14, 15, 24, 25, 40, 70, 130, 260, 600] * 2):
        words = list(rng.choice(vocabulary, size))
        items.append((i, " ".join(words)))
        for j, share in enumerate((0.6, 0.75, 0.8, 0.82, 0.9, 1.0)):
            held = words[:max(1, round(size * share))] if j % 2 else words.copy()
            if not j % 2:
                for at in rng.choice(size, int((1 - share) * size / 3), replace=False):
                    held[at] = "changed"
            around = list(rng.choice(vocabulary, 300)) if size > 4 else []
            docs.append((100 * i + j, " ".join(around + held + around[:50])))
    docs += [docs[5], docs[5], (None, docs[17][1]), (7777, None), (7778, ""), (7779, " . ")]
    items += [items[4], (None, items[6][1]), (900, None), (901, "  ")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 0])
def test_planted_items_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block_bytes)
    docs, items = planted()
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, d1 int, salt string").repartition(5)
    bench = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, least int")
    want = brute(docs, items)
    got = sorted((tuple(r)[:4] for r in decontam.search(frame, bench).collect()), key=str)
    assert got == want and 100 < len(want) < len(docs) * 2
    kept = decontam.clean(frame, bench)
    gone = {d for d, *_ in want}
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in gone), key=str)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 0])
def test_no_documents_or_no_items(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block_bytes - 1 if not block_bytes else block_bytes)
    docs, items = planted()
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    none = frame.where("false"), bench.where("false")
    assert decontam.search(none[0], bench).count() == decontam.search(frame, none[1]).count() == 0
    assert decontam.clean(none[0], bench).count() == 0 and decontam.clean(frame, none[1]).count() == len(docs)


def test_joined_search_equals_the_broadcast_one_on_the_tables(spark, monkeypatch):
    docs, bench = (table(spark, "/root/testdata/sf0.01", x) for x in ("documents", "benchmark"))
    want = sorted(map(tuple, decontam.search(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 0)
    assert sorted(map(tuple, decontam.search(docs, bench).collect())) == want and want


@pytest.mark.parametrize("size", list(range(1, 70)) + [99, 100, 101, 128, 129, 500, 3000])
def test_no_sketch_can_miss_a_contained_item(size):
    """Even where all absent shingles are the sketch's own."""
    absent = size - -(-80 * size // 100)
    k, least = decontam.sketch_size(size), decontam.least_hits(size)
    assert 1 <= least <= k <= size and k - min(absent, k) >= least
    # one size partition shares one sample size
    greatest = 1 << (size - 1).bit_length()
    assert k == min(size, decontam.sketch_size(greatest))
