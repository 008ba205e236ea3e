"""Language model against a plain dictionary model, and the Elias-Fano levels against searchsorted."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from headway.llm import lm
from headway.llm.eliasfano import EliasFano, TrieLevel, memory_map

TEXTS = ["a b c a b d", "A b  c\ta b", "", None, "x", "a b c a b c a b c", "b b b b", "zz a b c", "c a b d e f g", "é É a b"]


def tokens(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded) + ["</s>"]


def plain_model(rows):
    """p(w | u, v) by the definition, unquantised."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    one, two, three = Counter(), defaultdict(Counter), defaultdict(Counter)
    for (_, text), h in zip(rows, held):
        if not h:
            t = tokens(text)
            one.update(t)
            for i in range(1, len(t)):
                two[t[i - 1]][t[i]] += 1
                three[t[i - 2] if i > 1 else "<s>", t[i - 1]][t[i]] += 1
    n, types, d = sum(one.values()), len(one), lm.DISCOUNT

    def p(u, v, w):
        out = (one[w] + 0.1) / (n + 0.1 * (types + 1))
        for context in (two.get(v), three.get((u, v))) if v else ():
            if context:
                s = sum(context.values())
                out = max(context[w] - d, 0) / s + d * len(context) / s * out
        return out

    result = []
    for (i, text), h in zip(rows, held):
        t = tokens(text)
        total = sum(math.log10(p(t[k - 2] if k > 1 else "<s>", t[k - 1] if k else None, t[k])) for k in range(len(t)))
        base = sum(math.log10((one[x] + 0.1) / (n + 0.1 * (types + 1))) for x in t)
        result.append((i, h, len(t), sum(one[x] > 0 for x in t), n, base, total))
    return result


@pytest.fixture(scope="module")
def rows():
    return [(i, TEXTS[i % len(TEXTS)] if i < 40 else f"w{i % 7} a b w{i % 3} c{i}") for i in range(60)] + [(None, "a b c"), (5, "a b")]


def test_scores_match_plain_model(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(lm.score(df.selectExpr("doc_id", "text", "1 as score", "2 as shard")).collect(), key=repr)
    want = sorted(plain_model(rows), key=lambda r: repr(r))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(g[:5]) == w[:5]
        assert g["base_score"] == pytest.approx(w[5], abs=1e-6)
        # a token's code is at most half a step off per factor (context weights and probability)
        assert abs(g["score"] - w[6]) <= 1.5 * lm.STEP * w[2]


def test_probabilities_of_a_context_sum_to_one():
    """All words after one context, the unknown one included, up to the width of a probability code."""
    rng = np.random.default_rng(4)
    n_words, n = 12, 400
    v, w, u = (rng.integers(1, n_words, n).astype(np.uint32) for _ in range(3))
    counts = np.bincount(w, minlength=n_words)
    p1 = (counts + 0.1) / (n + 0.1 * n_words)
    for context_v, context_u in ((3, 5), (7, 0), (11, 2)):
        root = np.append(v, np.full(n_words, context_v)).astype(np.uint32)
        words = np.append(w, np.arange(n_words)).astype(np.uint32)
        before = np.append(u, np.full(n_words, context_u)).astype(np.uint32)
        held = np.append(np.zeros(n, bool), np.ones(n_words, bool))
        value = lm.score_grams(root, words, before, lm.quantise(np.log10(p1))[words], held, n_words)
        assert (10 ** value[n:]).sum() == pytest.approx(1, abs=0.08)


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_cells_split_frequent_words(spark, rows, monkeypatch):
    monkeypatch.setattr(lm, "CELL", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in lm.score(df).collect():
        assert r["score"] < 0 and r["score"] > 3 * r["base_score"] - 1


@pytest.mark.parametrize("cell", [1, 5, 20])
def test_cells_keep_the_bigrams_of_the_corpus(spark, rows, monkeypatch, cell):
    """Splitting a word's occurrences changes no probability: the dictionary model has no cells."""
    monkeypatch.setattr(lm, "CELL", cell)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got = sorted(lm.score(df).collect(), key=key)
    for g, w in zip(got, sorted(plain_model(rows), key=key), strict=True):
        assert abs(g["score"] - w[6]) <= 0.5 * lm.STEP * w[2]
    monkeypatch.undo()
    assert [g["score"] for g in got] == pytest.approx([g["score"] for g in sorted(lm.score(df).collect(), key=key)], abs=1e-4)


@pytest.mark.parametrize("n,top", [(0, 1), (1, 5), (10, 10), (1000, 50), (3000, 10**6), (5000, 2**52)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    ef = EliasFano(values)
    assert (ef.access(np.arange(n)) == values.astype(np.uint64)).all()
    asked = np.concatenate([rng.integers(0, top + 5, 200), values[:50], values[-50:] + 1]).astype(np.uint64)
    assert (ef.successor(asked) == np.searchsorted(values.astype(np.uint64), asked)).all()


def test_trie_level_and_mapping():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 50, 4000) * 1000 + rng.integers(0, 1000, 4000))
    parents, ids = keys // 1000, keys % 1000
    level = TrieLevel(parents, ids, 50, 1000)
    assert (level.find(parents, ids) == np.arange(len(keys))).all()
    every = np.arange(50 * 1000)
    assert ((level.find(every // 1000, every % 1000) >= 0) == np.isin(every, keys)).all()
    arrays = level.arrays()
    assert all((a == b).all() for a, b in zip(arrays, memory_map(arrays)))


@pytest.mark.parametrize("n,top", [(1, 5), (1000, 50), (3000, 10**6), (200_000, 2**40)])
def test_ascending_searches(monkeypatch, n, top):
    """Block by block, with blocks smaller and larger than the sequence."""
    from headway.llm import eliasfano
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
    ef = EliasFano(values)
    asked = np.sort(np.concatenate([rng.integers(0, top + 5, 500).astype(np.uint64), values[:200], values[-50:] + np.uint64(1)]))
    for block in (7 if n < 5000 else 4096, 1 << 16):
        monkeypatch.setattr(eliasfano, "BLOCK", block)
        at, equal = ef.ascending_successor(asked)
        assert (at == np.searchsorted(values, asked)).all()
        assert (equal == np.isin(asked, values)).all()
        index = np.unique(rng.integers(0, n, 300))
        assert (ef.ascending_access(index) == values[index]).all()
        assert (ef.decode(n // 3, n) == values[n // 3:]).all()


def test_packed_order_equals_lexsort():
    rng = np.random.default_rng(1)
    for top in (5, 1 << 20, 1 << 40):
        shard, v, w = rng.integers(0, 9, 3000), rng.integers(0, top, 3000).astype(np.uint64), rng.integers(0, top, 3000).astype(np.uint64)
        assert (lm._order(shard, v, w) == np.lexsort((w, v, shard))).all()
