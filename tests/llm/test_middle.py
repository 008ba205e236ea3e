"""Fill-in-the-middle: kernels against plain Python, exact round trip, slices, defined results."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from headway.llm import middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(text, draws):
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 50:
        return n, "plain", None, None, text
    if draws[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def draws_of(doc_id):
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]


def messy(n=600):
    r = random.Random(7)
    fixed = ["", " ", "a", " a", "a ", "  a  b\n", "é 你好 x  ß ", "x<P>y z", "a < P<S", "one two three <", "\x00 a\x00b \x1c c", "a\u0085b　c"]
    return fixed + ["".join(r.choice(" \t\nab<PSM>é你\x0b") for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_kernels_equal_plain_python():
    texts, r = messy(), random.Random(3)
    draws = np.array([[r.getrandbits(32) for _ in range(4)] for _ in texts])
    out = middle.rearranged(pa.array([t.encode() for t in texts], pa.large_binary()), draws, 50, 80)
    columns = ("n", "form", "prefix_chars", "middle_chars")
    for i, text in enumerate(texts):
        assert (*(out[c][i].as_py() for c in columns), out["output"][i].as_py().decode()) == plain_version(text, [int(d) for d in draws[i]])
    assert {out["form"][i].as_py() for i in range(len(texts))} == {"plain", "psm", "spm"}
    assert [x.as_py().decode() for x in middle.restored(out["output"], out["form"])] == texts


@pytest.mark.parametrize("slice_bytes", [1, 1 << 20])
def test_whole_table(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(middle, "SLICE_BYTES", slice_bytes)
    texts = [None, *messy(150), "long " * 60_000, "x" * 300_000]
    rows = [(i if i != 5 else None, t, 1, "f") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string").repartition(3)
    got = sorted((tuple(r) for r in middle.digest(docs).collect()), key=str)
    want = []
    for doc_id, text, _, _ in rows:
        n, form, prefix, mid, output = plain_version(text or "", draws_of(doc_id))
        want.append((doc_id, n, form, prefix, mid, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert middle.digest(docs.where("false")).count() == 0
    assert middle.rearrange(docs, rate=0).where("form <> 'plain'").count() == 0
    assert middle.rearrange(docs, rate=100, spm_share=0).where("form = 'spm'").count() == 0
