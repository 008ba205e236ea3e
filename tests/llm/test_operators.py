"""Operators without SQL against brute force, planted cases or held-out accuracy (sf0.001 and sf0.01)."""

import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import decontam, html, jaccard, langid, licenses, lines, mixing, sharding
from headway.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- op3

def test_license_base_places(spark):
    docs = table(spark, MORE, "documents")
    extra = spark.createDataFrame([(-1, "MIT License\nmit-license x mit license"), (-2, "the Apache  License; GNU General\tPublic License")],
                                  "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    got = {r["doc_id"]: r for r in licenses.digest(both).collect()}
    some = 0
    for row in both.collect():
        words = WORD.findall(fold(row["text"]))
        places, labels = [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[row["doc_id"]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
        some += bool(places)
    assert some > 10


def plain_detections(text):
    """The rules by Python's regexes, with quadratic suppression."""
    joined = " " + " ".join(WORD.findall(fold(text))) + " "
    if not any(g.split(" ")[0] in fold(text) for g in licenses.GATES):
        return []
    found = []
    for i, (label, p, key, regex) in enumerate(licenses.rules()):
        if key in joined:
            for m in re.finditer(f" (?:{regex})(?= )", joined, re.A):
                a = joined[:m.start()].count(" ")
                found.append((i, p, label, a, a + m[0].count(" ")))
    beats = lambda e, d: (e[3] <= d[3] and e[4] >= d[4] and (
        e[1] < d[1] or e[1] == d[1] and (e[4] - e[3], -e[0]) > (d[4] - d[3], -d[0])))
    return sorted(d for d in found if not any(beats(e, d) for e in found))


def test_license_detections(spark):
    texts = ["Licensed under CC BY-NC 4.0. All rights reserved.", "Copyright (c) 2019 2020 X. Licensed under the GNU Lesser General Public License v2.1",
             "SPDX-License-Identifier: BSD-3-Clause; see the LICENSE file", "Permission is hereby granted, free of charge, to any person obtaining a copy",
             "under the terms of the Apache License, Version 2.0 or the MIT license", "nothing here", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(table(spark, SF, "documents").select("doc_id", "text").where("doc_id > 9"))
    for row, r in zip(docs.orderBy("doc_id").collect(), licenses.scan(docs).orderBy("doc_id").collect()):
        assert sorted(tuple(d) for d in r["kept"] or []) == plain_detections(row["text"]), row["text"][:80] if row["text"] else None


def test_hundreds_of_rules_compile():
    found = licenses.rules()
    assert len(found) > 300 and all(re.compile(r) for *_, r in found)
    assert [p for _, p, _, _ in found] == sorted(p for _, p, _, _ in found)


# An example of every notice, in their order.
NOTICE_EXAMPLES = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "you may not use this file except in compliance with the License.",
    "It is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "GNU Lesser General Public License", "the Affero General Public License", "GNU Free Documentation License", "GNU General Public License",
    "Apache Software License", "a BSD-style license", "Mozilla Public License", "Eclipse Public License", "the Artistic License",
    "licensed under a CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC 4.0", "CC BY-ND 4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0",
    "Creative Commons", "released into the public domain", "All rights reserved.", "a proprietary license", "Copyright (c) 2019, 2020 Acme Inc",
    "see the LICENSE file")


def example(regex):
    """A text of a licence rule: optional parts left out, the first of alternatives."""
    text = regex.replace("[cs]", "c").replace(" ?", " ").replace("( \\d)*", "").replace("v?", "")
    text = re.sub(r"\((?!\?:)[^()]*\)\?", "", text).replace("(?:", "(")
    return re.sub(r"\(([^()|]*)[^()]*\)", r"\1", text)


def test_every_rule_detects_an_example(spark):
    found = licenses.rules()
    texts = [dict(zip(licenses.NOTICES, NOTICE_EXAMPLES, strict=True)).get(rule) or example(rule[3]) for rule in found]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: {d["label"] for d in r["kept"] or []} for r in licenses.scan(docs).collect()}
    assert [(rule, texts[i]) for i, rule in enumerate(found) if rule[0] not in got[i]] == []


def test_detections_need_no_gate(spark, monkeypatch):
    """The gate drops no case of a rule: the plain detections run without it."""
    texts = ["Proprietary and confidential. Do not distribute.", "MIT No Attribution", "released under MIT no attribution", "plain text",
             *(example(rule[3].split("|")[-1]) for rule in licenses.NOTICES)]
    docs = spark.createDataFrame(list(enumerate(texts, 1_000_000)), "doc_id long, text string").union(table(spark, SF, "documents").select("doc_id", "text"))
    rows = docs.collect()
    got = {r["doc_id"]: r["kept"] for r in licenses.scan(docs).collect()}
    assert {d["label"] for d in got[1_000_000]} == {"proprietary"} and got[1_000_003] is None
    monkeypatch.setattr(licenses, "GATES", ("",))
    assert [r["text"][:80] for r in rows if sorted(tuple(d) for d in got[r["doc_id"]] or []) != plain_detections(r["text"])] == []


def test_copyright_notices(spark):
    texts = ["Copyright 2020 Acme Inc", "copyright (C) 2020, 2021 Acme", "Copyright 2020", "copyright law of 2020"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.digest(docs).collect()}
    assert [got[i]["labels"] for i in range(4)] == ["copyright"] * 3 + [""]
    assert [round(got[i]["score"], 6) for i in range(4)] == [0.2] * 3 + [0.0]


# ---- op7

def test_shards_are_level_and_keep_groups(spark):
    docs = table(spark, MORE, "documents")
    rows = sharding.digest(docs, 8).toPandas().merge(docs.toPandas()[["doc_id", "text"]], on="doc_id")
    assert (rows["size"] == [len(t.encode()) + 16 for t in rows["text"]]).all()
    assert (rows["text_crc32"] == [zlib.crc32(t.encode()) for t in rows["text"]]).all()
    load = rows.groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() / load.mean() < 1.02
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    spread = rows.groupby("text")["shard"].nunique()
    groups = rows.groupby("text").agg(size=("size", "sum"), n_tokens=("n_tokens", "sum"), rows=("doc_id", "size"))
    quarter = groups.sum() / 8 / sharding.PARTS_PER_SHARD * sharding.WHOLE_PARTS
    small = (groups <= quarter).all(axis=1)
    assert (spread[small] == 1).all()


def test_pack_takes_the_highest_dot_product():
    items = np.array([[4.0, 4, 1], [3, 1, 1], [2, 2, 2], [1, 1, 1], [1, 1, 1]])
    share = items / items.sum(axis=0)
    capacity, want = np.full((2, 3), 0.5), np.zeros(5, int)
    for i in sorted(range(5), key=lambda i: (-share[i].max(), i)):
        want[i] = int(np.argmax([c @ (share[i] * sharding.WEIGHTS) for c in capacity]))
        capacity[want[i]] -= share[i]
    assert (sharding.pack(items, 2) == want).all()


# ---- op9

def test_pages_give_their_articles(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    from html import unescape
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        article = re.sub(r'<div class="ad">.*?</div>|<script.*?</script>|<style.*?</style>|<!--.*?-->', " ", article, flags=re.S)
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br\s*/?>", " ", b))).split())
                  for b in re.split(r"</?(?:p|h1|h2|h3|ul|li|div|blockquote)[^>]*>", article)]
        assert got[row["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_short_pages_lose_a_long_template(spark):
    notice = "<div><p>" + "a long notice of the site " * 20 + "</p></div>"
    rows = [(i, f"https://site.example/{i}", f"<article><h1>T{i}</h1><p>short {i}</p>{notice}</article>") for i in range(30)]
    rows.append((99, "https://site.example/99", f"<article>{notice}</article>"))
    got = {r["page_id"]: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all((got[i]["text"], got[i]["n_template_blocks"]) == (f"T{i}\n\nshort {i}", 1) for i in range(30))
    assert got[99]["text"].startswith("a long notice") and got[99]["n_template_blocks"] == 0


def test_sections_of_a_host_have_templates_of_their_own(spark):
    rows = []
    for i in range(120):
        more = "<p>as said before</p>" if i % 10 == 0 else ""                # on 12 pages, too few for a template of this host
        rows.append((i, f"https://site.example/{i}", f"<article><h1>T{i}</h1><p>text {i}</p>{more}<div><p>notice of section {i % 3}</p></div></article>"))
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"T{i}\n\ntext {i}" + ("\n\nas said before" if i % 10 == 0 else "") for i in range(120)}


# ---- op4

def test_language_by_text_alone_on_held_out(spark):
    docs = table(spark, MORE, "documents")
    held = docs.where("doc_id % 4 = 0")
    model = langid.fit(docs.where("doc_id % 4 <> 0"))
    rows = langid._documents(held.withColumn("lang", F.lit(None).cast("string")), F.struct("doc_id", "lang").alias("k"))
    found = langid.identify(rows, model).select(F.col("key.doc_id").alias("doc_id"), "text_lang").join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["text_lang"] == r["lang"] for r in found) / len(found) > 0.97


def test_evidence_outweighs_a_vague_text(spark):
    texts = {"en": "the cat and the dog with the hat", "fr": "le chat et le chien avec le chapeau"}
    rows = [(i, texts[lang], lang, f"{lang}.example", lang) for lang in texts for i in range(30)]
    rows += [(100, "zz zz", None, "fr.example", "fr"), (101, "zz zz", None, "en.example", "en"), (102, texts["fr"], "en", "en.example", "en")]
    frame = spark.createDataFrame(rows, "key long, text string, declared string, host string, suffix string")
    model = langid.fit(frame.where("key < 100").selectExpr("text", "declared as lang"))
    got = {r["key"]: r["lang"] for r in langid.identify(frame, model).where("key >= 100").collect()}
    assert got == {100: "fr", 101: "en", 102: "fr"}


# ---- op1

def test_rates_meet_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(10, 500, 400)
    frame = spark.createDataFrame([(int(i), int(k), [float(x) for x in v]) for i, (k, v) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    classifier = mixing.Classifier(["a", "b", "c"], np.zeros(0, np.uint64), np.zeros(1, bool), np.zeros((5, 3)))
    mix = mixing.fit_rates(frame, classifier, {"a": 0.5, "b": 0.4, "c": 0.1}, total=float(n.sum()), max_steps=200)
    rate = mixing.replay(p, mix.steps, mix.most)
    assert (rate >= 0).all()
    assert np.allclose((n * rate) @ p / n.sum(), [0.5, 0.4, 0.1], atol=0.005)
    capped = mixing.fit_rates(frame, classifier, {"a": 1.0}, most=1.0)
    assert mixing.replay(p, capped.steps, 1.0).max() <= 1.0


def test_fit_runs_to_its_end(spark):
    """Overlapping domains, production parameters: no rate can move without a greater distance from the targets."""
    rng = np.random.default_rng(3)
    names, share = ["quality_0", "quality_1", "toxic"], np.array([0.45, 0.5, 0.05])
    true = rng.choice(3, 3000, p=share)
    for gap in (1.0, 2.0):
        p = mixing.softmax(np.log(share) + gap * (rng.normal(0, 1, (3000, 3)) + gap * np.eye(3)[true]))
        n = rng.integers(10, 500, 3000)
        frame = spark.createDataFrame([(i, int(k), [float(x) for x in v]) for i, (k, v) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
        classifier = mixing.Classifier(names, np.zeros(0, np.uint64), np.zeros(1, bool), np.zeros((5, 3)))
        for most in (1.0, float("inf")):
            mix = mixing.fit_rates(frame, classifier, mixing.WEIGHTS, most=most)
            rate = mixing.replay(p, mix.steps, most)
            assert np.allclose((n * rate) @ p, mix.reached)
            slope = p @ ((mix.reached - mix.targets) / mix.tokens)
            assert np.abs(slope[(rate > 0) & (rate < most)]).max(initial=0) < 1e-3
            assert slope[rate == 0].min(initial=0) > -1e-3 and slope[rate >= most].max(initial=0) < 1e-3


def test_classifier_finds_the_labels(spark):
    docs, labels = table(spark, MORE, "documents"), table(spark, MORE, "labels")
    c = mixing.fit(docs, labels)
    truth = labels.select("doc_id", mixing.domain().alias("d"))
    rows = mixing.posteriors(docs, c).join(truth, "doc_id").collect()
    hits = Counter((r["d"], c.domains[int(np.argmax(r["p"]))]) for r in rows)
    assert sum(n for (a, b), n in hits.items() if a == b) / len(rows) > 0.85


# ---- pipeline

def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    benchmark = table(spark, SF, "benchmark")
    columns, before = docs.columns, docs
    leaked = {r["doc_id"] for r in decontam.search(docs, benchmark).collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.write_table(stage(spark, before, SF), name)
        ids, kept = [{r["doc_id"] for r in x.select("doc_id").collect()} for x in (before, after)]
        assert kept <= ids
        if name == "language":
            assert kept == ids
        if name == "near_duplicates":
            groups = defaultdict(set)
            for r in jaccard.join(before).collect():
                groups[r["component_id"]].add(r["doc_id"])
            assert kept == set(groups)
        if name == "decontaminate":
            assert kept == ids - leaked
        if name == "mix":
            rate = {r["doc_id"]: r["rate"] for r in mixing.rates(before, table(spark, SF, "labels"), most=1.0).collect()}
            assert all(d in kept for d in ids if rate[d] == 1) and not any(rate[d] == 0 for d in kept)
        assert after.columns == columns if name != "shard" else kept == ids
        before = after


def test_queries_read_whole_tables(spark):
    n = table(spark, SF, "documents").count()
    for name in ("op1_mixing", "op3_license_scan", "op7_sharding"):
        assert QUERIES[name](spark, SF).count() == n


def test_language_stage_rejects_what_is_no_labelled_language(spark):
    """Junk letters and languages without a label go, every document of a labelled language stays."""
    docs = table(spark, MORE, "documents")
    rng = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    junk = [" ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(80)) for _ in range(20)]
    foreign = ["Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5, "Жил старик со своею старухой у самого синего моря. " * 5,
               "私は猫である。名前はまだ無い。どこで生れたか頓と見当がつかぬ。" * 6, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και το φως. " * 6]
    extra = [(10**9 + i, t, None, "web", len(t)) for i, t in enumerate(junk + foreign)]
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    kept = {r["doc_id"] for r in langid.accepted(both).select("doc_id").collect()}
    before = {r["doc_id"] for r in docs.where("text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert before <= kept
    assert not any(i in kept for i, *_ in extra)


def test_rare_labels_are_no_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 4)
    rows = [(f"the one and the other {i}", "en") for i in range(30)] + [(f"le chat et la souris {i}", "fr") for i in range(20)]
    rows += [(f"x{i} y", "q" + "abcdefghij"[i] * 2) for i in range(10)]
    assert langid.fit(spark.createDataFrame(rows, "text string, lang string"))[0] == ["en", "fr"]


def test_rates_tell_whether_the_fit_converged(spark):
    rows = mixing.rates(table(spark, SF, "documents"), table(spark, SF, "labels"), most=1.0).select("domains", "targets", "reached", "converged").distinct().collect()
    assert len(rows) == 1 and rows[0]["converged"] and len(rows[0]["domains"]) == len(rows[0]["targets"]) == len(rows[0]["reached"])


def _seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def test_long_texts_full_of_detections_take_linear_time(spark):
    """100,000 detections in one text: a doubled text takes about twice the time, and every detection is there."""
    def text(n):
        return "MIT License and GNU Lesser General Public License v2.1 or copyright 2020 " * n
    def run(n):
        df = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
        r = licenses.digest(df).first()
        assert (r["n_words"], r["n_base"], r["n_detections"]) == (13 * n, 2 * n, 3 * n)
    run(50)
    short, long = _seconds(lambda: run(16_667)), _seconds(lambda: run(33_334))
    assert long < 3.5 * short + 5


def test_detections_in_a_long_text_equal_plain_python(spark):
    rng = np.random.default_rng(5)
    pieces = ["mit license", "licensed under the apache license version 2 0", "gnu general public license v3", "creative commons", "see the license file",
              "copyright c 2019 2020", "all rights reserved", "words", "of no meaning", "spdx license identifier mit or later"]
    text = " ".join(rng.choice(pieces, 400))
    got = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["kept"]
    assert sorted(tuple(d) for d in got) == plain_detections(text)


def test_a_long_text_full_of_shared_lines_takes_linear_time(spark):
    def run(n):
        rows = [(i, "\n".join(f"line {j}" if j % 4 else f"own {i} {j}" for j in range(n)), f"s{i}") for i in range(11)]
        got = {r["doc_id"]: r for r in lines.clean(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()}
        shared = n - (n + 3) // 4
        assert all((r["n_lines"], r["n_removed"]) == (n, shared) for r in got.values())
        assert got[3]["text"] == "\n".join(f"own 3 {j}" for j in range(0, n, 4))
    run(100)
    short, long = _seconds(lambda: run(12_000)), _seconds(lambda: run(24_000))
    assert long < 3.5 * short + 5
