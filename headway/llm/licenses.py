"""License scan with ordered signature rules, built from DataFrame functions alone.

Each text is folded A-Z to a-z.  Texts without any gate word are done after
one pass.  The others are normalised to their words joined by single spaces,
so that a signature is a regex over words.  A rule is tried only where its
keyword occurs.  Rules carry a priority; a detection is dropped when a
detection of better priority, or an equal one that is longer, contains its
word interval (ties: the earlier rule wins).  Three base phrases are counted at
all their places and never dropped.

Defined results: a null or empty text has no words, no labels, null first and
last words and score 0; repeated rows give repeated results; an empty table
gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and labels (fixed values).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Words of which at least one stands in every text that a rule can match.
GATES = ("licen", "copyright", "spdx", "public domain", "creative commons", "creativecommons", "warranty", "rights reserved",
         "redistribution", "copyleft", "gnu org", "opensource org", "cc by", "cc0", "permission is hereby", "attribution", "proprietary")

# Licences: label, SPDX identifier, names (regexes over words).
LICENSES = (
    ("mit", "mit", ("mit licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e", "massachusetts institute of technology licen[cs]e")),
    ("mit-0", "mit 0", ("mit no attribution( licen[cs]e)?", "mit zero licen[cs]e")),
    ("apache-1.1", "apache 1 1", ("apache software licen[cs]e (version )?1 1",)),
    ("apache-2.0", "apache 2 0", ("apache licen[cs]e( v| version)? ?2( 0)?", "apache software licen[cs]e( version)? 2( 0)?", "asl 2 0 licen[cs]e")),
    ("gpl-1.0", "gpl 1 0", ("(gnu )?general public licen[cs]e( gpl)?( v| version)? ?1( 0)?", "gnu gpl v ?1 licen[cs]e")),
    ("gpl-2.0", "gpl 2 0", ("(gnu )?general public licen[cs]e( gpl)?( v| version)? ?2( 0)?", "gnu gpl v ?2 licen[cs]e", "gplv2 licen[cs]e")),
    ("gpl-3.0", "gpl 3 0", ("(gnu )?general public licen[cs]e( gpl)?( v| version)? ?3( 0)?", "gnu gpl v ?3 licen[cs]e", "gplv3 licen[cs]e")),
    ("lgpl-2.0", "lgpl 2 0", ("(gnu )?library general public licen[cs]e( v| version)? ?2( 0)?", "lgplv2 licen[cs]e")),
    ("lgpl-2.1", "lgpl 2 1", ("(gnu )?lesser general public licen[cs]e( v| version)? ?2 1", "lgpl v ?2 1 licen[cs]e")),
    ("lgpl-3.0", "lgpl 3 0", ("(gnu )?lesser general public licen[cs]e( v| version)? ?3( 0)?", "lgplv3 licen[cs]e")),
    ("agpl-1.0", "agpl 1 0", ("affero general public licen[cs]e( v| version)? ?1( 0)?",)),
    ("agpl-3.0", "agpl 3 0", ("(gnu )?affero general public licen[cs]e( v| version)? ?3( 0)?", "agplv3 licen[cs]e")),
    ("bsd-0-clause", "0bsd", ("zero clause bsd licen[cs]e", "bsd zero clause licen[cs]e", "bsd 0 clause licen[cs]e")),
    ("bsd-1-clause", "bsd 1 clause", ("bsd 1 clause licen[cs]e",)),
    ("bsd-2-clause", "bsd 2 clause", ("bsd 2 clause licen[cs]e", "simplified bsd licen[cs]e", "freebsd licen[cs]e", "two clause bsd licen[cs]e")),
    ("bsd-3-clause", "bsd 3 clause", ("bsd 3 clause licen[cs]e", "new bsd licen[cs]e", "modified bsd licen[cs]e", "revised bsd licen[cs]e", "three clause bsd licen[cs]e")),
    ("bsd-4-clause", "bsd 4 clause", ("bsd 4 clause licen[cs]e", "original bsd licen[cs]e", "four clause bsd licen[cs]e")),
    ("mpl-1.0", "mpl 1 0", ("mozilla public licen[cs]e( v| version)? ?1 0",)),
    ("mpl-1.1", "mpl 1 1", ("mozilla public licen[cs]e( v| version)? ?1 1",)),
    ("mpl-2.0", "mpl 2 0", ("mozilla public licen[cs]e( v| version)? ?2 0",)),
    ("epl-1.0", "epl 1 0", ("eclipse public licen[cs]e( v| version)? ?1 0",)),
    ("epl-2.0", "epl 2 0", ("eclipse public licen[cs]e( v| version)? ?2 0",)),
    ("cddl-1.0", "cddl 1 0", ("common development and distribution licen[cs]e( v| version)?( 1 0)?",)),
    ("cpl-1.0", "cpl 1 0", ("common public licen[cs]e( v| version)? ?1 0",)),
    ("ipl-1.0", "ipl 1 0", ("ibm public licen[cs]e( v| version)? ?1 0",)),
    ("eupl-1.1", "eupl 1 1", ("european union public licen[cs]e( v| version)? ?1 1",)),
    ("eupl-1.2", "eupl 1 2", ("european union public licen[cs]e( v| version)? ?1 2",)),
    ("isc", "isc", ("isc licen[cs]e", "internet systems consortium licen[cs]e")),
    ("zlib", "zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e")),
    ("libpng", "libpng", ("libpng licen[cs]e", "png reference library licen[cs]e")),
    ("bsl-1.0", "bsl 1 0", ("boost software licen[cs]e( v| version)?( 1 0)?",)),
    ("busl-1.1", "busl 1 1", ("business source licen[cs]e( v| version)?( 1 1)?",)),
    ("artistic-1.0", "artistic 1 0", ("artistic licen[cs]e( v| version)? ?1 0",)),
    ("artistic-2.0", "artistic 2 0", ("artistic licen[cs]e( v| version)? ?2 0",)),
    ("wtfpl", "wtfpl", ("wtfpl licen[cs]e", "do what the fuck you want to public licen[cs]e")),
    ("unlicense", "unlicense", ("the unlicense", "released under the unlicense")),
    ("cc0-1.0", "cc0 1 0", ("cc0 1 0( universal)?", "creative commons zero( v?1 0)?", "cc0 public domain dedication")),
    ("cc-by-2.0", "cc by 2 0", ("creative commons attribution 2 0( \\w+)? licen[cs]e",)),
    ("cc-by-2.5", "cc by 2 5", ("creative commons attribution 2 5( \\w+)? licen[cs]e",)),
    ("cc-by-3.0", "cc by 3 0", ("creative commons attribution 3 0( \\w+)? licen[cs]e",)),
    ("cc-by-4.0", "cc by 4 0", ("creative commons attribution 4 0( international)?( public)? licen[cs]e",)),
    ("cc-by-sa-2.0", "cc by sa 2 0", ("creative commons attribution share ?alike 2 0( \\w+)? licen[cs]e",)),
    ("cc-by-sa-3.0", "cc by sa 3 0", ("creative commons attribution share ?alike 3 0( \\w+)? licen[cs]e",)),
    ("cc-by-sa-4.0", "cc by sa 4 0", ("creative commons attribution share ?alike 4 0( international)?( public)? licen[cs]e",)),
    ("cc-by-nc-3.0", "cc by nc 3 0", ("creative commons attribution non ?commercial 3 0( \\w+)? licen[cs]e",)),
    ("cc-by-nc-4.0", "cc by nc 4 0", ("creative commons attribution non ?commercial 4 0( international)?( public)? licen[cs]e",)),
    ("cc-by-nc-sa-3.0", "cc by nc sa 3 0", ("creative commons attribution non ?commercial share ?alike 3 0( \\w+)? licen[cs]e",)),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", ("creative commons attribution non ?commercial share ?alike 4 0( international)?( public)? licen[cs]e",)),
    ("cc-by-nd-3.0", "cc by nd 3 0", ("creative commons attribution no ?derivatives 3 0( \\w+)? licen[cs]e", "creative commons attribution no ?derivs 3 0( \\w+)? licen[cs]e")),
    ("cc-by-nd-4.0", "cc by nd 4 0", ("creative commons attribution no ?derivatives 4 0( international)?( public)? licen[cs]e",)),
    ("cc-by-nc-nd-3.0", "cc by nc nd 3 0", ("creative commons attribution non ?commercial no ?deriv(ative)?s 3 0( \\w+)? licen[cs]e",)),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", ("creative commons attribution non ?commercial no ?derivatives 4 0( international)?( public)? licen[cs]e",)),
    ("odbl-1.0", "odbl 1 0", ("open database licen[cs]e( v| version)?( 1 0)?",)),
    ("odc-by-1.0", "odc by 1 0", ("open data commons attribution licen[cs]e( v| version)?( 1 0)?",)),
    ("pddl-1.0", "pddl 1 0", ("public domain dedication and licen[cs]e( v| version)?( 1 0)?",)),
    ("gfdl-1.2", "gfdl 1 2", ("(gnu )?free documentation licen[cs]e( v| version)? ?1 2",)),
    ("gfdl-1.3", "gfdl 1 3", ("(gnu )?free documentation licen[cs]e( v| version)? ?1 3",)),
    ("ofl-1.1", "ofl 1 1", ("sil open font licen[cs]e( v| version)?( 1 1)?", "open font licen[cs]e( v| version)? ?1 1")),
    ("psf-2.0", "psf 2 0", ("python software foundation licen[cs]e( v| version)?( 2)?", "psf licen[cs]e( agreement)?")),
    ("python-2.0", "python 2 0", ("python licen[cs]e( v| version)? ?2( 0)?",)),
    ("php-3.01", "php 3 01", ("php licen[cs]e( v| version)?( 3 01)?",)),
    ("ruby", "ruby", ("ruby licen[cs]e",)),
    ("postgresql", "postgresql", ("postgresql licen[cs]e",)),
    ("ncsa", "ncsa", ("university of illinois ncsa open source licen[cs]e", "ncsa open source licen[cs]e")),
    ("ms-pl", "ms pl", ("microsoft public licen[cs]e",)),
    ("ms-rl", "ms rl", ("microsoft reciprocal licen[cs]e",)),
    ("upl-1.0", "upl 1 0", ("universal permissive licen[cs]e( v| version)?( 1 0)?",)),
    ("osl-3.0", "osl 3 0", ("open software licen[cs]e( v| version)? ?3 0",)),
    ("afl-3.0", "afl 3 0", ("academic free licen[cs]e( v| version)? ?3 0",)),
    ("qpl-1.0", "qpl 1 0", ("q public licen[cs]e( v| version)?( 1 0)?",)),
    ("openssl", "openssl", ("openssl licen[cs]e",)),
    ("curl", "curl", ("curl licen[cs]e",)),
    ("beerware", "beerware", ("beerware licen[cs]e", "beer ware licen[cs]e")),
    ("sspl-1.0", "sspl 1 0", ("server side public licen[cs]e( v| version)?( 1)?",)),
    ("elastic-2.0", "elastic 2 0", ("elastic licen[cs]e( v| version)?( 2 0)?",)),
    ("mulan-psl-2.0", "mulanpsl 2 0", ("mulan permissive software licen[cs]e( v| version)? ?2",)),
    ("cecill-2.1", "cecill 2 1", ("cecill free software licen[cs]e( agreement)?( v| version)?( 2 1)?", "cecill licen[cs]e")),
    ("blueoak-1.0.0", "blueoak 1 0 0", ("blue oak model licen[cs]e( 1 0 0)?",)),
    ("openrail", "openrail", ("(bigscience )?openrail( m)? licen[cs]e", "responsible ai licen[cs]e")),
    ("llama-community", "llama", ("llama( \\d)* community licen[cs]e( agreement)?",)),
)

# Notices that name no licence in full: label, priority, keyword, regex.
NOTICES = (
    ("mit", 20, "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", 20, "redistribution and use in source", "redistribution and use in source and binary forms with or without modification"),
    ("apache-2.0", 20, "you may not use this file except", "you may not use this file except in compliance with the licen[cs]e"),
    ("gpl", 20, "free software", "is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", 15, "lesser general public", "(gnu )?lesser general public licen[cs]e"),
    ("agpl", 15, "affero general public", "(gnu )?affero general public licen[cs]e"),
    ("gfdl", 30, "free documentation", "(gnu )?free documentation licen[cs]e"),
    ("gpl", 30, "general public licen", "(gnu )?general public licen[cs]e"),
    ("apache", 30, "apache", "apache( software)? licen[cs]e"),
    ("bsd", 30, "bsd", "bsd( style)? licen[cs]e"),
    ("mpl", 30, "mozilla public", "mozilla public licen[cs]e"),
    ("epl", 30, "eclipse public", "eclipse public licen[cs]e"),
    ("artistic", 30, "artistic", "artistic licen[cs]e"),
    ("cc-by", 40, "cc by", "licen[cs]ed under (a )?cc by( \\d \\d)?"),
    ("cc-by-sa", 35, "cc by sa", "cc by sa( \\d \\d)?"),
    ("cc-by-nc", 35, "cc by nc", "cc by nc( \\d \\d)?"),
    ("cc-by-nd", 35, "cc by nd", "cc by nd( \\d \\d)?"),
    ("cc-by-nc-sa", 33, "cc by nc sa", "cc by nc sa( \\d \\d)?"),
    ("cc-by-nc-nd", 33, "cc by nc nd", "cc by nc nd( \\d \\d)?"),
    ("cc", 50, "creative commons", "(licen[cs]ed under a )?creative commons( attribution)?( licen[cs]e)?"),
    ("public-domain", 50, "public domain", "(is|are|placed|released|dedicated)( in| into| to)?( the)? public domain"),
    ("proprietary", 60, "rights reserved", "all rights reserved"),
    ("proprietary", 55, "proprietary", "proprietary and confidential|proprietary licen[cs]e"),
    ("copyright", 80, "copyright", "copyright( c)?( \\d\\d\\d\\d)+"),
    ("unknown-license", 90, "licen", "(is|are|be) licen[cs]ed under( the)?( terms of)?|under the terms of the( \\w+)? licen[cs]e|see the licen[cs]e( file)?"),
)


def rules() -> list[tuple[str, int, str, str]]:
    """``(label, priority, keyword, regex)``, best priority first; the regexes run over space-joined words."""
    found = []
    for label, spdx, names in LICENSES:
        found.append((label, 5, "spdx", f"spdx licen[cs]e identifier {spdx}( only| or later)?"))
        found.append((label, 8, spdx, f"(?:licen[cs]e|licen[cs]ed under)( is| the)? {spdx}( only| or later)?"))
        for name in names:
            # the longest literal start is the keyword that must occur for the regex to be tried
            literal = name.removeprefix("(gnu )?")
            stem = literal
            for sign in "([\\?|":
                stem = stem.split(sign)[0]
            if stem != literal and literal[len(stem)] == "?":
                stem = stem[:-1]
            key = stem.strip() or "licen"
            found.append((label, 10, key, name))
            found.append((label, 9, key, f"(?:released|distributed|available|provided|licen[cs]ed) under( the)?( terms of the)? {name}"))
    found += list(NOTICES)
    return sorted(found, key=lambda r: r[1])


def _text() -> Column:
    return F.translate(F.coalesce(F.col("text"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _numbered(joined: Column) -> Column:
    """' w0 w1 ... ' with every word's number before it: ' 0:w0 1:w1 ... '."""
    words = F.split(F.trim(joined), " ")
    return F.concat(F.lit(" "), F.array_join(F.transform(words, lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " "), F.lit(" "))


def _places(numbered: Column, regex: Column) -> Column:
    """Word intervals ``struct<a, b>`` of all matches of ``regex`` in a numbered text: a match tells its first
    word's number itself, and its spaces are its words."""
    # a space of the rule stands for a space and the next word's number, one that may be missing for both or none
    body = F.replace(F.replace(F.replace(regex, F.lit(" ?"), F.lit("\x01")), F.lit(" "), F.lit(r" \d+:")), F.lit("\x01"), F.lit(r"(?: \d+:)?"))
    pattern = F.concat(F.lit(r" \d+:(?:"), body, F.lit(")(?= )"))
    def span(m):
        a = F.regexp_extract(m, r"^ (\d+):", 1).cast("int")
        return F.struct(a.alias("a"), (a + F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit("")))).alias("b"))
    return F.transform(F.regexp_extract_all(numbered, pattern, F.lit(0)), span)


def _beats(e: Column, d: Column) -> Column:
    """Whether detection ``e`` holds ``d`` and goes before it."""
    length = lambda x: -x["nb"] - x["a"]
    return ((e["a"] <= d["a"]) & (e["nb"] <= d["nb"])
            & ((e["p"] < d["p"]) | ((e["p"] == d["p"]) & ((length(e) > length(d)) | ((length(e) == length(d)) & (e["i"] < d["i"]))))))


def _survivors(text: DataFrame) -> DataFrame:
    """``text`` with ``kept``, the detections of ``found`` that no other one beats.

    In the order of start and falling end whatever holds a detection stands
    before it, and starts less than the longest detection's length before it.
    A detection is held against so many before it as reach back that far
    anywhere in the text: a number found by one pass over the sorted array.
    """
    order = F.sort_array(F.transform("found", lambda x: F.struct(x["a"].alias("a"), (-x["b"]).alias("nb"), x["p"].alias("p"), x["i"].alias("i"),
                                                                 x["label"].alias("label"))))
    text = text.withColumn("ordered", order)
    text = text.withColumn("longest", F.array_max(F.transform("ordered", lambda x: -x["nb"] - x["a"])))
    n = F.size("ordered")

    def reaches(k: int) -> Column:
        near = F.exists(F.sequence(F.lit(k + 1), F.greatest(n, F.lit(k + 1))), lambda j: (j <= n) & (
            F.get("ordered", j - 1)["a"] - F.get("ordered", j - 1 - F.lit(k))["a"] < F.col("longest")))
        return (n <= k) | ~F.coalesce(near, F.lit(False))

    window = n
    for k in (4096, 1024, 256, 64):
        window = F.when(reaches(k), F.lit(k)).otherwise(window)
    text = text.withColumn("window", window)
    kept = F.filter("ordered", lambda d, j: ~F.exists(
        F.slice("ordered", F.greatest(j - F.col("window") + 1, F.lit(1)), F.least(j, F.col("window"))), lambda e: _beats(e, d)))
    back = F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p"), x["label"].alias("label"), x["a"].alias("a"), (-x["nb"]).alias("b")))
    return text.withColumn("kept", back)


def scan(docs: DataFrame) -> DataFrame:
    """Base counts and labels of every document, with its surviving detections."""
    table = rules()
    rule_set = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), F.lit(label).alias("label"),
                                  F.lit(k).alias("k"), F.lit(r).alias("r")) for i, (label, p, k, r) in enumerate(table)])
    text = docs.select("doc_id", _text().alias("t"))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | (F.contains("t", F.lit(g.split(" ")[0])) if " " in g else F.contains("t", F.lit(g)))
    text = text.select("doc_id", F.regexp_count("t", F.lit(WORD)).cast("long").alias("n_words"),
                       F.when(gate, F.concat(F.lit(" "), F.regexp_replace("t", GAP, " "), F.lit(" "))).alias("w"))
    # a text's own outer gaps and the added spaces make at most one space at each end
    joined = F.regexp_replace("w", "^ +| +$", " ")
    text = text.select("doc_id", "n_words", joined.alias("w"))
    text = text.withColumn("numbered", F.when(F.col("w").isNotNull(), _numbered(F.col("w"))))
    def named(label: str):
        return lambda s: F.struct(F.lit(label).alias("label"), s["a"].alias("a"), s["b"].alias("b"))

    base = F.when(F.col("w").isNotNull(), F.concat(*[
        F.transform(_places(F.col("numbered"), F.lit(phrase)), named(label)) for phrase, label in BASE]))
    keyed = F.filter(rule_set, lambda r: F.contains(F.col("w"), r["k"]))
    found = F.when(F.col("w").isNotNull(), F.flatten(F.transform(keyed, lambda r: F.transform(
        _places(F.col("numbered"), r["r"]), lambda s: F.struct(
            r["i"].alias("i"), r["p"].alias("p"), r["label"].alias("label"), s["a"].alias("a"), s["b"].alias("b"))))))
    return _survivors(text.withColumn("base", base).withColumn("found", found)).select("doc_id", "n_words", "base", "kept")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of ``op3``.  ``score`` is the share of certainty: 1 for an
    SPDX tag or full notice, falling with the best surviving priority."""
    none = F.lit([]).cast("array<string>")
    base_labels = F.coalesce(F.transform("base", lambda s: s["label"]), none)
    labels = F.coalesce(F.transform("kept", lambda s: s["label"]), none)
    best = F.array_min(F.transform("kept", lambda s: s["p"]))
    return scan(docs).select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["a"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["a"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, labels))), ",").alias("labels"),
        F.greatest(F.when(F.size("base") > 0, F.lit(0.7)).otherwise(F.lit(0.0)),
                   F.coalesce(F.lit(1.0) - best / 100.0, F.lit(0.0))).cast("double").alias("score"),
        F.coalesce(F.size("kept"), F.lit(0)).cast("long").alias("n_detections"))
