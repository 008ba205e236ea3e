"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as log probabilities for every language of
the labelled table: the text under a byte-trigram model per language (tempered
to ``TEXT_WEIGHT`` observations, since neighbouring trigrams depend on each
other), the declared language, and a prior of the host.  Host priors come from
grouped aggregation of the per-document posteriors, smoothed hierarchically:
host towards address suffix, suffix towards the whole corpus.  A document does
not count in its own prior.

The trigram models are fitted on a sample of at most about ``SAMPLE`` labelled
rows; everything else covers all rows.  Languages are the labels that hold at
least one in ``MOST_LANGUAGES`` of that sample, so there are never more.

The test is open: a text is also rejected when its mean log likelihood per
trigram lies ``SPREAD`` below what is typical of each language (its sample's
mean, read off the model), with ``SHORT`` / sqrt(trigrams) allowed on top.  That
takes languages without a label and strings of letters that are no language;
texts of a labelled language with numbers, codes or capitals stay.

Defined results: null and empty texts, and texts without a letter, have no
language and are rejected; without a declared language, host or suffix that
evidence is left out; a declared language that is none of the known ones is no
evidence; equal rows get equal results; ties go to the first language in
order; without any labelled row every text is rejected; an empty table gives
no rows; further columns are ignored by ``identify`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text
from .packing import slices
from .store import ship, write_table

SAMPLE = 20_000          # labelled rows that the trigram models are fitted on
BUCKETS = 1 << 15
TEXT_WEIGHT = 60.0       # trigrams that a whole text counts as, at most
DECLARED_TRUST = 0.9     # chance that a declared language is the text's
PRIOR_WEIGHT = 20.0      # documents that the parent's prior counts as
ACCEPT = 0.5             # least posterior of an accepted document
SPREAD, SHORT = 3.5, 8.0 # nats per trigram below the typical value of a language
MOST_LANGUAGES = 500
_SLICE = 1 << 20

# Bytes that end a word become spaces, A-Z is folded.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128][~text.PLAIN[:128]] = 32
_FOLD[ord("0"):ord("9") + 1] = 32
_FOLD[ord("A"):ord("Z") + 1] += 32


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of every byte trigram with a letter in its middle, and their offsets per row."""
    buf, offsets = text.text_bytes(column)
    padded = np.full(len(buf) + 2, 32, np.uint32)
    padded[1:-1] = _FOLD[buf]
    middle = padded[1:-1]
    before, after = padded[:-2].copy(), padded[2:].copy()
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    before[inner], after[inner - 1] = 32, 32                      # rows do not see each other
    mixed = (before * np.uint32(0x9E3779B1) + middle * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    letter = middle != 32
    at = np.append(0, np.cumsum(letter))[offsets]
    return (mixed[letter] * np.uint32(0x27D4EB2F)) >> np.uint32(17), at


def _language(c: Column) -> Column:
    """Primary subtag in lower case; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*([A-Za-z]{2,8})(?:[-_].*)?\s*$", 1)), F.lit(""))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities per trigram bucket, from ``text, lang``."""
    ship(labelled.sparkSession)
    rows = labelled.select("text", _language(F.col("lang")).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    one_in = max(1, -(-rows.count() // sample))
    rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0)
    held = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    least = -(-(held.agg(F.sum("n")).first()[0] or 0) // MOST_LANGUAGES)
    known = [r["lang"] for r in held.where(F.col("n") >= least).select("lang").collect()]         # at most MOST_LANGUAGES rows
    rows = rows.where(F.col("lang").isin(known))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found, at = trigrams(part["text"])
                for lang, a, b in zip(part["lang"].to_pylist(), at[:-1], at[1:]):
                    total[lang] = total.get(lang, 0) + np.bincount(found[a:b], minlength=BUCKETS)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "counts": [c.astype(np.int64).tobytes() for c in total.values()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [sum(np.frombuffer(c, np.int64) for c in pdf["counts"]).tobytes()]})

    schema = "lang string, counts binary"
    found = sorted(rows.mapInArrow(count, schema).groupBy("lang").applyInPandas(merge, schema).collect())   # a row per language
    if not found:
        return [], np.zeros((0, BUCKETS), np.float32)
    counts = np.stack([np.frombuffer(r["counts"], np.int64) for r in found]) + 0.5
    return [r["lang"] for r in found], np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """Adds ``lang, posterior, text_lang, accepted`` to ``key, text, declared, host, suffix``; drops the text."""
    languages, weights = model
    n_langs = len(languages)
    shared = rows.sparkSession.sparkContext.broadcast(weights)       # BUCKETS floats per language

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found, at = trigrams(part["text"])
                n = np.diff(at)
                out = np.zeros((part.num_rows, len(weights)))
                some = np.flatnonzero(n)
                if len(some):
                    for k, w in enumerate(weights):
                        out[some, k] = np.add.reduceat(w[found], at[some], dtype=np.float64)
                    out[some] *= np.minimum(1.0, TEXT_WEIGHT / n[some])[:, None]
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["declared"], part["host"], part["suffix"], pa.array(n, pa.int64()),
                     pa.array(list(out), pa.list_(pa.float64()))],
                    names=["key", "declared", "host", "suffix", "n_letters", "loglik"])

    key_type = rows.schema["key"].dataType.simpleString()
    rows = rows.select("key", "text", _language(F.col("declared")).alias("declared"), "host", "suffix")
    scored = rows.mapInArrow(likelihoods, f"key {key_type}, declared string, host string, suffix string, n_letters long, loglik array<double>")
    typical = (np.exp(weights.astype(np.float64)) * weights).sum(axis=1) if n_langs else np.zeros(0)
    known = F.array(*[F.lit(x) for x in languages]).cast("array<string>")
    doubt = (1 - DECLARED_TRUST) / max(1, n_langs - 1)
    declared = F.when(F.array_contains(known, F.col("declared")), F.transform(
        known, lambda x: F.when(x == F.col("declared"), F.lit(float(np.log(DECLARED_TRUST)))).otherwise(F.lit(float(np.log(doubt)) if n_langs > 1 else 0.0)))
    ).otherwise(F.transform(known, lambda _: F.lit(0.0)))
    scored = write_table(scored.withColumn("evidence", F.zip_with("loglik", declared, lambda a, b: a + b)), "langid-evidence")
    if not n_langs:
        none = F.lit(None).cast("string")
        return scored.select("key", none.alias("lang"), F.lit(0.0).alias("posterior"), none.alias("text_lang"), F.lit(False).alias("accepted"))

    def softmax(c: Column) -> Column:
        top = F.array_max(c)
        e = F.transform(c, lambda x: F.exp(x - top))
        return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))

    # Texts without letters take no part in priors.
    own = scored.withColumn("own", F.when(F.col("n_letters") > 0, softmax(F.col("evidence"))))

    def total(frame: DataFrame, *by: str) -> DataFrame:
        some = frame.where(F.col("own").isNotNull() & F.col(by[0]).isNotNull()) if by else frame.where(F.col("own").isNotNull())
        return some.groupBy(*by).agg(F.array(*[F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)) for i in range(n_langs)]).alias("sums"))

    everywhere = np.array(total(own).first()["sums"])
    corpus = (everywhere + 1.0) / (everywhere.sum() + n_langs)
    hosts = write_table(total(own, "host").withColumnRenamed("sums", "host_sums"), "langid-hosts")
    suffixes = write_table(total(own, "suffix").withColumnRenamed("sums", "suffix_sums"), "langid-suffixes")
    joined = own.join(suffixes, "suffix", "left").join(hosts, "host", "left")
    zero = F.array(*[F.lit(0.0)] * n_langs)

    def smoothed(sums: str, parent: Column) -> Column:
        """Counts without the document itself, and ``PRIOR_WEIGHT`` documents of the parent's prior."""
        rest = F.when(F.col(sums).isNull(), zero).otherwise(F.zip_with(
            sums, F.coalesce("own", zero), lambda a, b: F.greatest(a - b, F.lit(0.0))))
        n = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(rest, parent, lambda a, p: (a + PRIOR_WEIGHT * p) / (n + PRIOR_WEIGHT))

    whole = F.array(*[F.lit(float(x)) for x in corpus])
    joined = joined.withColumn("by_suffix", smoothed("suffix_sums", whole))
    joined = joined.withColumn("prior", smoothed("host_sums", F.col("by_suffix")))
    fused = joined.withColumn("fused", softmax(F.zip_with("evidence", "prior", lambda e, p: e + F.log(p))))

    def best(c: str) -> Column:
        return F.when(F.col("n_letters") > 0, F.element_at(known, F.array_position(c, F.array_max(c)).cast("int")))

    posterior = F.when(F.col("n_letters") > 0, F.array_max("fused")).otherwise(F.lit(0.0))
    above = F.zip_with("loglik", F.array(*[F.lit(float(x)) for x in typical]), lambda a, t: a / F.least("n_letters", F.lit(TEXT_WEIGHT)) - t)
    fits = F.when(F.col("n_letters") > 0, F.array_max(above) >= -(SPREAD + SHORT / F.sqrt("n_letters")))
    return fused.select("key", best("fused").alias("lang"), posterior.alias("posterior"), best("loglik").alias("text_lang"),
                        (F.coalesce(fits, F.lit(False)) & (posterior >= ACCEPT)).alias("accepted"))


def _documents(docs: DataFrame, key: Column) -> DataFrame:
    return docs.select(key.alias("key"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def _identity() -> Column:
    return F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", "lang", "source").alias("mark"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is identified; the source stands for the host."""
    found = identify(_documents(docs, _identity()), fit(docs))
    rejected = write_table(found.where(~F.col("accepted")).select(
        F.col("key.doc_id").alias("_id"), F.col("key.mark").alias("_mark")).distinct(), "langid-rejected")
    mark = F.xxhash64(docs["text"], docs["lang"], docs["source"])
    return docs.join(rejected.hint("merge"), docs["doc_id"].eqNullSafe(rejected["_id"]) & (mark == rejected["_mark"]), "left_anti")


_PAGE_TEXT = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>|&[a-z]+;|&#\w+;"


def digest(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents and pages: ids, declared and identified language, posterior, language by text alone, acceptance."""
    model = fit(docs)
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.col("lang").alias("declared"))
    rows = _documents(docs, key)
    host = F.nullif(F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    markup = F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z][\w-]*)""", 1)
    sites = pages.select(
        F.struct(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), markup.alias("declared")).alias("key"),
        F.regexp_replace("html", _PAGE_TEXT, " ").alias("text"), markup.alias("declared"), host.alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1), F.lit("")).alias("suffix"))
    return identify(rows.union(sites), model).select("key.doc_id", "key.page_id", "key.declared", "lang", "posterior", "text_lang", "accepted")
