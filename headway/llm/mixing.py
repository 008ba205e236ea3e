"""Soft-membership mixing: document rates whose expected domain tokens meet target weights.

A softmax classifier, fitted on a sample of at most about ``SAMPLE`` labelled
rows, gives every document posteriors over the domains of the labelled table.
A document with n tokens and posteriors p adds rate * n * p_k to domain k.
Nonnegative rates of least weighted squared distance of the domain totals from
their targets, as near to 1 as that allows, are fitted until they stand still.
A step needs only the totals and their derivatives, a few numbers per pair of
domains, which Spark sums over all documents; a document's rate is the start
less p . x projected on the allowed range, where x has one number per domain,
and is stored nowhere.  The steps are damped Newton steps on x: plain and
accelerated projected gradient steps on the rates have the same end, but need
thousands of passes to get there (figures in the README).  A fit that doesn't
reach its end says so in the column ``converged``.  Posteriors are soft: a domain of
target 0 gets as little as the other targets allow, not always nothing.

Defined results: null and empty texts have no tokens and the posteriors of an
empty text; a document without labels is classified like any other; labels
without a document, or null, are not used; several labels of one document all
count; a domain without target weight has target 0; without any labelled row
there is one domain, ``unlabelled``; equal rows get equal rates; an empty table
gives no rows; further columns are ignored by ``rates`` and kept by ``mixed``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import text
from .packing import slices
from .store import ship, write_table

SAMPLE = 10_000              # labelled documents that the classifier is fitted on
WORDS = 512                  # most telling words of the sample that are features
LEAST = 5                    # documents of the sample that such a word is in
STEPS = 500                  # a guard; the log tells when it ends a fit
CLOSE = 1e-6                 # steps end when no domain's total is this share of its tokens from its optimum
EASE = 1e-6                  # weight of staying near rate 1 against the targets
WEIGHTS = {"quality_1": 0.9, "quality_0": 0.1, "toxic": 0.0}
_BITS = 22
_LOG = logging.getLogger(__name__)


def domain() -> Column:
    """Domain of a row of ``labels``: toxic, else its quality."""
    return F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality").isNotNull(), F.concat(F.lit("quality_"), F.col("quality").cast("string")))


def style(column: pa.Array, n_tokens: np.ndarray) -> np.ndarray:
    """Shares of capitals, punctuation and digits, and word length, per row."""
    buf, offsets = text.text_bytes(column)
    size = np.maximum(np.diff(offsets), 1)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(mask))
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    digit = (buf >= 48) & (buf <= 57)
    punctuation = ~text.PLAIN[buf] & text.SPACED[buf]
    capital = (buf >= 65) & (buf <= 90)
    return np.stack([share(capital), share(punctuation), share(digit), np.minimum(np.diff(offsets) / np.maximum(n_tokens, 1), 30) / 30], axis=1)


@dataclass
class Classifier:
    domains: list[str]
    words: np.ndarray          # ascending hashes
    table: np.ndarray          # membership by leading bits
    weights: np.ndarray        # words + style + bias, by domain

    def features(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token counts, rows and features of the feature words found, dense features."""
        hashes, offsets = text.word_hashes(column, text.PLAIN)
        n_tokens = np.diff(offsets)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        feature = np.minimum(np.searchsorted(self.words, hashes[at]), max(len(self.words) - 1, 0))
        hit = self.words[feature] == hashes[at] if len(self.words) else np.zeros(0, bool)
        at, feature = at[hit], feature[hit]
        rows = np.searchsorted(offsets, at, side="right") - 1
        pairs = np.unique(rows * np.int64(len(self.words) + 1) + feature)            # presence, not counts
        rows, feature = pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)
        return n_tokens, rows, feature, np.column_stack([style(column, n_tokens), np.ones(len(n_tokens))])

    def logits(self, rows: np.ndarray, feature: np.ndarray, dense: np.ndarray) -> np.ndarray:
        out = dense @ self.weights[len(self.words):]
        for k in range(len(self.domains)):
            out[:, k] += np.bincount(rows, self.weights[feature, k], len(dense))
        return out

    def posteriors(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n_tokens, rows, feature, dense = self.features(column)
        return n_tokens, softmax(self.logits(rows, feature, dense))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _table(words: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << _BITS, bool)
    out[(words >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Classifier of the labelled documents."""
    ship(docs.sparkSession)
    named = labels.select(F.col("doc_id").alias("label_id"), domain().alias("domain")).where("domain IS NOT NULL AND label_id IS NOT NULL")
    one_in = max(1, -(-named.count() // sample))
    named = named.where(F.pmod(F.xxhash64("label_id"), F.lit(one_in)) == 0)           # at most about ``sample`` ids
    rows = write_table(docs.select("doc_id", "text").join(F.broadcast(named), F.col("doc_id") == F.col("label_id")).select("domain", "text"), "mixing-sample")
    size = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}      # a row per domain
    domains = sorted(size) or ["unlabelled"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, offsets = text.word_hashes(part["text"], text.PLAIN)
                sets = [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                label = part["domain"].take(pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), label], names=["word", "domain"])

    each = [F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(f"c{i}") for i, d in enumerate(domains)]
    counts = rows.mapInArrow(split, "word long, domain string").groupBy("word").agg(F.count("*").cast("double").alias("c"), *each).where(F.col("c") >= LEAST)
    total = float(sum(size.values()) or 1)
    # how much the word's domains differ from those of all documents (a likelihood ratio), present and absent
    score = F.lit(0.0)
    for i, d in enumerate(domains):
        share = size.get(d, 0) / total
        for part, whole in ((F.col(f"c{i}"), F.col("c")), (F.lit(float(size.get(d, 0))) - F.col(f"c{i}"), F.lit(total) - F.col("c"))):
            score = score + F.when(part > 0, part * F.log(part / (whole * F.lit(share or 1.0)))).otherwise(F.lit(0.0))
    best = counts.select("word", score.alias("score")).orderBy(F.desc("score"), "word").limit(WORDS).collect()
    words = np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))
    start = Classifier(domains, words, _table(words), np.zeros((len(words) + 5, len(domains))))
    if len(domains) < 2:
        return start
    shared = docs.sparkSession.sparkContext.broadcast(start)

    def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, at, feature, dense = shared.value.features(part["text"])
                cuts = np.searchsorted(at, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part["domain"], pa.array([feature[a:b].astype(np.int16).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]), pa.array(list(dense))],
                    names=["domain", "feature", "dense"])

    found = rows.mapInArrow(feature_rows, "domain string, feature binary, dense array<double>").collect()    # the bounded sample
    found.sort(key=lambda r: (r["domain"], bytes(r["feature"]), r["dense"]))
    target = np.array([domains.index(r["domain"]) for r in found])
    sets = [np.frombuffer(bytes(r["feature"]), np.int16).astype(np.int64) for r in found]
    start.weights = _descend(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets),
                             np.array([r["dense"] for r in found]), target, start)
    return start


def _descend(rows: np.ndarray, feature: np.ndarray, dense: np.ndarray, target: np.ndarray, c: Classifier,
             steps: int = 150, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Softmax regression by Adam on the whole sample."""
    n, k = len(target), len(c.domains)
    truth = np.eye(k)[target]
    first, second = np.zeros_like(c.weights), np.zeros_like(c.weights)
    for t in range(1, steps + 1):
        error = (softmax(c.logits(rows, feature, dense)) - truth) / n
        words = np.stack([np.bincount(feature, error[rows, j], len(c.words)) for j in range(k)], axis=1)
        gradient = np.vstack([words, dense.T @ error]) + decay * c.weights
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        c.weights = c.weights - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return c.weights


def replay(p: np.ndarray, steps: np.ndarray, most: float) -> np.ndarray:
    """Rates of the fit: the start less p . step for its one step, projected on [0, most]."""
    rate = np.full(len(p), min(1.0, most))
    for step in steps:
        rate = np.clip(rate - p @ step, 0.0, most)
    return rate


@dataclass
class Mix:
    classifier: Classifier
    steps: np.ndarray          # one row, one number per domain
    most: float
    tokens: np.ndarray         # expected tokens per domain at rate 1
    targets: np.ndarray
    reached: np.ndarray
    converged: bool


def posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id, n_tokens, p`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, p = shared.value.posteriors(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))],
                                                 names=["doc_id", "n_tokens", "p"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, p array<double>")


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def fit_rates(table: DataFrame, classifier: Classifier, weights: dict[str, float], total: float | None = None,
              most: float = float("inf"), max_steps: int = STEPS) -> Mix:
    """Rates of least squared distance of the domain totals of ``posteriors`` from their targets.

    ``total`` is the number of tokens of the mix; by default as many as take
    the domain of the greatest weight once.  The objective weighs a domain by
    the inverse of its tokens; among equal mixes the rates nearest to the start
    are taken (weight ``EASE``).  Its dual has one number x_k per domain, the rates
    being clip(start - p . x): damped Newton steps on x, each a pass that sums
    the totals and their derivatives.
    """
    k, start = len(classifier.domains), min(1.0, most)

    def sums(x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Sum of n * integral of the rate, domain totals, and their derivatives by -x."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(1 + k + k * k)
            for batch in batches:
                p, n = _matrix(batch["p"], k), batch["n_tokens"].to_numpy()
                free = start - p @ x
                rate = np.clip(free, 0.0, most)
                out[0] += n @ (rate * free - rate ** 2 / 2)
                out[1:k + 1] += (n * rate) @ p
                out[k + 1:] += (p.T @ (p * (n * ((free > 0) & (free <= most)))[:, None])).ravel()
            yield pa.RecordBatch.from_pydict({f"s{i}": [v] for i, v in enumerate(out)})

        names = [f"s{i}" for i in range(1 + k + k * k)]
        row = table.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in names]).first()
        row = np.array(row, float)
        return row[0], row[1:k + 1], row[k + 1:].reshape(k, k)

    x = np.zeros(k)
    level, reached, slope = sums(x)
    tokens = reached / start if start else reached
    share = np.array([weights.get(d, 0.0) for d in classifier.domains], float)
    share = share / share.sum() if share.sum() else np.full(k, 1 / k)
    if total is None:
        top = int(np.argmax(share))
        total = tokens[top] / share[top]
    targets = total * share
    scale = np.maximum(tokens, 1.0)
    height, damp, done = level, 1e-2, False
    for _ in range(max_steps):
        gradient = targets - reached + EASE * scale * x
        if done := bool((np.abs(gradient) <= CLOSE * scale).all()):
            break
        step = np.linalg.solve(slope + np.diag((EASE + damp) * scale), -gradient)
        level, totals, slopes = sums(x + step)
        new = level + targets @ (x + step) + EASE / 2 * scale @ (x + step) ** 2
        if new <= height + 1e-12 * abs(height):
            x, reached, slope, height, damp = x + step, totals, slopes, new, damp / 10
        else:
            damp *= 8
    told = ", ".join(f"{d} {r:.0f} of {t:.0f}" for d, r, t in zip(classifier.domains, reached, targets))
    (_LOG.info if done else _LOG.warning)("mix %s; tokens reached of target: %s", "converged" if done else "NOT converged", told)
    return Mix(classifier, x[None, :], most, tokens, targets, reached, done)


def rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, most: float = float("inf")) -> DataFrame:
    """``doc_id, n_tokens, p, rate`` of every document, with the domains, target and reached totals of the fit."""
    classifier = fit(docs, labels)
    table = write_table(posteriors(docs, classifier), "mixing-posteriors")
    mix = fit_rates(table, classifier, weights, most=most)
    k = len(classifier.domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = replay(_matrix(batch["p"], k), mix.steps, most)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_tokens"], batch["p"], pa.array(rate)], names=["doc_id", "n_tokens", "p", "rate"])

    told = table.mapInArrow(run, "doc_id long, n_tokens long, p array<double>, rate double")
    def numbers(x):
        return F.array(*[F.lit(float(v)) for v in x])
    return told.select("*", F.array(*map(F.lit, classifier.domains)).alias("domains"), numbers(mix.targets).alias("targets"),
                       numbers(mix.reached).alias("reached"), F.lit(mix.converged).alias("converged"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, p, rate``, and of the whole fit ``domains, targets, reached, converged``."""
    return rates(docs, labels)


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The rows of ``docs``, all columns, that a mix without repeats takes.

    Rates are bounded by 1 and are the chance that a document stays; its draw
    is a hash of its id, so a rate of 1 always stays and a rate of 0 never.
    """
    classifier = fit(docs, labels)
    table = write_table(posteriors(docs, classifier), "mixing-posteriors")
    mix = fit_rates(table, classifier, weights, most=1.0)
    shared = docs.sparkSession.sparkContext.broadcast(mix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mix = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                _, p = mix.classifier.posteriors(part["text"])
                ids = part["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                draw = (text.mix(ids + np.uint64(0x5EED)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
                yield part.filter(pa.array(draw < replay(p, mix.steps, mix.most)))

    return docs.mapInArrow(run, docs.schema)
