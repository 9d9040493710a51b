"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier in numpy learns from confirmed toxic documents (P) and
unlabelled documents (U, a mixture of toxic and clean ones). With prior pi of
toxic documents and the sigmoid loss (bounded, so no single document can make
the estimate run away), the risk

    pi * R_P(+1) + max(0, R_U(-1) - pi * R_P(-1))

estimates the risk over labelled data; the maximum keeps the estimate of the
negatives' part from going below zero, where the model would overfit (then
the step goes uphill on that part, as published for nnPU).

Features: for each of some word parts, whether its count in the whole text
reaches each of ``COUNTS`` and its count per 1024 words each of ``DENSITIES``
(a stem that a long clean text meets by chance is rare in it). A word is a run
of letters, digits and non-ASCII bytes, A-Z lowered; its parts are the word
and its prefixes of 4 to 7 bytes, as 64-bit hashes. The ``features`` parts
whose share of the documents (or of the documents that have them twice) is
most above that of U in P are kept. ``lang``, ``source``, ``doc_id`` and
labels never enter a score.

Training sample: up to about ``positives`` toxic and ``unlabelled`` other
documents, picked by a hash of the id, of at most ``longest`` bytes (a bound
for the sample only). The prior is the toxic share among the labelled rows to
learn from. Features are computed on Spark, the model on the driver.

Defined cases: an empty or NULL text has no features and gets the score of
the intercept; with no toxic document to learn from every score is 0.0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import ident_hash

PREFIXES = (4, 5, 6, 7)
SIGNIFICANT = 3.5  # standard errors between the two shares
SUPPORT = 0.01  # least share of P, and 3 documents
COUNTS = np.array([1, 2, 3, 5, 9])
DENSITIES = np.array([1.0, 3.0, 9.0, 27.0])  # a 1024 words
LEVELS = len(COUNTS) + len(DENSITIES)

BREAK = np.ones(256, bool)
BREAK[48:58] = BREAK[65:91] = BREAK[97:123] = BREAK[128:] = False


def word_parts(column: pa.Array):
    """Yield (words of each text, part hashes, text of each part) for runs of whole texts."""
    for _, data, offsets in X.text_slices(column, 1 << 19):
        starts, ends, first = X.word_spans(data, offsets, BREAK)
        sums = X.prefix_sums(data)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        hashes, of = [X.span_hashes(sums, starts, ends)], [text]
        for n in PREFIXES:
            longer = ends - starts > n
            hashes.append(X.span_hashes(sums, starts[longer], starts[longer] + n))
            of.append(text[longer])
        yield np.diff(first), np.concatenate(hashes), np.concatenate(of)


def _counted(batches):
    """Distinct parts of each text with their counts, as bytes."""
    for batch in batches:
        parts, counts, words = [], [], []
        for size, hashes, of in word_parts(batch.column(0)):
            n = len(size)
            words.append(size)
            order = np.argsort(of, kind="stable")
            edges = np.searchsorted(of[order], np.arange(n + 1))
            for k in range(n):
                h, c = np.unique(hashes[order[edges[k] : edges[k + 1]]], return_counts=True)
                parts.append(h.tobytes())
                counts.append(c.astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.binary()), pa.array(counts, pa.binary()), pa.array(np.concatenate([np.zeros(0, np.int64), *words])), batch.column(1)],
            names=["parts", "counts", "words", "toxic"],
        )


def levels(count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which counts and densities each part of a text reaches."""
    density = count * 1024.0 / np.maximum(words, 64)
    return np.hstack([count[:, None] >= COUNTS, density[:, None] >= DENSITIES]).astype(np.float32)


def _contrasts(texts: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts of P with how many standard errors their share of P is above that of U."""
    hashes, n = np.unique(np.concatenate([t for t, x in zip(texts, toxic) if x]), return_counts=True)
    others = [t for t, x in zip(texts, toxic) if not x]
    other, m = np.unique(np.concatenate(others) if others else hashes[:0], return_counts=True)
    at = np.minimum(np.searchsorted(other, hashes), max(len(other) - 1, 0))
    in_u = np.where(other[at] == hashes, m[at], 0) if len(other) else np.zeros(len(hashes))
    pooled = (n + in_u + 0.5) / (len(toxic) + 1)
    above = n / toxic.sum() - in_u / max(len(others), 1)
    errors = above * np.sqrt(toxic.sum() / (pooled * (1 - np.minimum(pooled, 0.999))))
    return hashes, np.where(n >= max(3, SUPPORT * toxic.sum()), errors, 0.0)


def select_features(texts: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray, most: int) -> np.ndarray:
    """Sorted hashes of the parts that occur, or occur twice, in most more documents of P than of U."""
    hashes, errors = _contrasts(texts, toxic)
    twice, more = _contrasts([t[c >= 2] for t, c in zip(texts, counts)], toxic)
    at = np.searchsorted(hashes, twice)
    errors[at] = np.maximum(errors[at], more)
    best = np.argsort(-errors, kind="stable")[:most]
    return np.sort(hashes[best[errors[best] > SIGNIFICANT]])


def fit_nnpu(x: np.ndarray, toxic: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative PU risk; full-batch Adam."""
    p, u = x[toxic], x[~toxic]
    w = np.zeros(x.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    grad = lambda rows, d: np.append(rows.T @ d, d.sum()) / max(len(rows), 1)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        sp, su = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        lp, lu = sigmoid(sp), sigmoid(su)  # loss of calling P, U negative; the slope is l * (1 - l)
        negative = lu.mean() - prior * lp.mean()
        towards = prior * grad(p, lp * (1 - lp))
        g_negative = grad(u, lu * (1 - lu)) - towards
        g = g_negative - towards if negative >= 0 else -g_negative
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return w[:-1], float(w[-1])


class Model:
    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        self.hashes, self.weights, self.intercept = hashes, weights.reshape(-1, LEVELS), intercept
        self.maybe = np.zeros(1 << 16, bool)  # most parts are no feature: one look-up tells
        self.maybe[hashes & np.uint64(0xFFFF)] = True

    def logits(self, words: np.ndarray, hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        out = np.full(len(words), self.intercept)
        if not len(self.hashes):
            return out
        some = self.maybe[hashes & np.uint64(0xFFFF)]
        hashes, of = hashes[some], of[some]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        cell, count = np.unique(of[found] * len(self.hashes) + at[found], return_counts=True)
        text, part = cell // len(self.hashes), cell % len(self.hashes)
        gain = (levels(count, words[text]) * self.weights[part]).sum(1)
        return out + np.bincount(text, weights=gain, minlength=len(words))


def train(docs: DataFrame, marked: DataFrame, positives: int = 2000, unlabelled: int = 4000, longest: int = 40000, features: int = 256) -> Model | None:
    """Model learned from ``docs`` (doc_id, text) and ``marked`` (doc_id, toxic 0 or 1).

    The sampled ids are bounded numbers, so they are broadcast to the texts.
    """
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1):
        return None
    prior = min(max(sizes[1] / sum(sizes.values()), 0.001), 0.5) if len(sizes) > 1 else 0.1
    total = docs.select("doc_id").count()
    drawn = ident_hash(F.col("doc_id"), 8)
    known = marked.filter((F.col("toxic") == 1) & (drawn < int(min(1.0, positives / sizes[1]) * (1 << 30))))
    short = docs.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= longest)
    p = short.join(F.broadcast(known.select("doc_id")), "doc_id").select("text", F.lit(True).alias("toxic"))
    u = short.filter(drawn >= (1 << 30) - int(min(1.0, unlabelled / max(total, 1)) * (1 << 30))).select("text", F.lit(False).alias("toxic"))
    rows = p.unionByName(u).mapInArrow(_counted, "parts binary, counts binary, words long, toxic boolean").toArrow()
    got = sorted(zip(*(rows.column(c).to_pylist() for c in ("parts", "counts", "words", "toxic"))))
    toxic = np.array([t for *_, t in got], bool)
    if not toxic.any():
        return None
    texts = [np.frombuffer(h, np.uint64) for h, *_ in got]
    counts = [np.frombuffer(c, np.uint32).astype(np.int64) for _, c, *_ in got]
    chosen = select_features(texts, counts, toxic, features)
    x = np.zeros((len(got), len(chosen), LEVELS), np.float32)
    for k, (h, c, (_, _, words, _)) in enumerate(zip(texts, counts, got)):
        _, mine, column = np.intersect1d(h, chosen, assume_unique=True, return_indices=True)
        x[k, column] = levels(c[mine], np.int64(words))
    weights, intercept = fit_nnpu(x.reshape(len(got), -1), toxic, prior)
    return Model(chosen, weights, intercept)


def _scorer(shared):
    def score(batches):
        model = shared.value
        for batch in batches:
            scores = [np.zeros(0)]
            for words, hashes, of in word_parts(batch.column(1)):
                scores.append(1 / (1 + np.exp(-np.clip(model.logits(words, hashes, of), -30, 30))) if model else np.zeros(len(words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], names=["doc_id", "score"])
            del batch
        X.release_memory()

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_from: Column, **options) -> DataFrame:
    """doc_id, score (0 to 1, higher: toxic likelier) of every document.

    ``docs``: doc_id, text. ``labels``: doc_id, toxic. ``learn_from`` is a
    condition on ``doc_id`` of the rows to learn from. Labels of one document
    that disagree count as their mean rounded.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    marked = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg("toxic")).cast("int").alias("toxic"))
    model = train(docs.filter(learn_from), marked.filter(learn_from), **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scorer(shared), "doc_id long, score double")
