"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``passage_words`` words, over the
whole text). Every passage is encoded: style features of its bytes and words
go through a learned layer to a vector h. Gated attention weighs the passages,

    a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) ),

and the weighted vector z = sum_k a_k h_k is scored by a logistic unit. Only
document labels are learned from; which passages matter is learned with them.

Features of a passage: shares of 16 byte classes and of their 256 successions,
mean word length, share of words equal to the word before, share of distinct
words, log of the number of words. ``lang``, ``source``, ``doc_id`` and the
labels never enter a score.

Training: up to about ``sample`` labelled documents, picked by a hash of the
id, of at most ``longest`` passages each (a bound for the sample only); their
features are computed on Spark, the network is trained by numpy on the driver
and sent to the tasks that score. Same input, same model.

Defined cases: an empty or NULL text is one passage without words; a document
whose label is missing trains nothing and is scored like any other; without
labels to learn from every score is 0.5; with one kind of label, near it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import ident_hash, keep_texts

CLASSES = 16
WIDTH = CLASSES + CLASSES * CLASSES + 4


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 14, np.uint8)  # other punctuation and control bytes
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 3
    kind[[0x20, 0x09]], kind[[0x0A, 0x0B, 0x0C, 0x0D]] = 4, 5
    for k, chars in enumerate((b".", b",;:", b"!?", b"#", b"*", b"$%&", b"|/\\", b"()[]{}<>", b"\"'`")):
        kind[list(chars)] = 6 + k if k < 8 else 15
    return kind


BYTE_CLASS = _byte_classes()


def passage_features(column: pa.Array, passage_words: int):
    """Yield (passages per text, features) for runs of whole texts."""
    for _, data, offsets in X.text_slices(column, 1 << 19):
        n_docs = len(offsets) - 1
        starts, ends, first = X.word_spans(data, offsets)
        words = np.diff(first)
        passages = np.maximum(1, -(-words // passage_words))
        base = np.concatenate([[0], np.cumsum(passages)])
        total = int(base[-1])
        doc_of_word = np.repeat(np.arange(n_docs), words)
        of_word = base[:-1][doc_of_word] + (np.arange(len(starts)) - first[:-1][doc_of_word]) // passage_words
        # a passage owns the bytes from its first word to the next passage's; the first also what stands before
        new = np.flatnonzero(np.diff(of_word, prepend=-1) > 0)
        begin = np.repeat(offsets[:-1], passages)
        begin[of_word[new]] = starts[new]
        begin[base[:-1]] = offsets[:-1]
        of_byte = np.repeat(np.arange(total), np.diff(np.append(begin, len(data))))
        kind = BYTE_CLASS[data]
        size = np.maximum(np.diff(np.append(begin, len(data))), 1)[:, None]
        single = np.bincount(of_byte * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES)
        follow = of_byte[1:] * (CLASSES * CLASSES) + kind[:-1].astype(np.int64) * CLASSES + kind[1:]
        follow = follow[of_byte[1:] == of_byte[:-1]]
        double = np.bincount(follow, minlength=total * CLASSES * CLASSES).reshape(total, CLASSES * CLASSES)
        hashes = X.span_hashes(X.prefix_sums(data), starts, ends)
        count = np.bincount(of_word, minlength=total)
        many = np.maximum(count, 1)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        order = np.lexsort((hashes, of_word))
        sorted_of, sorted_hash = of_word[order], hashes[order]
        distinct = np.ones(len(hashes), bool)
        distinct[1:] = (sorted_of[1:] != sorted_of[:-1]) | (sorted_hash[1:] != sorted_hash[:-1])
        more = [
            np.bincount(of_word, weights=ends - starts, minlength=total) / many / 10,
            np.bincount(of_word, weights=again, minlength=total) / many,
            np.bincount(sorted_of, weights=distinct, minlength=total) / many,
            np.log1p(count) / 5,
        ]
        yield passages, np.hstack([single / size, double / size, np.stack(more, 1)]).astype(np.float32)


def _bags(passage_words: int):
    def bags(batches):
        for batch in batches:
            rows = []
            for passages, features in passage_features(batch.column(0), passage_words):
                edges = np.concatenate([[0], np.cumsum(passages)])
                rows += [features[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], names=["bag", "label"])

    return bags


class AttentionNet:
    """Encoder, gated attention and logistic unit in numpy."""

    def __init__(self, mean, scale, hidden: int = 24, gate: int = 12, seed: int = 2):
        rng = np.random.default_rng(seed)
        init = lambda a, b: (rng.normal(size=(a, b)) / np.sqrt(a)).astype(np.float32)
        self.mean, self.scale = mean, scale
        self.p = {"E": init(len(mean), hidden), "e": np.zeros(hidden, np.float32), "V": init(hidden, gate), "U": init(hidden, gate),
                  "w": init(gate, 1)[:, 0], "c": init(hidden, 1)[:, 0], "b": np.zeros(1, np.float32)}

    def forward(self, features, passages):
        p = self.p
        x = np.clip((features - self.mean) / self.scale, -5, 5)
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        at = np.concatenate([[0], np.cumsum(passages)[:-1]])
        a = np.exp(s - np.repeat(np.maximum.reduceat(s, at), passages))
        a /= np.repeat(np.add.reduceat(a, at), passages)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30)))
        return score, (x, h, t, g, a, z, at)

    def gradients(self, passages, label, score, kept):
        p, (x, h, t, g, a, z, at) = self.p, kept
        d = ((score - label) / len(label)).astype(np.float32)
        each = np.repeat(np.arange(len(label)), passages)
        dz = d[:, None] * p["c"]
        dh = a[:, None] * dz[each]
        da = (dz[each] * h).sum(1)
        ds = a * (da - np.add.reduceat(a * da, at)[each])
        dt, dg = ds[:, None] * p["w"] * g, ds[:, None] * p["w"] * t
        dt, dg = dt * (1 - t * t), dg * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h * h)
        return {"E": x.T @ dx, "e": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": z.T @ d, "b": d.sum(keepdims=True)}

    def fit(self, bags, labels, epochs: int, batch: int, rate: float = 0.01, decay: float = 1e-3, seed: int = 2):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for lo in range(0, len(order), batch):
                ids = order[lo : lo + batch]
                features = np.concatenate([bags[i] for i in ids])
                passages = np.array([len(bags[i]) for i in ids])
                score, kept = self.forward(features, passages)
                step += 1
                now = rate * (1 - epoch / epochs)
                for k, grad in self.gradients(passages, labels[ids], score, kept).items():
                    grad = grad + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def train(docs: DataFrame, marked: DataFrame, sample: int = 4000, longest: int = 200, passage_words: int = 64, epochs: int = 12) -> AttentionNet | None:
    """Network learned from ``docs`` (doc_id, text) and ``marked`` (doc_id, label 0 or 1); None without labels.

    The sampled ids are a bounded number, so they are broadcast to the texts.
    """
    n = marked.count()
    if not n:
        return None
    chosen = marked.filter(ident_hash(F.col("doc_id"), 2) < int(min(1.0, sample / n) * (1 << 30)))
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "label").mapInArrow(_bags(passage_words), "bag binary, label int")
    rows = rows.filter(F.length("bag") <= longest * WIDTH * 4).toArrow()
    got = sorted(zip((x.as_py() for x in rows.column("bag")), rows.column("label").to_pylist()))
    if not got:
        return None
    bags = [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for x, _ in got]
    labels = np.array([y for _, y in got], np.float32)
    everything = np.concatenate(bags)
    net = AttentionNet(everything.mean(0), everything.std(0) + 1e-3)
    return net.fit(bags, labels, epochs, 64)


def _score(net, column: pa.Array, passage_words: int) -> np.ndarray:
    scores = [np.zeros(0)]
    for passages, features in passage_features(column, passage_words):
        scores.append(net.forward(features, passages)[0] if net else np.full(len(passages), 0.5))
    return np.concatenate(scores).astype(np.float64)


def _scorer(shared, passage_words: int):
    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(shared.value, batch.column(1), passage_words))], names=["doc_id", "score"])
            del batch
        X.release_memory()

    return score


def _model(docs: DataFrame, labels: DataFrame, learn_from: Column, passage_words: int, options: dict):
    """The network trained for ``docs``, as a broadcast variable."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    marked = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg("quality")).cast("int").alias("label"))
    net = train(docs.filter(learn_from), marked.filter(learn_from), passage_words=passage_words, **options)
    X.release_memory()  # of the bags
    return docs, docs.sparkSession.sparkContext.broadcast(net)


def quality_scores(docs: DataFrame, labels: DataFrame, learn_from: Column, passage_words: int = 64, **options) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) of every document.

    ``docs``: doc_id, text. ``labels``: doc_id, quality. ``learn_from`` is a
    condition on ``doc_id`` of the rows to learn from. Labels of one document
    that disagree count as their mean rounded.
    """
    docs, shared = _model(docs, labels, learn_from, passage_words, options)
    return docs.mapInArrow(_scorer(shared, passage_words), "doc_id long, score double")


def keep_quality(docs: DataFrame, labels: DataFrame, learn_from: Column, least: float = 0.3, passage_words: int = 64, **options) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, all columns."""
    _, shared = _model(docs, labels, learn_from, passage_words, options)
    return keep_texts(docs, lambda: lambda texts: _score(shared.value, texts.cast(pa.string()), passage_words) >= least)
