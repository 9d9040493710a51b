"""Quality, toxicity and language: held-out accuracy, inputs, defined cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mil_quality as Q
from ledgerlake.llm import ppm_language as P
from ledgerlake.llm import pu_toxicity as T
from ledgerlake.llm.common import fold
from ledgerlake.llm.queries import QUERIES
from tests.conftest import SF_CHECK

WORDS = ["house", "tree", "river", "stone", "cloud", "bread", "green", "walk", "light", "paper", "window", "song"]


def documents(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic, bad = i % 5 == 0, i % 4 == 1
        words = rng.choices(WORDS, k=rng.randint(20, 120))
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vilewordo", "vilewordi", "nastything"])
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((i, text, int(not bad), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def small(spark):
    rows = documents(600, 1)
    docs = spark.createDataFrame([(i, t, None, "s", 7.0) for i, t, _, _ in rows] + [(900, None, "en", None, None), (901, "", None, None, None), (None, "x", None, None, None)],
                                 "doc_id long, text string, lang string, source string, score double").cache()
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i % 3] + [(5000, 1, 1), (None, 0, 0), (901, None, None)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def held_out_accuracy(rows, scores, column, parts, rest):
    import zlib

    right = [(scores[r[0]] >= 0.5) == bool(r[column]) for r in rows if zlib.crc32(str(r[0]).encode()) % parts == rest]
    assert len(right) > 50
    return sum(right) / len(right)


def test_quality_learns_from_document_labels(spark, small):
    rows, docs, labels = small
    scores = {r["doc_id"]: r["score"] for r in Q.quality_scores(docs, labels, fold(F.col("doc_id"), 5) != 0).collect()}
    assert len(scores) == 602 and all(0 <= s <= 1 for s in scores.values())
    assert held_out_accuracy(rows, scores, 2, 5, 0) > 0.95
    kept = Q.keep_quality(docs, labels, fold(F.col("doc_id"), 5) != 0)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.3}


def test_toxicity_learns_from_positives_and_unlabelled_text(spark, small):
    rows, docs, labels = small
    scores = {r["doc_id"]: r["score"] for r in T.toxicity_scores(docs, labels, fold(F.col("doc_id"), 4) != 2).collect()}
    assert len(scores) == 602 and all(0 <= s <= 1 for s in scores.values())
    assert held_out_accuracy(rows, scores, 3, 4, 2) > 0.95


def test_labels_that_are_not_to_be_learned_from_change_nothing(spark, small):
    _, docs, labels = small
    learn = fold(F.col("doc_id"), 5) != 0
    flipped = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (sorted(map(tuple, Q.quality_scores(docs, x, learn).collect())) for x in (labels, flipped))
    assert a == b


def test_classifiers_without_labels_or_documents(spark, small):
    _, docs, labels = small
    always = F.lit(True)
    none = labels.limit(0)
    assert {r["score"] for r in Q.quality_scores(docs.limit(5), none, always).collect()} == {0.5}
    assert {r["score"] for r in T.toxicity_scores(docs.limit(5), none, always).collect()} == {0.0}
    assert {r["lang_pred"] for r in P.identify(docs.limit(5).withColumn("lang", F.lit(None).cast("string")), always).collect()} == {"und"}
    for empty in (Q.quality_scores(docs.limit(0), labels, always), T.toxicity_scores(docs.limit(0), labels, always), P.identify(docs.limit(0), always)):
        assert empty.collect() == []


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, passages, y = rng.normal(size=(9, 5)).astype(np.float64), np.array([2, 3, 4]), np.array([1.0, 0.0, 1.0])
    net = Q.AttentionNet(np.zeros(5), np.ones(5), hidden=4, gate=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    loss = lambda: float(-np.mean(y * np.log(net.forward(x, passages)[0]) + (1 - y) * np.log(1 - net.forward(x, passages)[0])))
    score, kept = net.forward(x, passages)
    for name, grad in net.gradients(passages, y, score, kept).items():
        at = tuple(0 for _ in net.p[name].shape)
        old, step = net.p[name][at], 1e-5
        net.p[name][at] = old + step
        up = loss()
        net.p[name][at] = old - step
        down = loss()
        net.p[name][at] = old
        assert grad[at] == pytest.approx((up - down) / (2 * step), abs=1e-5), name


def test_passages_cover_the_whole_text():
    texts = ["", "one", " ".join(["word"] * 1000), None, "\n\n a b \n" * 40]
    sizes = np.concatenate([p for p, _ in Q.passage_features(pa.array(texts, pa.string()), 64)])
    assert sizes.tolist() == [1, 1, 16, 1, 2]


def reference_bits(learned, text, order):
    """Code length of a text, byte by byte, straight from the definition."""
    start = [10] * order
    seen = {}
    for t in learned:
        data = start + list(t.encode())
        for at in range(order, len(data)):
            for k in range(order + 1):
                here = seen.setdefault(tuple(data[at - k : at]), {})
                here[data[at]] = here.get(data[at], 0) + 1

    def bits(context, byte):
        here = seen.get(context, {})
        total, kinds = sum(here.values()), len(here)
        if byte in here:
            return math.log2((total + kinds) / here[byte])
        escape = math.log2((total + kinds) / kinds) if total else 0.0
        return escape + (bits(context[1:], byte) if context else 8.0)

    data = start + list(text.encode())
    return sum(bits(tuple(data[at - order : at]), data[at]) for at in range(order, len(data)))


def learned_counts(texts, order):
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["x"] * len(texts))], names=["text", "lang"])
    (out,) = P._grams(order)([batch])
    counts = out.column(1).to_numpy().view(np.uint64), out.column(2).to_numpy()
    by = np.argsort(counts[0])
    return counts[0][by], counts[1][by]


SCRIPTS = "".join(chr(c) for block in (0x21, 0xA1, 0x391, 0x410, 0x531, 0x5D0, 0x621, 0x905, 0x3042, 0x4E00, 0xAC00, 0x1F600) for c in range(block, block + 60))


@pytest.mark.parametrize("order", [0, 2, 4, 6])
def test_code_lengths_follow_the_definition(order):
    learn = ["the cat sat on the mat, the end", "on the way to the sea", SCRIPTS * 2]
    assert len(set(SCRIPTS.encode())) > 111
    tables = P.CodeTables({"x": learned_counts(learn, order)}, order)
    texts = ["the sea sat", "", "zzz ÿ the", "t", SCRIPTS[::-1], "\U00010348 \x7f"]
    got = []
    for _, data, offsets in X_slices(texts):
        got += tables.bits(data, offsets)[:, 0].tolist()
    assert got == pytest.approx([reference_bits(learn, t, order) for t in texts], rel=1e-4)


def test_trees_leave_no_context_out():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(400_000))
    tree = P.ContextTree(*learned_counts([text], 4), 4)
    assert len(tree.escapes[4].keys) > 200_000
    contexts = {text[k : k + 4] for k in range(len(text) - 4)}
    assert len(tree.escapes[4].keys) == len(contexts) + 4  # and those that reach before the text


def test_fifty_languages_within_memory_and_texts_of_no_language(spark):
    import tracemalloc

    rng = random.Random(4)
    letters = [rng.sample(SCRIPTS, 25) for _ in range(50)]
    word = lambda k: "".join(rng.choice(letters[k][:8] if rng.random() < 0.7 else letters[k]) for _ in range(rng.randint(2, 7)))
    vocabulary = [[word(k) for _ in range(200)] for k in range(50)]
    text = lambda k, n: " ".join(rng.choice(vocabulary[k]) for _ in range(n))
    rows = [(i, text(i % 50, 60), f"l{i % 50:02d}") for i in range(1500)]
    noise = "".join(chr(rng.choice([*range(0x21, 0x7E)])) + (" " if rng.random() < 0.1 else "") for _ in range(600))
    rows += [(5000, noise, None), (5001, text(7, 50), None), (5002, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = F.col("doc_id") < 1000
    got = {r["doc_id"]: r["lang_pred"] for r in P.identify(df, learn).collect()}
    assert sum(got[i] == f"l{i % 50:02d}" for i in range(1000, 1500)) > 490
    kept = {r["doc_id"] for r in P.keep_identified(df, learn).collect()}
    assert 5000 not in kept and 5001 in kept and len(kept & set(range(1500))) > 1470
    counts = P.learn(df.filter(learn))
    tracemalloc.start()
    P.CodeTables(counts)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(counts) == 50 and held < 60 * sum(len(g) for g, _ in counts.values())


def test_scoring_memory_follows_the_run_not_the_batch():
    import tracemalloc
    from types import SimpleNamespace

    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(3000)] + [None, "", "12 34"]
    grams, seen = np.unique(P._packed(np.frombuffer("".join(texts[:50]).encode(), np.uint8), np.array([0, 100_000]), 4), return_counts=True)
    shared = SimpleNamespace(value=("scoring memory", 4, {"a": (grams, seen), "b": (grams[::2], seen[::2])}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    score = P._predictor(shared, 1, [0])
    next(score(iter([batch.slice(0, 1)])))  # the trees are built and kept
    tracemalloc.start()
    found = pa.Table.from_batches(list(score(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    assert found.column("doc_id").to_pylist() == list(range(len(texts)))
    alone = [next(score(iter([batch.slice(k, 1)]))) for k in (0, 999, 1000, 2999, 3000, 3001, 3002)]
    assert found.take([0, 999, 1000, 2999, 3000, 3001, 3002]).to_pylist() == pa.Table.from_batches(alone).to_pylist()


def test_a_run_shorter_than_its_contexts():
    short = np.frombuffer(b"ba", np.uint8)
    assert P._packed(short, np.array([0, 2]), 4).tolist() == [0x0A0A0A0A62, 0x0A0A0A6261]


def test_language_ties_repeated_ids_and_long_texts(spark):
    same = "a b a b"
    rows = [(i, same, lang) for i, lang in enumerate(["de", "en"] * 5)] + [(50, same, None), (50, "b a", None), (51, same * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in P.identify(df, F.col("doc_id") < 10).collect() if r["doc_id"] >= 50]
    assert sorted(got) == [(50, "de", 0.5), (50, "de", 0.5), (51, "de", 0.5)]


def X_slices(texts):
    from ledgerlake.llm import text_np as X

    return X.text_slices(pa.array(texts, pa.string()))


def test_language_defined_cases(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 30)]
    rows += [(100, None, None), (101, "", None), (102, "123 -- !", None), (103, "the tree and the house", None), (104, "١٢٣", None), (None, "x", "en")]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in P.identify(df, F.col("doc_id") < 60).collect()}
    assert [got[i] for i in (100, 101, 102, 104)] == [("und", 0.0)] * 4
    assert got[103][0] == "en" and got[103][1] > 0.5 and len(got) == 65
    kept = P.keep_identified(df, F.col("doc_id") < 60)
    assert kept.schema == df.schema and sorted(r["doc_id"] for r in kept.collect()) == list(range(60)) + [103]


def test_language_counts_and_rates_of_all_labelled_documents(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(50)), "aa") for i in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    grams, seen = P.learn(df)["aa"]
    assert int(seen.sum()) == sum(len(t) for _, t, _ in rows)  # one string a byte of every text
    least = sorted(seen.tolist(), reverse=True)[19]
    assert P.learn(df, strings=20)["aa"][1].tolist() == [n for n in seen.tolist() if n > least or (n == least and sum(x >= least for x in seen) <= 20)]
    rated = df.select("text", "lang", F.lit("aa").alias("_lang_pred"), (F.col("doc_id") / 2500).alias("_rate"))
    assert P.usual_rates(rated).collect()[0]["_usual"] == pytest.approx(0.95, abs=1e-3)


@pytest.mark.parametrize("name, column, least", [("op2_mil_quality", "quality", 0.97), ("op8_pu_toxicity", "toxic", 0.85)])
def test_held_out_labels_of_the_test_tables(spark, name, column, least):
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", column)
    out = QUERIES[name](spark, SF_CHECK)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r[column] for r in rows) / len(rows) >= least


def test_held_out_languages_of_the_test_tables(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_ppm_language"](spark, SF_CHECK).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.99


def test_attention_forward_pass_plainly():
    """Gated attention over passages, written out one passage at a time."""
    rng = np.random.default_rng(1)
    features, passages = rng.normal(size=(10, 6)).astype(np.float32), np.array([4, 1, 5])
    net = Q.AttentionNet(np.full(6, 0.1), np.full(6, 1.5), hidden=5, gate=3)
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    first, want = 0, []
    for n in passages:
        hidden, scores = [], []
        for row in features[first : first + n]:
            x = [min(5.0, max(-5.0, (v - 0.1) / 1.5)) for v in row.tolist()]
            h = [math.tanh(sum(x[i] * net.p["E"][i, j] for i in range(6)) + net.p["e"][j]) for j in range(5)]
            t = [math.tanh(sum(h[i] * net.p["V"][i, j] for i in range(5))) for j in range(3)]
            g = [sigmoid(sum(h[i] * net.p["U"][i, j] for i in range(5))) for j in range(3)]
            hidden.append(h)
            scores.append(sum(t[j] * g[j] * net.p["w"][j] for j in range(3)))
        weights = [math.exp(s) / sum(math.exp(o) for o in scores) for s in scores]
        whole = [sum(w * h[j] for w, h in zip(weights, hidden)) for j in range(5)]
        want.append(sigmoid(sum(whole[j] * net.p["c"][j] for j in range(5)) + net.p["b"][0]))
        first += n
    assert net.forward(features, passages)[0].tolist() == pytest.approx(want, rel=1e-5)


def risk(w, b, x, toxic, prior, decay):
    """Non-negative PU risk with the sigmoid loss: prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)), and weight decay."""
    score = x @ w + b
    loss = 1 / (1 + np.exp(score))  # of calling a row positive
    positive, unlabelled = score[toxic], score[~toxic]
    negative = float((1 - loss[~toxic]).mean() - prior * (1 - loss[toxic]).mean())
    assert len(positive) and len(unlabelled)
    return prior * float(loss[toxic].mean()) + max(0.0, negative) + decay / 2 * float(w @ w)


def test_pu_training_lowers_the_non_negative_risk():
    rng = np.random.default_rng(2)
    truth = rng.random(1200) < 0.3
    x = np.where(truth[:, None], rng.random((1200, 12)) < 0.6, rng.random((1200, 12)) < 0.03).astype(np.float32)  # as select_features leaves them
    known = truth & (rng.random(1200) < 0.5)  # the rest of the toxic rows are unlabelled
    prior = 0.18
    w, b = T.fit_nnpu(x, known, prior)
    start = risk(np.zeros(12), math.log(prior / (1 - prior)), x, known, prior, 2e-4)
    best = risk(w.astype(float), float(b), x, known, prior, 2e-4)
    assert best < 0.6 * start
    for _ in range(50):  # no step nearby is better by more than the rounding of the training
        assert risk(w + rng.normal(0, 0.05, 12), b + rng.normal(0, 0.05), x, known, prior, 2e-4) > best - 2e-3
    unlabelled = ~known
    found = (x @ w + b > 0)[unlabelled]
    assert (found == truth[unlabelled]).mean() > 0.9


def test_classifiers_with_long_texts_repeated_ids_and_one_kind_of_label(spark):
    rows = documents(120, 8)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows] + [(0, rows[0][1]), (900, "house tree " * 60_000), (901, None)], "doc_id long, text string")
    always = F.lit(True)
    for column, score in (("quality", Q.quality_scores), ("toxic", T.toxicity_scores)):
        labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100)] + [(1, 1), (1, 0)], f"doc_id long, {column} int")
        out = score(docs, labels, always).collect()
        assert len(out) == 123 and all(0 <= r["score"] <= 1 for r in out)
        assert len({r["score"] for r in out if r["doc_id"] == 0}) == 1
        one = spark.createDataFrame([(i, 1) for i in range(100)], f"doc_id long, {column} int")
        assert all(0 <= r["score"] <= 1 for r in score(docs, one, always).collect())
