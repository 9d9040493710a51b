"""Byte helpers, exact top-k search, components."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X
from ledgerlake.llm.components import components
from ledgerlake.llm.impact_topk import ImpactIndex, top_k


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té  x.", max_size=30)), max_size=8))
def test_words_are_runs_outside_ascii_white_space(texts):
    import re

    got = []
    for _, data, offsets in X.text_slices(pa.array(texts, pa.string()), limit=20):
        starts, ends, first = X.word_spans(data, offsets)
        for k in range(len(offsets) - 1):
            got.append([data[a:b].tobytes().decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])])
    assert got == [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]


def test_span_hash_does_not_depend_on_the_place():
    data = np.frombuffer(b"Abc abc xabc abd", np.uint8)
    starts, ends, _ = X.word_spans(data, np.array([0, len(data)]))
    a, b, c, d = X.span_hashes(X.prefix_sums(data), starts, ends)
    assert a == b and len({a, c, d}) == 3


def brute_top(vectors, k, scale=256):
    ints = {i: [int(np.floor(scale * x)) for x in v] for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(ints):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k_equals_brute_force_with_ties_nulls_and_extra_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(180)]
    rows += [(i, rows[7][1]) for i in range(180, 260)]  # a hot vector: ties
    rows += [(300, None), (350, [float("nan")] * 8), (400, [float("inf")] * 8), (450, [None] * 8), (500, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 50 == 0, block_rows=64, query_rows=2, few=8).collect())
    assert got == brute_top(rounded, 5)


def test_top_k_of_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in top_k(one, F.col("id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert top_k(spark.createDataFrame([], schema), F.col("id") % 50 == 0).collect() == []


@pytest.mark.parametrize("scale", [3, 40, 200])
def test_index_survivors_hold_the_best_and_stop_early_on_proof(scale):
    rng = np.random.default_rng(scale)
    vectors = rng.normal(0, scale, (3000, 16)).astype(np.int64)
    vectors[::5] = vectors[0]
    queries = vectors[:20]
    for rows, query in zip(ImpactIndex(vectors, 4).survivors(queries, 6, 300), queries):
        scores = vectors @ query
        assert set(np.flatnonzero(scores >= np.sort(scores)[-6])) <= set(rows.tolist()) or len(rows) == len(vectors)


def test_components_of_paths_cycles_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100)] + [(500, k) for k in range(501, 560)] + [(7, 7), (9, 8)]
    df = spark.createDataFrame(links, "u long, v long")
    for hot_links in (4096, 3):
        got = {r["node"]: r["component"] for r in components(df, hot_links).collect()}
        assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), **dict.fromkeys(range(500, 560), 500)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_top_k_with_rows_of_any_finite_size(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(200)]
    rows[3] = (3, [1e7] + rows[3][1][1:])
    rows[50] = (50, [-1e6] * 4 + rows[50][1][4:])  # a query
    rows[60] = (60, rows[60][1][:7] + [1e13])
    rows[70] = (70, [1e13, -1e13] * 4)
    rows.append((250, [2.0**60] + [0.0] * 7))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows in (8192, 20):  # all in one block, and most blocks without such a row
        got = sorted(tuple(r) for r in top_k(df.filter("vec_id < 250"), F.col("id") % 50 == 0, block_rows=block_rows, few=8).collect())
        assert got == brute_top(rows[:-1], 5)
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(df, F.col("id") % 50 == 0).collect()


def test_sums_that_cancel_are_exact(spark):
    """Components near 200,000 whose products cancel: the best scores differ by a few parts in 1e11 of the terms."""
    for seed in range(8):
        rng = np.random.default_rng(seed)
        big = rng.integers(150_000, 200_000, (600, 1)) * np.array([[1, 1]])
        small = rng.integers(-50, 50, (600, 6))
        vectors = np.concatenate([big, small], axis=1).astype(np.int64)
        queries = np.concatenate([np.tile([200_000, -200_000], (4, 1)), rng.integers(-50, 50, (4, 6))], axis=1)
        index = ImpactIndex(vectors, 1600)
        for (found, score), query in zip(index.top(queries, np.arange(600), np.full(4, -1), 3, 10), queries):
            exact = vectors @ query
            best = np.lexsort((np.arange(600), -exact))[:3]
            assert found.tolist() == best.tolist() and score.tolist() == exact[best].tolist()
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors.tolist())] + [(1000 + 50 * i, [float(x) for x in q]) for i, q in enumerate(queries.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 50 == 0, scale=1, few=10).collect())
    assert got == brute_top(rows, 5, scale=1)


def test_queries_stop_on_proof_before_the_postings_are_used_up():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (4000, 32)).astype(np.int64)
    vectors[rng.integers(0, 4000, 60), rng.integers(0, 32, 60)] = 400
    queries = np.zeros((10, 32), np.int64)
    queries[np.arange(10), np.arange(10)] = 300
    queries += rng.integers(-1, 2, (10, 32))
    index = ImpactIndex(vectors, 4)
    found = index.top(queries, np.arange(4000), np.full(10, -1), 1, 64)
    assert index.used < 0.5 * len(index.rows) * 10
    assert all(score[0] == (vectors @ q).max() for (_, score), q in zip(found, queries))


def test_only_large_rows_leave_the_index():
    from ledgerlake.llm.impact_topk import _Block

    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(0, 40, (2000, 16)))
    vectors[7, 3], vectors[1200, 0] = 1e7, -1e15
    block = _Block(vectors, np.arange(2000), 4)
    assert block.beyond.tolist() == [7, 1200] and len(block.index.rows) > 20000
    queries = np.concatenate([vectors[:5], vectors[1200:1201]])
    for parts, query in zip(block.top(queries, np.array([0, 1, 2, 3, 4, 1200]), 4, 50), queries):
        scores = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in vectors.tolist()]
        own = next(i for i, v in enumerate(vectors.tolist()) if v == query.tolist())
        want = sorted(((-s, i) for i, s in enumerate(scores) if i != own))[:4]
        assert sorted((-int(s), int(i)) for found, score in parts for i, s in zip(found, score))[:4] == want


def test_top_k_with_vectors_of_unequal_length_and_repeated_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.3, int(rng.integers(1, 12))).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_k(df, F.col("id") % 50 == 0, block_rows=90, query_rows=3, few=6).collect())
    pad = lambda v: v + [0.0] * (12 - len(v))
    assert got == brute_top([(i, pad(v)) for i, v in rows], 5)
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.75, 1.0])] + [(50, [1.0])] * 300, "vec_id long, embedding array<double>")
    out = [tuple(r) for r in top_k(twice, F.col("id") == 0, k=4, block_rows=40).orderBy("rank").collect()]
    assert out == [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 50, 65536), (0, 4, 50, 65536)]
