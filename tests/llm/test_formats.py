"""WARC archives, fingerprints, mix, packing, token-id store."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import id_store as I
from ledgerlake.llm import length_buckets as L
from ledgerlake.llm import multiset_hash as M
from ledgerlake.llm.fair_mix import mix, mix_plan
from ledgerlake.llm.warc_revisit import parse_archive, read_archives, write_archives
from ledgerlake.session import fresh_dir
from tests.conftest import confs

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- WARC ----------------------------------------------------------------------


def test_warc_round_trip_with_repeats_and_odd_payloads(spark):
    long = "<p>é</p>" * 200
    tricky = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30
    rows = [(1, "http://a/\r\nWARC-Type: x", long), (7, None, long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (8, "u", ""), (9, "u", tricky),
            (10, "u", tricky + "\r\n"), (11, "u", tricky), (None, "u", long), (20, "u", "x" * 1000), (20, "u", "x" * 1000), (19, "u", "x" * 1000), (None, "u", "y" * 1200)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record_type string")
    path = fresh_dir(spark, "warc_test")
    write_archives(df.repartition(3), path, records_per_file=2)
    got = sorted(read_archives(spark, path).drop("url").collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["payload_bytes"]))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        keeper = max(same, default=None)
        revisit = len(data) >= 1000 and keeper is not None and keeper != page
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_warc_of_no_pages_and_a_cut_archive(spark):
    path = fresh_dir(spark, "warc_test")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archives(spark, path).collect() == []
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 8\r\n\r\nA: b\r\n\r\nxx\r\n\r\n"
    with pytest.raises(ValueError):
        list(parse_archive(memoryview(whole[:-3])))


# --- fingerprints ---------------------------------------------------------------------


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = M.with_fingerprint(df, "text", "words").select("doc_id", "words").collect()
    return [r["words"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_archives_roll_by_bytes(spark, tmp_path):
    import os

    small = [(i, f"http://a/{i}", f"page {i} " * 200) for i in range(300)]
    middle = [(1000 + i, "u", f"{i % 3} " * 60_000) for i in range(12)]
    large = [(2000 + i, None, f"{i // 2}" * 1_200_000) for i in range(5)]
    pages = spark.createDataFrame([*small, *middle, *large], "page_id long, url string, html string").coalesce(2)
    path = str(tmp_path / "warc")
    write_archives(pages, path, file_bytes=1 << 21)
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
    assert max(sizes) < 3 << 20 and len(sizes) > 8
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in read_archives(spark, path).collect()}
    rows = {i: h.encode() for i, _, h in [*small, *middle, *large]}
    keeper = {}
    for i, h in rows.items():
        keeper[h] = max(keeper.get(h, i), i)
    assert got == {i: (len(h), "response", None) if keeper[h] == i else (len(h), "revisit", keeper[h]) for i, h in rows.items()}


def test_fingerprints_ignore_order_and_follow_insertion_and_deletion(spark):
    a, b, whole, swapped, twice, none, empty = prints(spark, ["One here. Two!", "Three?\nFour", "One here. Two!\nThree?\nFour", "Four\nThree? Two! One here.", "Four\nThree? Two! Two! One here.", None, ""])
    assert whole == swapped != twice and none == empty
    df = spark.createDataFrame([(a, b, whole)], "a array<long>, b array<long>, w array<long>")
    assert tuple(df.select(M.combine("a", "b"), M.remove("w", "b"), M.remove("w", "w")).first()) == (whole, a, empty)


def test_fingerprint_words_equal_a_plain_sum(spark):
    text = "A b. C d! E\n\n\nF. A b."
    pieces = spark.createDataFrame([("A b.",), ("C d!",), ("E",), ("F.",), ("A b.",)], "p string")
    hashes = [r["h"] for r in pieces.select(F.array(*[F.xxhash64(F.lit(k), "p") for k in range(M.SEEDS)]).alias("h")).collect()]
    (words,) = prints(spark, [text])
    for seed in range(M.SEEDS):
        own = [h[seed] % (1 << 64) for h in hashes]
        for k in range(M.EACH):
            lanes = [sum((h >> k >> at) & 1 for h in own) for at in M.LANES]
            assert words[seed * M.EACH + k] == sum(v << at for v, at in zip(lanes, M.LANES))
        assert words[M.NARROW + seed] == sum(h & M._SIXTY for h in own) & M._SIXTY
    assert words[-1] == 5


def test_edited_fingerprints_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcé ", k=rng.randint(1, 6)))
    texts = [rng.choice([". ", "\n", "! "]).join(word() for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, "", "x", "😀😀"]
    ids = [i * 700 - 3000 for i in range(len(texts))]
    rows = list(zip(ids, texts))
    df = spark.createDataFrame([(None, "lost", 1, "n"), *[(*r, 2, "m") for r in rows]], "doc_id long, text string, words int, near_next string")
    got = sorted(M.edited_fingerprints(df).collect())
    edited = []
    for k, (_, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited.append(t[: len(t) - half] + following[:half])
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got] == [(i, len(t or ""), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(rows, edited)]
    own, other = prints(spark, texts), prints(spark, edited)
    text_of = lambda words: "".join(f"{w:016x}" for w in words)
    assert [(r["fingerprint"], r["edited_fingerprint"]) for r in got] == [(text_of(a), text_of(b)) for a, b in zip(own, other)]

    def like(a, b):
        if a == b:
            return 1.0
        x, y = ([((2 * ((w >> at) & 0xFFFFF) - f[-1] + 2**19) % 2**20) - 2**19 for w in f[: M.NARROW] for at in M.LANES] for f in (a, b))
        norm = sum(v * v for v in x + y)
        return min(1.0, max(0.0, 2 * sum(p * q for p, q in zip(x, y)) / norm)) if norm else 0.0

    for k, r in enumerate(got):
        assert r["near_edited"] == pytest.approx(like(own[k], other[k])) and r["near_next"] == pytest.approx(like(own[k], own[(k + 1) % len(own)]))


def test_likeness_of_texts_that_share_paragraphs(spark):
    """The estimate's error is that of 252 lanes, and many repeats of a paragraph do not wrap a lane."""
    rng = random.Random(6)
    pool = [f"Paragraph {k} of the pool." for k in range(400)]
    rows, shares = [], []
    for i in range(120):
        base = rng.sample(pool, 40)
        keep = rng.randint(0, 40)
        other = base[:keep] + rng.sample([p for p in pool if p not in base], 40 - keep)
        rows.append((i, "\n".join(base), "\n".join(other)))
        shares.append(keep / 40)
    rows.append((500, "a\n" * 40_000, "a\n" * 20_000))
    df = M.with_fingerprint(M.with_fingerprint(spark.createDataFrame(rows, "i long, a string, b string"), "a", "x"), "b", "y")
    df = M._once(M._once(df, "x_lanes", M.lanes("x")), "y_lanes", M.lanes("y")).select("i", M.likeness("x", "y").alias("like"))
    got = {r["i"]: r["like"] for r in df.collect()}
    errors = [got[i] - share for i, share in enumerate(shares) if 0.1 < share < 1]
    assert np.sqrt(np.mean(np.square(errors))) < 0.09 and max(map(abs, errors)) < 0.3
    assert got[500] == pytest.approx(0.8)  # 2 * 1 * 2 / (1 + 4)


@pytest.mark.parametrize("parts", [1, 5])
def test_the_next_document_with_sparse_ids_repeats_and_long_texts(spark, parts):
    rng = random.Random(7)
    ids = sorted([rng.randrange(-(2**62), 2**62) for _ in range(40)] + list(range(5000, 5060)))
    rows = [(i, f"text {i}. more") for i in ids] + [(5001, "again"), (5001, "again"), (5100, "long. " * 50_000)]
    rows.sort()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    with confs(spark, **{"spark.sql.shuffle.partitions": str(parts)}):
        got = sorted((r["doc_id"], r["edited_sha256"]) for r in M.edited_fingerprints(df).collect())
    want = []
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        want.append((i, hashlib.sha256((t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]).encode()).hexdigest()))
    assert got == sorted(want)


def test_fingerprints_of_one_and_no_document(spark):
    schema = "doc_id long, text string"
    (r,) = M.edited_fingerprints(spark.createDataFrame([(4, "abcd")], schema)).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and r["near_next"] == 1.0
    assert M.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []


# --- mix ---------------------------------------------------------------------------------


def water_fill(sizes, budget=1.5, repeat=2):
    """Targets by repeated sharing: the slow, plain form."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, target, left = budget * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while left:
        share = (total - sum(target[s] for s in names if s not in left)) / sum(weight[s] for s in left)
        over = {s for s in left if share * weight[s] > repeat * sizes[s]}
        for s in over:
            target[s] = repeat * sizes[s]
        if not over:
            for s in left:
                target[s] = share * weight[s]
            break
        left -= over
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_comes_near_its_targets(spark, seed):
    rng = random.Random(seed)
    sources = [None, "b", "a", "B", "", "ä", "z"][: rng.randint(2, 7)]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 90])) or None, rng.choice(sources + [sources[0]] * 4)) for i in range(400)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows] + [(None, "a b", "b", 1, "y")], "doc_id long, text string, source string, size int, no string")
    out = {r["doc_id"]: r for r in mix_plan(df).collect()}
    assert len(out) == 400
    sizes, taken = dict.fromkeys({r[2] for r in rows}, 0), {}
    for i, t, s in rows:
        n = len((t or "").split())
        assert out[i]["size"] == n and out[i]["taken"] in (0, n, 2 * n)
        sizes[s] += n
        taken[s] = taken.get(s, 0) + out[i]["taken"]
    target = water_fill(sizes)
    for i, _, s in rows:
        assert out[i]["source_size"] == sizes[s] and out[i]["target"] == pytest.approx(target[s])
    assert all(abs(taken[s] - target[s]) <= 2 * 90 for s in sizes)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = {r["doc_id"]: r["taken"] for r in mix_plan(df.repartition(5)).collect()}
    assert again == {i: r["taken"] for i, r in out.items()}
    mixed = mix(df)
    assert mixed.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: r["copies"] for i, r in out.items() if r["copies"]}


def test_mix_of_nothing_and_of_texts_without_words(spark):
    schema = "doc_id long, text string, source string"
    assert mix_plan(spark.createDataFrame([], schema)).collect() == []
    rows = mix_plan(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in sorted(rows)] == [(0, 0.0, 0)] * 2
    rows = mix_plan(spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (1, "c", "s")], schema)).collect()
    assert sorted(r["size"] for r in rows) == [1, 2, 2] and sum(r["taken"] for r in rows) <= 7


# --- packing --------------------------------------------------------------------------------


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_bucket_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(0, 60), rng.randint(1, 9))), np.int64)
    counts = np.array([rng.randint(1, 40) for _ in lengths], np.int64)
    for buckets in (1, 2, 3, 5, 20):
        bounds = L.optimal_bounds(lengths, counts, buckets)
        assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and bounds[-1] == lengths[-1]
        choices = (c + (lengths[-1],) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1].tolist(), k))
        assert padding(lengths, counts, bounds) == min(padding(lengths, counts, c) for c in choices)


def test_packing_covers_every_document_within_the_budget(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * n)) for i, n in enumerate(rng.choices([0, 1, 2, 7, 30, 31, 32, 500, 1500], k=700))] + [(800, None), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(*r, "b") for r in rows] + [(None, "x", "b")], "doc_id long, text string, bucket string")
    out = L.pack(df, buckets=4, token_budget=600, digits=5, shard_docs=100).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in out) == sorted((i, len((t or "").split())) for i, t in rows)
    batches = {}
    for r in out:
        assert 0 <= r["padding"] == r["bucket_length"] - r["n_tokens"]
        batches.setdefault(r["batch_id"], []).append(r)
    for batch in batches.values():
        assert {r["batch_docs"] for r in batch} == {len(batch)} and len({r["bucket_length"] for r in batch}) == 1
        assert len(batch) == 1 or len(batch) * batch[0]["bucket_length"] <= 600
    assert len({r["bucket_length"] for r in out}) <= 4
    assert L.pack(df.limit(0)).collect() == []


def test_histogram_rounding_is_exact_below_and_bounded_above(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([0, 1, 31, 32, 33, 1000, 10**12 + 1])], "doc_id long, n long")
    out = sorted(L.pack(df, buckets=50, digits=5, length=F.col("n")).collect())
    assert [r["bucket_length"] for r in out] == [0, 1, 31, 32, 34, 1024, -(-(10**12 + 1) // 2**35) * 2**35]


# --- token ids ----------------------------------------------------------------------------------

ODD = ["", None, "a<|endoftext|>b c", "<|startoftext|>", "İSTANBUL ΑΣ Σ x́ ́", "a\x85b a\x1cb c", "don't 've 12345 ½", "日本語 한국어 😀", " \n\t ", "x " * 3000]


def test_store_round_trip_and_lookup(spark):
    from tokenizers import Tokenizer

    rows = [(i * 3, t) for i, t in enumerate(ODD + [f"number {i} of the many texts" for i in range(60)])] + [(6, "again"), (6, "again")]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(None, "lost", 1)], "doc_id long, text string, start int")
    path = fresh_dir(spark, "ids_test")
    I.write_store(df.repartition(4), path, TOKENIZER, block_docs=16)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    start, want = 0, []
    encoded = {}
    for i, t in sorted((i, t or "") for i, t in rows):
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
        encoded.setdefault(i, []).append(ids.tolist())
    assert sorted(tuple(r) for r in I.read_store(spark, path).collect()) == want
    assert sorted(x.tolist() for x in I.lookup(spark, path, 6)) == sorted(encoded[6])
    assert I.lookup(spark, path, 1) == []
    blocks = [b for r in spark.read.parquet(f"{path}/blocks").orderBy("part", "block").collect() for b in np.frombuffer(r["doc_ids"], "<i8")]
    assert blocks == sorted(blocks)


def test_store_of_no_documents(spark):
    path = fresh_dir(spark, "ids_test")
    I.write_store(spark.createDataFrame([], "doc_id long, text string"), path, TOKENIZER)
    assert I.read_store(spark, path).collect() == []


def test_piece_cache_that_overflows_gives_the_same_ids():
    with open(TOKENIZER, encoding="utf-8") as f:
        text = f.read()
    texts = [f"w{k} thing{k % 7} {t or ''}" for k, t in enumerate(ODD * 3)]
    small, large = I.PieceEncoder(text, most=16), I.PieceEncoder(text)
    want = [list(x) for x in I.PieceEncoder(text, whole=True).encode(pa.array(texts))]
    for encoder in (small, large):
        for _ in range(2):
            assert [list(x) for k in range(len(texts)) for x in encoder.encode(pa.array(texts[k : k + 1]))] == want
    assert I.pieces_agree(text, texts)


def test_wrong_dictionary_is_refused(spark):
    path = fresh_dir(spark, "ids_test")
    I.write_store(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), path, TOKENIZER)
    blocks = spark.read.schema(I.BLOCK_SCHEMA).parquet(f"{path}/blocks").withColumn("dictionary_sha256", F.lit("other"))
    other = fresh_dir(spark, "ids_test")
    blocks.write.parquet(f"{other}/blocks")
    spark.read.parquet(f"{path}/dictionary").write.parquet(f"{other}/dictionary")
    with pytest.raises(Exception, match="dictionary"):
        I.read_store(spark, other).collect()


def test_packing_is_optimal_for_long_texts(spark):
    lengths = [3, 700, 1025, 1027, 2049, 5001, 20020]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n long")
    for buckets in (1, 3, 16):
        out = L.pack(df, buckets=buckets, length=F.col("n")).collect()
        choices = (c + (lengths[-1],) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k))
        assert sum(r["padding"] for r in out) == min(padding(lengths, [1] * len(lengths), c) for c in choices)
        assert {r["bucket_length"] for r in out} <= set(lengths)


def test_which_tokenizers_are_encoded_by_pieces():
    import json

    import public_tokenizers

    with open(TOKENIZER, encoding="utf-8") as f:
        about = json.load(f)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not I.splits_at_white_space(f.read())  # a blank belongs to the word behind it
    split = lambda **change: I.splits_at_white_space(json.dumps(about | change))
    assert split() and I.vocabulary_size(json.dumps(about)) == 49408
    keep = lambda pattern, **more: {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True, **more}
    for pattern, good in ((r"\p{L}+", True), (r"[^\s]+", True), (r"\S+ ?", False), (r".", False), (r"[^a]", False), (r"\w+(?= )", False), (r"a\b", False), (r"\P{L}", False)):
        assert split(pre_tokenizer=keep(pattern)) is good, pattern
    assert split(pre_tokenizer={"type": "WhitespaceSplit"}) and not split(pre_tokenizer=None) and not split(pre_tokenizer=keep(r"\p{L}+", invert=False))
    assert not split(normalizer={"type": "Prepend", "prepend": "_"}) and split(normalizer=None)
    assert not split(added_tokens=[{"id": 1, "content": "a b"}]) and not split(added_tokens=[{"id": 1, "content": "a", "lstrip": True}])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_store_without_a_sample_and_with_whole_texts(spark, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in enumerate([*ODD, "  two  blanks\n", "word " * 60_000])]
    path = fresh_dir(spark, "ids_test")
    I.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, public_tokenizers.path(name), sample_longest=-1)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    want = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in I.read_store(spark, path).collect()}
    assert got == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in want.items()}
