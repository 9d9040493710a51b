"""Phrase collocations from depth-truncated suffix trees, partitioned vertically.

Texts are lower-cased (A-Z), split at ``[.,;:!?]`` and line breaks into pieces
and those at blanks and tabs into words. Every word of a piece starts a suffix,
cut after four words. f(phrase), its number of occurrences, is the number of
suffixes below its node in the tree of all suffixes, per language.

1. One pass counts words exactly (combined per task, then summed by Spark) and
   pairs of words in a count-min sketch (:mod:`ledgerlake.llm.sketch`). No
   phrase of ``least`` occurrences starts with, or holds, a pair that the
   sketch estimates below ``least``; estimates are never too low.
2. A second pass cuts every suffix before its first pair below ``least`` and
   combines equal suffixes of a task. What is left, with its number, are the
   leaves of the tree.
3. *Vertical partitioning* by word prefixes: leaves are grouped by their first
   two words; a prefix with too many leaves for the memory budget is extended
   to three words, then four. Prefixes are dealt by hash to groups that hold
   about half the budget. Each group is one task's work: its subtree is built
   from the sorted leaves, and node counts are read as totals over the leaves
   below. A node above an extended prefix has leaves in several groups; its
   totals are summed by Spark.
4. Candidates, cuts and scores are joins and aggregates over the nodes with
   ``least`` occurrences.

The sketch is sized by the bytes of text, 32 MB at most; beyond that it spares
less and step 2 carries more leaves. Prefixes to extend are at most 100,000 a
level by counting, and so broadcast.

Defined cases: a NULL text is empty; a NULL lang is ``und``; all rows count,
also repeated ones and those without an id; ties go by the phrase's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import sketch as S
from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import cut

DEPTH = 4
_MOST_PREFIXES = 100_000

_BLANK, _BREAK = 0x20, 0x0A
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[0x09] = _BLANK
_TABLE[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_SPLITS = np.zeros(256, bool)
_SPLITS[[_BLANK, _BREAK]] = True


def _by_lang(batch: pa.RecordBatch):
    """(language, bytes, offsets) for runs of texts of one language."""
    langs = batch.column(0)
    for lang in pc.unique(langs).to_pylist():
        texts = batch.column(1).filter(pc.equal(langs, lang))
        for _, data, offsets in X.text_slices(texts):
            yield lang, _TABLE[data], offsets


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and whether each goes on to the next one in its piece."""
    starts, ends, first = X.word_spans(data, offsets, _SPLITS)
    breaks = np.concatenate([[0], np.cumsum(data == _BREAK)])
    on = np.zeros(len(starts), bool)
    on[:-1] = breaks[starts[1:]] == breaks[ends[:-1]]
    on[first[first > 0] - 1] = False  # the last words of texts
    return starts, ends, on


def _pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: str) -> np.ndarray:
    """Hash of each word, the next one and the language (the last word has none)."""
    sums = X.sequence_sums(X.span_hashes(X.prefix_sums(data, X.EXACT_VALUES[0]), starts, ends))
    salt = X.mix(np.array([hash_text(lang)], np.uint64))
    return X.window_hashes(sums, 2) ^ salt


def hash_text(text: str) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    whole = X.span_hashes(X.prefix_sums(data, X.EXACT_VALUES[0]), np.array([0]), np.array([len(data)]))
    return int(whole[0])


class _Combiner:
    """Counts of (lang, text) rows of a task, combined when many are held."""

    def __init__(self, most: int = 1 << 18):
        self.most, self.held, self.size, self.whole = most, [], 0, 0

    def add(self, lang: str, texts: pa.Array):
        """Take the texts in; a table of what has been held, if that is much."""
        found = pc.value_counts(texts)
        self.held.append(pa.table({"lang": pa.array([lang] * len(found), pa.string()), "text": found.field(0), "n": found.field(1)}))
        self.size += len(found)
        if self.size <= self.whole + self.most:
            return None
        held = self._combined()
        if held.num_rows > self.most:
            self.held, self.size, self.whole = [], 0, 0
            return _in_order(held)
        self.held, self.size, self.whole = [held], held.num_rows, held.num_rows
        return None

    def _combined(self) -> pa.Table:
        return pa.concat_tables(self.held).group_by(["lang", "text"], use_threads=False).aggregate([("n", "sum")]).select(["lang", "text", "n_sum"]).rename_columns(["lang", "text", "n"])

    def rest(self):
        return _in_order(self._combined()) if self.held else None


def _in_order(table: pa.Table) -> pa.Table:
    """Sorted: texts that start alike lie together, which files and shuffles compress far better."""
    return table.combine_chunks().sort_by([("lang", "ascending"), ("text", "ascending")])


def _text_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The given spans of the bytes as texts."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken)])


_FIRST_SCHEMA = f"lang string, word string, n long, {S.SCHEMA}"
_ROWS_OUT = 1 << 17


def _first_pass(bits: int):
    def batches_of(table):
        for lo in range(0, table.num_rows if table is not None else 0, _ROWS_OUT):
            part = table.slice(lo, _ROWS_OUT)
            empty = [pa.nulls(part.num_rows, t) for t in (pa.int64(), pa.binary(), pa.binary())]
            columns = [part.column("lang").combine_chunks(), part.column("text").cast(pa.string()).combine_chunks(), part.column("n").combine_chunks(), *empty]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n", "slice", "places", "counts"])

    def with_sketch(batch):
        empty = [pa.nulls(batch.num_rows, t) for t in (pa.string(), pa.string(), pa.int64())]
        return pa.RecordBatch.from_arrays([*empty, *batch.columns], names=["lang", "word", "n", "slice", "places", "counts"])

    def count(batches):
        words, sketch = _Combiner(), S.Counter(bits, 1)
        for batch in batches:
            for lang, data, offsets in _by_lang(batch):
                starts, ends, on = _words(data, offsets)
                if not len(starts):
                    continue
                yield from batches_of(words.add(lang, _text_array(data, starts, ends)))
                pairs = _pairs(data, starts, ends, lang)
                yield from map(with_sketch, sketch.add(pairs[on[:-1]]))
            del batch
        yield from batches_of(words.rest())
        yield from map(with_sketch, sketch.batches())
        X.release_memory()

    return count


def _leaves(bits: int, held):
    def batches_of(table):
        for lo in range(0, table.num_rows if table is not None else 0, _ROWS_OUT):
            part = table.slice(lo, _ROWS_OUT)
            columns = [part.column("lang").combine_chunks(), part.column("text").cast(pa.string()).combine_chunks(), part.column("n").combine_chunks()]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "suffix", "n"])

    def cut_suffixes(batches):
        bitmap, out = held.value, _Combiner()
        for batch in batches:
            for lang, data, offsets in _by_lang(batch):
                starts, ends, on = _words(data, offsets)
                if not len(starts):
                    continue
                may = np.zeros(len(starts) + DEPTH, bool)
                may[: len(starts) - 1] = on[:-1] & S.passes(bitmap, _pairs(data, starts, ends, lang), bits)
                more = may[: len(starts)].copy()
                words = more.astype(np.int64)
                for k in range(1, DEPTH - 1):
                    more &= may[k : len(starts) + k]
                    words += more
                at = np.flatnonzero(words)
                lengths = ends - starts + 1  # one blank behind each word
                put = np.concatenate([[0], np.cumsum(lengths)])
                spread = np.repeat(starts - put[:-1], lengths) + np.arange(put[-1])
                joined = np.append(data, np.uint8(_BLANK))[spread]
                joined[put[1:] - 1] = _BLANK
                for lo in range(0, len(at), 1 << 16):
                    some = at[lo : lo + (1 << 16)]
                    yield from batches_of(out.add(lang, _text_array(joined, put[some], put[some + words[some] + 1] - 1)))
            del batch
        yield from batches_of(out.rest())
        X.release_memory()

    return cut_suffixes


def _subtree(least: int):
    def build(table: pa.Table) -> pa.Table:
        table = table.group_by(["lang", "suffix", "level"], use_threads=False).aggregate([("n", "sum")])
        lists = pc.split_pattern(table.column("suffix"), " ").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        codes = np.full((len(lists), DEPTH + 1), -1, np.int64)
        codes[:, 0] = table.column("lang").combine_chunks().dictionary_encode().indices.to_numpy() if table.num_rows else 0
        row = np.repeat(np.arange(len(lists)), sizes)
        codes[row, 1 + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = coded.indices.to_numpy()
        order = np.lexsort(codes.T[::-1])
        codes, sizes = codes[order], sizes[order]
        weights, level = table.column("n_sum").to_numpy()[order], table.column("level").to_numpy()[order]
        differs = np.ones(codes.shape, bool)
        differs[1:] = codes[1:] != codes[:-1]
        differs = np.logical_or.accumulate(differs, axis=1)
        langs, phrases, counts = [], [], []
        for depth in range(2, DEPTH + 1):
            starts = np.flatnonzero(differs[:, depth])
            total = np.add.reduceat(weights, starts) if len(starts) else np.zeros(0, np.int64)
            # a node of prefix length or deeper is whole; one above it has leaves elsewhere too
            good = (sizes[starts] >= depth) & ((total >= least) | (level[starts] > depth))
            at = pa.array(order[starts[good]])
            heads = pc.list_slice(lists.take(at), 0, depth)
            langs.append(table.column("lang").combine_chunks().take(at))
            phrases.append(pc.binary_join(heads, " ").cast(pa.string()))
            counts.append(pa.array(total[good], pa.int64()))
        depths = np.repeat(np.arange(2, DEPTH + 1), [len(x) for x in counts])
        return pa.table({"lang": pa.chunked_array(langs, pa.string()), "phrase": pa.chunked_array(phrases), "words": pa.array(depths, pa.int32()), "f": pa.chunked_array(counts, pa.int64())})

    return build


def _grouped(leaves: DataFrame, budget: int) -> DataFrame:
    """Leaves with ``level``, the words of their prefix, and ``grp``, their group."""
    total = leaves.count()
    bar = max(budget // 8, total // _MOST_PREFIXES)  # so at most _MOST_PREFIXES prefixes have more
    groups = max(-(-2 * total // budget), int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    prefix = lambda level: F.xxhash64("lang", F.substring_index("suffix", " ", level))
    rows = leaves.withColumn("level", F.lit(2))
    for level in range(2, DEPTH):
        full = rows.filter(F.col("level") == level).groupBy(prefix(level).alias("_long")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bar)
        full = F.broadcast(cut(full.select("_long"), "long_prefixes"))
        longer = (F.col("level") == level) & F.col("_long").isNotNull()
        rows = rows.join(full, prefix(level) == F.col("_long"), "left").withColumn("level", F.when(longer, level + 1).otherwise(F.col("level"))).drop("_long")
    return rows.withColumn("grp", F.pmod(F.xxhash64("lang", F.expr("substring_index(suffix, ' ', level)")), F.lit(groups)))


def phrase_counts(docs: DataFrame, least: int = 30, budget: int = 400_000) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): lang, phrase, words, f.

    ``words`` has every word with its number of occurrences, ``phrases`` the
    phrases of two to four words with ``least`` (255 at most) or more. ``docs``
    needs ``lang`` and ``text``; ``budget`` is the number of leaves a task
    should hold at once.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = S.bits_for(size // 6, spare=1)
    first = cut(texts.mapInArrow(_first_pass(bits), _FIRST_SCHEMA), "word_counts")
    held = spark.sparkContext.broadcast(S.reached(first.filter("slice is not null").select("slice", "places", "counts"), bits, 1, least))
    words = cut(first.filter("slice is null").groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("n").alias("f")), "words").withColumn("words", F.lit(1))
    leaves = cut(texts.mapInArrow(_leaves(bits, held), "lang string, suffix string, n long"), "suffixes")
    subtrees = _grouped(leaves, budget).groupBy("grp").applyInArrow(_subtree(least), "lang string, phrase string, words int, f long")
    nodes = subtrees.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    columns = ["lang", "phrase", "words", "f"]
    return words.select(columns), cut(nodes, "phrases").select(columns)


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, percent: int = 80, scale: int = 2_000_000, budget: int = 400_000, salts: int = 16) -> DataFrame:
    """The best ``most`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate's score is the lowest over its cuts of floor(scale * a / (l +
    r)); of equal ones the first cut counts. Candidates inside a longer one
    with at least ``percent`` of their occurrences are dropped.
    """
    words, phrases = phrase_counts(docs, least, budget)
    sums = words.groupBy("lang").agg(F.sum("f").alias("n"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")

    # Counts of the parts of all cuts. Very many phrases share one word, so the
    # word's row is repeated for a number of salts.
    salt = lambda part, size: F.when(size == 1, F.pmod(F.xxhash64("phrase", F.lit(part)), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    frequent = words.filter(F.col("f") >= least).unionByName(phrases)
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("words") == 1, salts - 1).otherwise(0)))
    known = frequent.select("lang", F.col("phrase").alias("part"), copies.alias("salt"), "f")
    cuts = phrases.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    for side, part, size in (("l", "substring_index(phrase, ' ', k)", F.col("k")), ("r", "substring_index(phrase, ' ', k - words)", F.col("words") - F.col("k"))):
        cuts = cuts.withColumn("part", F.expr(part)).withColumn("salt", salt(side, size))
        cuts = cuts.join(known.withColumnRenamed("f", side), ["lang", "part", "salt"]).drop("part", "salt")
    score = F.expr(f"cast({scale} as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))").cast("long")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))

    # The most frequent longer candidate around each phrase.
    listed = phrases.filter("words > 2").select("lang", "words", "f", F.split("phrase", " ").alias("w"))
    spans = F.expr("flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1), at -> array_join(slice(w, at, size), ' '))))")
    around = listed.select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    inside = F.coalesce(whole("longer") * 100 >= whole("a") * percent, F.lit(False))
    kept = best.join(around, ["lang", "phrase"], "left").filter(~inside).select("lang", "phrase", "a", "b.l", "b.r", "b.score")

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = kept.withColumn("rank", rank).filter(F.col("rank") <= most)
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
