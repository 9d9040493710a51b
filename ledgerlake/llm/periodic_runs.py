"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least ``max(least, times * q)``, ``times``
being 4 or more, that no neighbouring word extends keeping period q.

Per text, over word numbers (equal words of a text share one):

1. Prefix doubling sorts all suffixes; after step k it also ranks every block
   of 2**k words, so a block's occurrences are one interval of the suffix
   array. The wavelet tree of the suffix array answers *range successor*: the
   smallest position not below x in an interval.
2. A run of period q has, for L = 2**k with L <= q < 2L, a dyadic block (it
   starts at a multiple of L and is L words long) that starts among its first
   L words and stands again q words on, so in the neighbouring window of
   starts L .. 2L - 1 words on. The occurrences of the block in that window
   are one arithmetic progression: range successor gives its first and second
   member, the count of the window its size.
3. One or two occurrences are candidate periods as they stand. Three or more
   mean that the block and the progression have its step as a period; in the
   run, the stretch of that period around the block ends q words before the one
   around the progression, so the difference of these ends is the candidate.
   At most two candidates a block, and so a number linear in the words.
4. A candidate is extended to both sides by longest common extensions (the
   ranks of step 1, largest block first) and kept if it is long enough. Of
   equal stretches the smallest period is the run's.

Word numbers of different texts differ, so many short texts are done at once
as one sequence and nothing crosses from text to text. All comparisons are of
words and ranks, so results are exact. On Spark this is one narrow pass
without a shuffle. Memory follows a slice of about a megabyte, or the longest
single text: 4 bytes a word and level, log2 of the longest repeat in a text
being the number of levels.

Defined cases: a NULL or empty text has no run; rows that share a ``doc_id``
each give their own row; rows with a NULL ``doc_id`` are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X


def _word_numbers(text: bytes, first: int, piece: int = 1 << 22) -> tuple[list[bytes], np.ndarray]:
    """Words of a text and numbers from ``first`` on, equal for equal words."""
    words, numbers, known, at = [], [], {}, 0
    while at < len(text):
        end = at + piece
        while end < len(text) and not X.SPACE[text[end]]:
            end += 1
        some = text[at:end].split()
        numbers.append(np.fromiter(map(known.setdefault, some, itertools.count(first + len(words))), np.int64, len(some)))
        words += some
        at = end
    return words, np.concatenate(numbers) if numbers else np.zeros(0, np.int64)


class _Ranks:
    """Suffix order of a number sequence, and the ranks of all blocks of 2**k numbers.

    ``levels[k][i]`` is the rank of block i .. i + 2**k - 1: the place of its
    interval in the suffix array. A block that reaches over the end is smaller
    than any that continues it.
    """

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        order = np.argsort(numbers, kind="stable")
        held = numbers[order]
        new = np.ones(n, bool)
        new[1:] = held[1:] != held[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=n)
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(starts, sizes)
        self.levels, self.sizes = [rank], []
        size = np.ones(n, np.int32)
        size[starts] = sizes
        self.sizes.append(size)  # by rank
        places = np.flatnonzero(np.repeat(sizes, sizes) > 1)  # of the suffix array, not yet alone
        k = 0
        while len(places):
            step = 1 << k
            some = order[places]
            follow = np.where(some + step < n, rank[np.minimum(some + step, n - 1)].astype(np.int64) + 1, 0)
            key = rank[some].astype(np.int64) * (n + 1) + follow
            by = np.argsort(key, kind="stable")
            some, key = some[by], key[by]
            order[places] = some
            new = np.ones(len(some), bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            sizes = np.diff(starts, append=len(some))
            rank = rank.copy()
            rank[some] = np.repeat(places[starts], sizes)
            size = np.ones(n, np.int32)
            size[places[starts]] = sizes
            self.levels.append(rank)
            self.sizes.append(size)
            places = places[np.repeat(sizes, sizes) > 1]
            k += 1
        self.order, self.n = order, n

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j on."""
        i, j, n = i.copy(), j.copy(), self.n
        start = i.copy()
        for k in range(len(self.levels) - 1, -1, -1):  # no block of the last level repeats, so one look a level is enough
            level, step = self.levels[k], 1 << k
            inside = (i + step <= n) & (j + step <= n)
            equal = inside & (level[np.minimum(i, n - 1)] == level[np.minimum(j, n - 1)])
            i += equal * step
            j += equal * step
        return i - start

    def extend_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words before i and j."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            inside = (i >= step) & (j >= step)
            equal = inside & (level[np.maximum(i - step, 0)] == level[np.maximum(j - step, 0)])
            i -= equal * step
            j -= equal * step
        return start - i


class _WaveletTree:
    """Values 0 .. n - 1 in some order: counts and order statistics of intervals."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values) - 1).bit_length(), 1)
        self.zeros = []  # per level, the number of zero bits before each place
        for level in range(self.bits - 1, -1, -1):
            one = (values >> level & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, dtype=np.int32, out=zeros[1:])
            self.zeros.append(zeros)
            values = np.concatenate([values[~one], values[one]])

    def count_below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Number of values below ``bound`` in places lo .. hi - 1."""
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        over = bound >= 1 << self.bits
        found = np.where(over, hi - lo, 0)
        for level, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            one = (bound >> level & 1).astype(bool)
            zlo, zhi = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            found += np.where(one & ~over, zhi - zlo, 0)
            lo, hi = np.where(one, zeros[-1] + lo - zlo, zlo), np.where(one, zeros[-1] + hi - zhi, zhi)
        return found

    def nth(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value with ``nth`` smaller ones in places lo .. hi - 1."""
        lo, hi, nth = lo.astype(np.int64), hi.astype(np.int64), nth.astype(np.int64)
        value = np.zeros(len(lo), np.int64)
        for level, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            zlo, zhi = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            one = nth >= zhi - zlo
            value |= one.astype(np.int64) << level
            nth -= np.where(one, zhi - zlo, 0)
            lo, hi = np.where(one, zeros[-1] + lo - zlo, zlo), np.where(one, zeros[-1] + hi - zhi, zhi)
        return value


def _candidates(ranks: _Ranks, tree: _WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of a dyadic block of 2**k words, candidate period)."""
    size = 1 << k
    blocks = np.arange(0, ranks.n - size + 1, size)
    lo = ranks.levels[k][blocks].astype(np.int64)
    several = ranks.sizes[k][lo] > 1
    blocks, lo = blocks[several], lo[several]
    hi = lo + ranks.sizes[k][lo]
    before = tree.count_below(lo, hi, blocks + size)
    there = tree.count_below(lo, hi, blocks + 2 * size) - before  # occurrences in the window
    some = there > 0
    blocks, lo, hi, before, there = (x[some] for x in (blocks, lo, hi, before, there))
    first = tree.nth(lo, hi, before)
    more = np.flatnonzero(there > 1)
    second = tree.nth(lo[more], hi[more], before[more] + 1)
    few, many = there[more] == 2, there[more] > 2
    long_, p = more[many], second[many] - first[more[many]]
    ends = ranks.extend(blocks[long_], blocks[long_] + p), ranks.extend(first[long_], first[long_] + p)
    apart = first[long_] + ends[1] - blocks[long_] - ends[0]
    starts = [blocks[there <= 2], blocks[more[few]], blocks[long_]]
    periods = [(first - blocks)[there <= 2], second[few] - blocks[more[few]], apart]
    starts, periods = np.concatenate(starts), np.concatenate(periods)
    fits = (periods >= size) & (periods < 2 * size)
    return starts[fits], periods[fits]


def runs_of(numbers: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a number sequence, by start, then period."""
    none = np.zeros(0, np.int64)
    if len(numbers) < max(least, times):
        return none, none, none
    ranks = _Ranks(numbers)
    tree = _WaveletTree(ranks.order) if len(ranks.levels) > 1 else None
    found = [(none, none, none)]
    for k in range(len(ranks.levels) if tree is not None else 0):
        at, period = _candidates(ranks, tree, k)
        starts = at - ranks.extend_left(at, at + period)
        ends = at + period + ranks.extend(at, at + period)
        good = ends - starts >= np.maximum(least, times * period)
        found.append((starts[good], ends[good] - starts[good], period[good]))
    starts, lengths, periods = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((periods, lengths, starts))
    starts, lengths, periods = starts[order], lengths[order], periods[order]
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1]) | (lengths[1:] != lengths[:-1])
    starts, lengths, periods = starts[new], lengths[new], periods[new]
    order = np.lexsort((periods, starts))
    return starts[order], lengths[order], periods[order]


_SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _finder(least: int, times: int):
    parts = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches):
        for batch in batches:
            for at, data, offsets in X.text_slices(batch.column(1)):
                raw, cuts, numbers, total = data.tobytes(), offsets.tolist(), [], 0
                words = []
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    some, ids = _word_numbers(raw[lo:hi], total)
                    words.append(some)
                    numbers.append(ids)
                    total += len(some)
                first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
                starts, lengths, periods = runs_of(np.concatenate(numbers), least, times)
                change = np.zeros(total + 1, np.int64)
                np.add.at(change, starts + periods, 1)
                np.add.at(change, starts + lengths, -1)
                keep = np.cumsum(change[:-1]) == 0
                owner = np.searchsorted(first, starts, side="right") - 1
                ends = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(starts - first[owner]), pa.array(lengths), pa.array(periods)], fields=list(parts))
                kept = [b" ".join(itertools.compress(w, keep[lo:hi].tolist())) for w, lo, hi in zip(words, first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(words)), pa.ListArray.from_arrays(ends, values), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )
            del batch
        X.release_memory()

    return find


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed, one row per document.

    ``collapsed`` is the text without the words that a run repeats: those that
    any run contains after its first period; words are joined by one blank.
    """
    if times < 4:
        raise ValueError("a dyadic block is sure to lie in runs of four periods and more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    return docs.mapInArrow(_finder(least, times), _SCHEMA)


def run_report(found: DataFrame) -> DataFrame:
    """n_runs, the longest run and digests of all runs and of the collapsed text, per document."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.select("*", F.array_max(ranked).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
