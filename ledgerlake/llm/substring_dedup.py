"""Repeated passages: words of windows that an earlier document has too.

A window is ``words`` consecutive words (white space apart, unchanged) of one
document. Every word is removed that lies in a window whose words also stand,
in this order and without a gap, in a document with a smaller id. Windows are
judged on the input.

1. *Prefilter.* Each task counts windows into a count-min sketch
   (:mod:`ledgerlake.llm.sketch`); the merged sketch overestimates in how many
   rows a window stands. To keep it small a window is counted under its anchor,
   the stretch of ``anchor`` words in it with the smallest hash: equal windows
   have equal anchors, and neighbouring windows mostly share one, so a text
   adds about 2 / (words - anchor + 2) anchors a word, each once a text. A
   window in two documents has an anchor counted twice or more: none is lost.
2. *Exact grouping* of the windows estimated repeated, by a 96-bit hash. They
   are sorted over all tasks by hash and document, so the first of a group is
   its smallest document and any other document's window is removed. A group
   that lies across tasks (a passage of very many documents does) is split by
   document between them: the few groups at the ends of tasks, two a task at
   most, are compared with their first document in a second step.
3. Each text meets the starts of its removed windows and is cut.

The sketch is sized by the bytes of text up to 2 * 32 MB; beyond about 1e9
words it lets more windows pass, which costs work, not rows.

Defined cases: a NULL or empty text has no word; texts of fewer than ``words``
words keep all; rows that share a ``doc_id`` do not remove each other's words
and each gives its own row; rows with a NULL ``doc_id`` are left out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import sketch as S
from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import cut

ROWS = 2  # of the sketch


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each stretch of ``width`` values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _windows(data: np.ndarray, offsets: np.ndarray, words: int, anchor: int, full: bool):
    """Row, first word and anchor of each window of a run of texts; its two hashes if ``full``."""
    starts, ends, first = X.word_spans(data, offsets)
    if len(starts) < words:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none.astype(np.int64), none, (none, none)
    sums = X.sequence_sums(X.span_hashes(X.prefix_sums(data, X.EXACT_VALUES[0]), starts, ends))
    anchors = _least_of(X.window_hashes(sums, anchor), words - anchor + 1)
    places = np.arange(len(anchors))
    row = np.searchsorted(first, places, side="right") - 1
    inside = np.flatnonzero(places + words <= first[row + 1])
    hashes = ()
    if full:
        other = X.sequence_sums(X.span_hashes(X.prefix_sums(data, X.EXACT_VALUES[1]), starts, ends))
        hashes = tuple(X.window_hashes(s, words)[inside] for s in (sums, other))
    return row[inside], inside - first[row[inside]], anchors[inside], hashes


def _counter(words: int, anchor: int, bits: int):
    def count(batches):
        sketch = S.Counter(bits, ROWS)
        for batch in batches:
            for _, data, offsets in X.text_slices(batch.column(0)):
                row, _, anchors, _ = _windows(data, offsets, words, anchor, False)
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (anchors[1:] != anchors[:-1])
                row, anchors = row[new], anchors[new]
                order = np.lexsort((anchors, row))
                row, anchors = row[order], anchors[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (anchors[1:] != anchors[:-1])
                yield from sketch.add(anchors[new])
            del batch
        yield from sketch.batches()
        X.release_memory()

    return count


def _finder(words: int, anchor: int, bits: int, held):
    def find(batches):
        bitmap = held.value
        for batch in batches:
            for at, data, offsets in X.text_slices(batch.column(2)):
                row, start, anchors, (one, two) = _windows(data, offsets, words, anchor, True)
                may = S.passes(bitmap, anchors, bits)
                row, start = pa.array(row[may] + at), start[may]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[may].view(np.int64)), pa.array((two[may] >> np.uint64(32)).astype(np.uint32).view(np.int32)), batch.column(0).take(row), batch.column(1).take(row), pa.array(start.astype(np.int32))],
                    names=["h1", "h2", "doc_id", "row", "start"],
                )
            del batch
        X.release_memory()

    return find


def _marker(batches):
    """Windows that are not the first of their group, of rows sorted by hash and document.

    The smallest document's rows of the task's first group are given out with
    hash and document, as the group may begin in another task; so is the last
    group's smallest document, without a row, as the group may go on in another.
    """
    first, last, least = None, None, None

    def out(h1, h2, doc, row, start):
        return pa.RecordBatch.from_arrays([h1, h2, doc, row, start], names=["h1", "h2", "doc_id", "row", "start"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(i).to_numpy() for i in range(3))
        if first is None:
            first = last = (h1[0], h2[0])
            least = doc[0]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(new)
        firsts = doc[starts]
        if (h1[0], h2[0]) == last:
            firsts[0] = least
        smallest = np.repeat(firsts, np.diff(starts, append=len(h1)))
        last, least = (h1[-1], h2[-1]), smallest[-1]
        pending = (h1 == first[0]) & (h2 == first[1]) & (doc == smallest)
        given = np.flatnonzero(pending | (doc > smallest))
        hidden = ~pending[given]
        some = [pa.array(x[given], mask=hidden) for x in (h1, h2, doc)]
        yield out(*some, *(batch.column(i).take(pa.array(given)) for i in (3, 4)))
    if last is not None:
        yield out(pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int32()), pa.array([least], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()))


def _cutter(words: int):
    def cut_texts(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            kept, n_words, n_removed = [], [], []
            for text, starts in zip(texts, batch.column(2)):
                some = text.as_buffer().to_pybytes().split()
                if starts.is_valid:
                    change = np.zeros(len(some) + 1, np.int64)
                    at = np.unique(starts.values.to_numpy())
                    np.add.at(change, at, 1)
                    np.add.at(change, at + words, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    left = list(itertools.compress(some, keep.tolist()))
                else:
                    left = some
                kept.append(b" ".join(left))
                n_words.append(len(some))
                n_removed.append(len(some) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )
            del batch
        X.release_memory()

    return cut_texts


def repeated_windows(docs: DataFrame, words: int, anchor: int) -> DataFrame:
    """(row, start) of the windows that a document with a smaller id has too.

    ``docs``: doc_id, row (a key of the row's id and text), text.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = S.bits_for(int(size * 2 / (words - anchor + 2) / 6))
    counted = docs.select("text").mapInArrow(_counter(words, anchor, bits), S.SCHEMA)
    held = spark.sparkContext.broadcast(S.reached(counted, bits, ROWS, 2))
    found = docs.select("doc_id", "row", "text").mapInArrow(_finder(words, anchor, bits, held), "h1 long, h2 int, doc_id long, row long, start int")
    by = ["h1", "h2", "doc_id"]
    marked = cut(found.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_marker, found.schema), "repeated_windows")
    ends = marked.filter("h1 is not null")
    firsts = F.broadcast(ends.groupBy("h1", "h2").agg(F.min("doc_id").alias("first")))  # two rows a task at most
    late = ends.filter("row is not null").join(firsts, ["h1", "h2"]).filter("first < doc_id")
    return marked.filter("h1 is null").select("row", "start").unionByName(late.select("row", "start"))


def without_repeats(docs: DataFrame, words: int = 50, anchor: int = 16) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one blank), one row per document."""
    if not 1 <= anchor <= words:
        raise ValueError("an anchor is a part of a window")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    starts = repeated_windows(docs, words, anchor).groupBy("row").agg(F.collect_list("start").alias("starts"))
    met = docs.join(starts, "row", "left").select("doc_id", "text", "starts")
    return met.mapInArrow(_cutter(words), "doc_id long, n_words long, n_removed long, kept_text string")
