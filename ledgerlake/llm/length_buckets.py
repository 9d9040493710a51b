"""Packing into optimal length buckets.

Lengths are counted over all documents (one global histogram). Dynamic
programming over the histogram chooses at most ``buckets`` bucket lengths that
minimise the padding when every document is padded to the smallest bucket
length that holds it. Inside a bucket, batches are formed of as many documents
as the token budget holds at that length, one at least.

The histogram holds every length as it is, so the choice is optimal. Its size
is bounded by the data: n distinct lengths need about n * n / 2 tokens, so
5e9 words have 1e5 of them at most. With ``digits``, lengths are rounded up to
that many significant binary digits, less than 2 ** digits * 64 of them
whatever ``length`` is, and padding is least for the rounded lengths. Batches are
numbered inside (bucket, shard), a shard being a hash share of a bucket of
about ``shard_docs`` documents; so a bucket that holds a third of all
documents is spread, and only the last batch of a shard can be short.

Defined cases: a NULL or empty text has no tokens and is packed as length 0 in
the smallest bucket; documents above the budget fill a batch alone; rows with
a NULL id are left out; repeated rows are packed each; an empty table gives
no batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut
from ledgerlake.llm.fair_mix import word_count


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket lengths (ascending, the last is the greatest length) with the least padding.

    ``lengths``: distinct, ascending. Cost of a bucket from i to j: documents in
    it times lengths[j], less their lengths. The best start of the last bucket
    moves up with its end, so each row of the table is filled by halving.
    """
    n = len(lengths)
    if not n:
        return []
    docs = np.concatenate([[0], np.cumsum(counts)])
    best = lengths * docs[1:]  # one bucket; the sum of lengths is the same for all choices
    choice = []
    for _ in range(min(buckets, n) - 1):
        row, start = np.empty(n, np.int64), np.zeros(n, np.int64)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            lo, hi, first, last = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(j, last) + 1)  # the last bucket holds i .. j
            cost = np.where(i > 0, best[i - 1], 0) + lengths[j] * (docs[j + 1] - docs[i])
            at = int(np.argmin(cost))
            row[j], start[j] = cost[at], i[at]
            todo += [(lo, j - 1, first, int(i[at])), (j + 1, hi, int(i[at]), last)]
        best = row
        choice.append(start)
    bounds, j = [], n - 1
    for start in reversed(choice):
        bounds.append(int(lengths[j]))
        j = int(start[j]) - 1
        if j < 0:
            return bounds[::-1]
    return [int(lengths[j])] + bounds[::-1]


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 16384, digits: int | None = None, shard_docs: int = 20000, length: Column | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket_length, batch_id, batch_docs, padding.

    ``docs``: doc_id and text, or whatever ``length`` needs (default: words).
    ``batch_id`` is unique over all buckets; ``padding`` is what the document
    is filled up with.
    """
    length = word_count(F.col("text").cast("string")) if length is None else length
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), length.cast("long").alias("n_tokens"))
    rows = cut(rows, "lengths")  # texts are counted once, for the histogram and the batches
    rounded = F.col("n_tokens")
    if digits is not None:
        unit = f"shiftleft(1L, greatest(length(bin(n_tokens)) - {digits}, 0))"
        rounded = F.expr(f"((n_tokens + {unit} - 1) div {unit}) * {unit}")
    histogram = rows.select(rounded.alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()
    lengths, counts = (np.array([r[c] for r in histogram], np.int64) for c in ("length", "n"))
    bounds = optimal_bounds(lengths, counts, buckets)
    if not bounds:
        bounds = [0]
    edges = np.searchsorted(lengths, bounds, side="right")
    held = np.diff(np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], edges])]) if len(lengths) else np.zeros(1, np.int64)
    capacity = [max(1, token_budget // max(b, 1)) for b in bounds]
    shards = [max(1, -(-int(n) // shard_docs)) for n in held]
    table = lambda values: F.array(*[F.lit(int(v)).cast("long") for v in values])
    place = F.expr(f"aggregate(array({', '.join(f'{b}L' for b in bounds)}), 1, (k, b) -> if(n_tokens > b, k + 1, k))")
    rows = rows.select("doc_id", "n_tokens", place.alias("bucket"))
    pick = lambda values: F.element_at(table(values), F.col("bucket"))
    rows = rows.select("doc_id", "n_tokens", "bucket", pick(bounds).alias("bucket_length"), pick(capacity).alias("capacity"), F.pmod(F.xxhash64("doc_id", "n_tokens"), pick(shards)).alias("shard"))
    order = Window.partitionBy("bucket", "shard").orderBy(F.xxhash64("doc_id"), "doc_id", "n_tokens")
    rows = rows.withColumn("at", F.floor((F.row_number().over(order) - 1) / F.col("capacity")))
    in_batch = F.count(F.lit(1)).over(Window.partitionBy("bucket", "shard"))
    batch_docs = F.least(F.col("capacity"), F.col("in_shard") - F.col("at") * F.col("capacity"))
    batch_id = F.concat_ws("-", F.col("bucket_length").cast("string"), F.col("shard").cast("string"), F.col("at").cast("string"))
    return rows.withColumn("in_shard", in_batch).select(
        "doc_id", "n_tokens", "bucket_length", batch_id.alias("batch_id"), batch_docs.cast("long").alias("batch_docs"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding")
    )
