"""Mixing sources to target weights by weighted fair queueing.

Sources get weights; their targets share ``budget`` (a multiple of all tokens)
by weight, none above ``repeat`` times its own tokens, the excess shared again
by weight. Every source is shuffled by a hash of the document ids and read
``repeat`` times over. A document's virtual finish time is the tokens of its
source up to and with it, divided by the target of its source. All documents
of all sources are taken in the order of virtual finish time until the budget
is used; so every source is served in proportion to its target at every
moment, and at the end is within about one document of it.

Sums up to a document are taken in two levels: over bins of the shuffled
order of a source (or of virtual time) and inside a bin, so no source is ever
gathered in one task. The place where the order is truncated is one row.

Defined cases: an empty or NULL text has 0 tokens and is never taken; a NULL
source is a source of its own, in last place; rows with a NULL id are left
out; rows that repeat an id are queued one after the other; without tokens all
targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut

WEIGHTS = (3, 1, 2)
TIME_BINS = 4096  # of virtual time from 0 to 1


def word_count(text: Column) -> Column:
    """Runs of bytes outside ASCII white space; NULL has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, repeat: int = 2) -> DataFrame:
    """source, no (place in the order of sources, from 0), source_size, target.

    ``sizes``: source, size. Sources are ordered by code point, NULL last. The
    common level of the targets that are below their bounds is found by going
    through the sources by bound per weight.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    no = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    found = found.select("source", no.alias("no"), "source_size").withColumn("weight", weight).withColumn("bound", F.col("source_size") * repeat)
    order = Window.orderBy(F.col("bound") / F.col("weight"), "no")
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) * F.lit(float(budget)) - before) / after
    found = found.withColumn("level", level)
    ratio = F.col("bound") / F.col("weight")
    first = F.min(F.when(F.col("level") <= ratio, F.struct(ratio.alias("ratio"), "no", "level"))).over(whole)
    common = first["level"]
    share = F.least(F.col("weight") * F.coalesce(common, F.lit(float("inf"))), F.col("bound").cast("double"))
    return found.select("source", F.col("no").cast("int").alias("no"), "source_size", share.alias("target"))


def _queue(docs: DataFrame, seed: str, weights: Sequence[int], budget: float, repeat: int, bin_digits: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the tokens of their source up to and with them; the targets."""
    sizes = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size")
    )
    sizes = cut(sizes.withColumn("drawn", F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))), "mix_sizes")
    shares = cut(targets(sizes, weights, budget, repeat), "mix_targets")
    rows = sizes.join(shares, sizes["source"].eqNullSafe(shares["source"])).select("doc_id", "size", "drawn", "no", "source_size", "target")
    rows = rows.withColumn("bin", F.substring("drawn", 1, bin_digits))
    bins = rows.groupBy("no", "bin").agg(F.sum("size").alias("in_bin"))
    earlier = Window.partitionBy("no").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = cut(bins.select("no", "bin", F.coalesce(F.sum("in_bin").over(earlier), F.lit(0)).alias("before")), "mix_bins")
    inside = Window.partitionBy("no", "bin").orderBy("drawn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = rows.join(bins, ["no", "bin"]).select(
        "doc_id", "size", "drawn", "no", "source_size", "target", (F.col("before") + F.sum("size").over(inside)).alias("upto")
    )
    return cut(queued, "mix_queue"), shares


def _entries(queue: DataFrame, repeat: int) -> DataFrame:
    """One row per document and reading, with its virtual finish time."""
    copies = queue.filter("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    time = (F.col("copy") * F.col("source_size") + F.col("upto")) / F.col("target")
    return copies.select("doc_id", "size", "drawn", "no", "copy", time.alias("time")).withColumn("bin", F.least(F.floor(F.col("time") * TIME_BINS), F.lit(2 * TIME_BINS)))


_PLACE = ("time", "no", "drawn", "doc_id", "size", "copy")


def _last_taken(entries: DataFrame, total: int) -> tuple | None:
    """Place of the last entry, in the order of virtual time, up to which at most ``total`` tokens are taken."""
    order = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = entries.groupBy("bin").agg(F.sum("size").alias("in_bin")).select("bin", F.sum("in_bin").over(order).alias("upto"), "in_bin")
    over = bins.filter(F.col("upto") > total).orderBy("bin").limit(1).collect()
    if over:
        inner = Window.orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = entries.filter(F.col("bin") == over[0]["bin"]).withColumn("upto", F.lit(over[0]["upto"] - over[0]["in_bin"]) + F.sum("size").over(inner))
        found = last.filter(F.col("upto") <= total).orderBy(*[F.desc(c) for c in _PLACE]).limit(1).collect()
        if found:
            return tuple(found[0][c] for c in _PLACE)
        entries = entries.filter(F.col("bin") < over[0]["bin"])
    found = entries.orderBy(*[F.desc(c) for c in _PLACE]).limit(1).collect()
    return tuple(found[0][c] for c in _PLACE) if found else None


def mix_plan(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, budget: float = 1.5, repeat: int = 2, bin_digits: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every document.

    ``docs``: doc_id, text, source. ``copies``: how often the mix takes it.
    """
    queue, shares = _queue(docs, seed, weights, budget, repeat, bin_digits)
    whole = shares.agg(F.sum("source_size").alias("all")).collect()[0]["all"] or 0
    last = _last_taken(_entries(queue, repeat), int(whole * budget))
    copies = F.lit(0)
    if last is not None:
        kinds = dict(time="double", no="int", drawn="string", doc_id="long", size="long", copy="int")
        end = F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(_PLACE, last)])
        for k in range(repeat):
            time = (F.lit(k) * F.col("source_size") + F.col("upto")) / F.col("target")
            place = F.struct(time.alias("time"), F.col("no").alias("no"), F.col("drawn").alias("drawn"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"), F.lit(k).cast("int").alias("copy"))
            copies = copies + F.when((F.col("size") > 0) & (F.col("target") > 0), (place <= end).cast("int")).otherwise(F.lit(0))
    rows = queue.select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"))
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows that repeat an id share one decision, the greatest of theirs.
    """
    plan = mix_plan(docs, **options).filter("copies > 0")
    decided = plan.groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    chosen = docs.join(decided, F.col("doc_id").cast("long") == F.col("_id"))
    return chosen.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copy")
