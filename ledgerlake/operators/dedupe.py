"""Deterministic one-row-per-key selection.

``max(struct(order..., rest...))`` per key: a total order over the row, so
the survivor does not depend on partitioning or task retries (a retried task
yields the same row, which ``dropDuplicates``' arbitrary survivor does not
promise). The aggregate is partial: each map task keeps one row per key
before the shuffle, so a key holding a large share of all rows costs one
row per task, not one huge group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: greatest by ``order`` columns, ties by the other columns.

    NULL sorts below any value, so a present value wins over a missing one.
    Rows whose key is NULL form one group, as with ``dropDuplicates``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = order + rest
    if not ranked:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in ranked]).select(*df.columns)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (partial aggregate)."""
    return _key_counts(df, key).filter(F.col("rows") > 1)


def _key_counts(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def superseded_rows(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The rows that :func:`latest_per_key` drops, each as often as it is dropped.

    Rows are counted per value and one of the survivor's value is taken off,
    so a key with very many rows costs aggregates only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    best = latest_per_key(df, keys, order).withColumn("_best", F.lit(1))
    same = [rows[c].eqNullSafe(best[c]) for c in df.columns]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    left = rows.join(best.select(*df.columns, "_best"), condition, "left").withColumn("_n", F.col("_n") - F.coalesce("_best", F.lit(0)))
    return left.filter("_n > 0").select(*[rows[c] for c in df.columns], F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy")).drop("_copy")


def refuse_repeats(result: DataFrame, df: DataFrame, key: str | list[str], what: str) -> DataFrame:
    """``result``, which fails when it is computed if a key of ``df`` repeats.

    The check is a branch of the same plan (a union with one row for each
    repeated key), so nothing runs while the plan is built, the plan is the
    same for all data, and the joins in ``result`` read ``df`` as it is. Every
    column of the branch raises when its value is needed, so no filter,
    projection or aggregate over the result can prune the check; only a limit
    that is met before the branch is read can end without it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"{what} has duplicate keys, e.g. "), shown, F.lit(" in "), F.col("rows").cast("string"), F.lit(" rows"))
    # the condition is part of every expression: reordered or pushed down, it raises for repeated keys only
    raised = lambda kind: F.when(F.col("rows") > 1, F.raise_error(message).cast(kind))
    none = _key_counts(df, keys).filter(raised("string").isNotNull())
    return result.union(none.select(*[raised(f.dataType).alias(f.name) for f in result.schema.fields]))
