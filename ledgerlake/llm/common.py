"""Helpers shared by the operators: tables, folds, scratch tables."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage with files every executor sees, so a lost executor costs
    a re-read and not a recomputation; the plan above knows its real size.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.crc32(key.cast("string")) % parts


def ident_hash(key: Column, seed: int) -> Column:
    """Uniform number in [0, 2**30) from the key; the same on every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30))


def keep_texts(docs: DataFrame, decider) -> DataFrame:
    """Rows of ``docs`` whose text is kept, with all columns and no shuffle.

    ``decider()`` is called once a task and gives a function from an Arrow
    column of texts to a boolean array.
    """
    docs = docs.filter("doc_id is not null")
    at = docs.columns.index("text")

    def keep(batches):
        decide = decider()
        for batch in batches:
            yield batch.filter(pa.array(decide(batch.column(at)), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def worker_cache(kind: str, key, make):
    """``make()``, kept by this Python process for later tasks that ask for the same key.

    One object a kind is kept; it lives in a module of its own, as the
    functions of this package reach the workers by value.
    """
    held = sys.modules.setdefault("_ledgerlake_worker_cache", types.ModuleType("_ledgerlake_worker_cache")).__dict__
    if held.get(kind, (None,))[0] != key:
        held[kind] = (key, make())
    return held[kind][1]
