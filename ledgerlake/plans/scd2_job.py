"""Cards SCD2 job: initial load or incremental merge, published as a new version."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import scd2
from ledgerlake.session import batch_id_for, fresh_dir
from ledgerlake.sinks.partitions import publish_partitions, published
from ledgerlake.sinks.publish import publish_version
from ledgerlake.sinks.writers import append_batch, table_exists_at

CLOSED_BY = "closed_by_batch"
_BUCKETS = "ledgerlake.buckets"


def run_cards_scd2(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    base_path: str,
    clock: _dt.datetime | str,
    batch_id: str | None = None,
    close_missing: bool = False,
    order: list[str] | None = None,
    bucket_count: int | None = None,
) -> str:
    """Create or extend the dimension behind catalog table ``table``.

    First run (no table): every incoming card becomes a current version.
    Later runs: one-join merge against the published version. The result
    is written as a new version and the table is moved to it, so the job
    never overwrites the files it reads. ``bucket_count`` publishes versions
    bucketed by ``card_id``, so the next merge reads the dimension without
    shuffling it (current versions are unique per key, so no bucket can hold
    a hot key). ``order``: columns of ``incoming`` that decide between rows
    with the same key; without it a repeated key is an error, on the first
    load too. Returns the version path.
    """
    batch_id = batch_id or batch_id_for(clock)
    cards = scd2.normalize_cards(incoming, keep=order)
    if spark.catalog.tableExists(table):
        result = scd2.merge(
            spark.table(table), cards, clock, batch_id, close_missing=close_missing, order=order
        )
    else:
        result = scd2.initial_versions(cards, clock, batch_id, order)
    bucket_by = (bucket_count, scd2.KEY) if bucket_count else None
    return publish_version(result, base_path, batch_id, table=table, bucket_by=bucket_by)


def run_cards_scd2_split(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    base_path: str,
    closed_path: str,
    clock: _dt.datetime | str,
    batch_id: str | None = None,
    close_missing: bool = False,
    order: list[str] | None = None,
    bucket_count: int | None = None,
) -> str:
    """As :func:`run_cards_scd2`, with closed versions in a log of their own.

    ``table`` holds the versions that are not closed and is published anew;
    versions that this batch closes are appended to ``closed_path``,
    partitioned by the batch that closed them, so closed versions are written
    once and never read by a merge. Running a batch again replaces its part of
    the log. :func:`dimension` gives the two together.
    """
    batch_id = batch_id or batch_id_for(clock)
    cards = scd2.normalize_cards(incoming, keep=order)
    if spark.catalog.tableExists(table):
        merged = scd2.merge(spark.table(table), cards, clock, batch_id, close_missing=close_missing, order=order)
    else:
        merged = scd2.initial_versions(cards, clock, batch_id, order)
    # computed once: the log and the published versions come from the same rows
    whole = fresh_dir(spark, "scd2_merged")
    merged.write.parquet(whole)
    merged = spark.read.schema(merged.schema).parquet(whole)
    closed = F.col("is_current").eqNullSafe(F.lit(False))
    append_batch(merged.filter(closed), closed_path, batch_id, CLOSED_BY)
    bucket_by = (bucket_count, scd2.KEY) if bucket_count else None
    return publish_version(merged.filter(~closed), base_path, batch_id, table=table, bucket_by=bucket_by)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(scd2.KEY), F.lit(buckets)).cast("int")


def run_cards_scd2_buckets(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    base_path: str,
    closed_path: str,
    clock: _dt.datetime | str,
    batch_id: str | None = None,
    close_missing: bool = False,
    order: list[str] | None = None,
    buckets: int = 64,
) -> list[int]:
    """As :func:`run_cards_scd2_split`, rewriting only the buckets that a batch changes.

    The versions that are not closed are partitioned by a hash of ``card_id``.
    A batch first finds its changed keys from keys and digests
    (:func:`ledgerlake.operators.scd2.changed_keys`), then merges and writes the
    buckets that hold one; the files of all others stay where they are
    (:mod:`ledgerlake.sinks.partitions`). ``buckets`` (fixed by the first load)
    is best chosen for files of some 100 MB: keys are unique among open
    versions, so buckets are even. A batch without a change writes no data.
    Returns the rewritten buckets, at most ``buckets`` numbers.
    """
    batch_id = batch_id or batch_id_for(clock)
    cards = scd2.normalize_cards(incoming, keep=order)
    version, _ = published(spark, table, base_path)
    if version is None:
        touched = list(range(buckets))
        merged = scd2.initial_versions(cards, clock, batch_id, order)
    else:
        buckets = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS}')").first()["value"])
        existing = spark.table(table)
        changes = fresh_dir(spark, "scd2_changes")
        scd2.changed_keys(existing, cards, close_missing, order).withColumn("bucket", _bucket(buckets)).write.parquet(changes)
        touched = sorted(r["bucket"] for r in spark.read.schema("bucket int").parquet(changes).distinct().collect())
        in_touched = F.col("bucket").isin(touched)
        some = cards.withColumn("bucket", _bucket(buckets)).filter(in_touched).drop("bucket")
        merged = scd2.merge(existing.filter(in_touched), some, clock, batch_id, close_missing=close_missing, order=order)
    whole = fresh_dir(spark, "scd2_merged")
    merged.write.parquet(whole)
    merged = spark.read.schema(merged.schema).parquet(whole)
    closed = F.col("is_current").eqNullSafe(F.lit(False))
    append_batch(merged.filter(closed), closed_path, batch_id, CLOSED_BY)
    schema = T.StructType([*merged.schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = merged.filter(~closed).withColumn("bucket", _bucket(buckets)).repartition(max(len(touched), 1), "bucket")
    publish_partitions(rows, table, base_path, batch_id, schema, ["bucket"], [(b,) for b in touched], {_BUCKETS: str(buckets)})
    return touched


def dimension(spark: SparkSession, table: str, closed_path: str) -> DataFrame:
    """All versions: those that are not closed and the log of closed ones."""
    live = spark.table(table).select(*scd2.COLUMNS)
    if not table_exists_at(spark, closed_path):
        return live
    return live.unionByName(spark.read.schema(live.schema).parquet(closed_path).select(*scd2.COLUMNS))
