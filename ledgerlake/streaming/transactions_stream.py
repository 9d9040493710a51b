"""Incremental refine of raw transactions with Structured Streaming.

The batch job picks the latest ingest day and appends it, and rerunning it
appends the same rows again. As a stream over the raw transactions
directory, every raw file is refined exactly once: the checkpoint records
which files were read and the parquet sink's log records which output files
were committed, so a restarted or retried query neither skips nor repeats
rows. The refine itself is the same stateless projection as the batch
builder, and by default no state store is involved.

A day that is ingested again arrives as new files. With ``dedupe_within`` the
stream keeps the digest of every row's identity (its day and raw id; without
an id, all raw values) in Spark's state store and drops rows it has seen. The
event time is ``ingest_time``, so the state holds what was ingested in that
time span before the newest row and no more: a day that is ingested again
later than that is refined again, and rows that arrive with an ``ingest_time``
older than the span are dropped as late (the progress of the query counts them;
ingestion stamps rows with its own clock, so only old files copied in can be).
The state deals rows by digest, so every task would hold rows of all days and
write a file for each; the rows are dealt by day once more, where a day with
more rows than a file takes goes to several tasks.

``trigger(availableNow=True)`` processes what has arrived and stops, which
makes the stream usable as a scheduled job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake import schemas
from ledgerlake.operators.refine import transactions_dated, transactions_refined
from ledgerlake.sinks.writers import row_identity


def raw_transactions_stream(
    spark: SparkSession,
    raw_path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of the raw transactions directory (ingest partitions included)."""
    reader = spark.readStream.schema(schema).option("basePath", raw_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(raw_path)


def _stretches(share: int):
    """Adds ``_stretch``: a task's rows of a day, numbered by runs of ``share`` of them."""
    parts = schemas.TRANSACTIONS_REFINED_PARTITIONS

    def number(batches):
        before: dict[int, int] = {}  # rows of each day so far
        for batch in batches:
            year, month, day = (batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in parts)
            days, of, rows = np.unique((year * 100 + month) * 100 + day, return_inverse=True, return_counts=True)
            at = np.empty(len(of), np.int64)
            at[np.argsort(of, kind="stable")] = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
            at += np.array([before.get(d, 0) for d in days.tolist()], np.int64)[of]
            for d, n in zip(days.tolist(), rows.tolist()):
                before[d] = before.get(d, 0) + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at // share)], names=[*batch.schema.names, "_stretch"])

    return number


def _by_day(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, which lie evenly in the shuffle partitions, dealt by day; a task gets about ``most`` rows of a day."""
    share = max(1, most // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([*rows.schema.fields, T.StructField("_stretch", T.LongType())])
    return rows.mapInArrow(_stretches(share), schema).repartition(*schemas.TRANSACTIONS_REFINED_PARTITIONS, "_stretch").drop("_stretch")


def refined_transactions_stream(
    spark: SparkSession,
    raw_path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    dedupe_within: str | None = None,
    max_records_per_file: int = 200000,
) -> DataFrame:
    """Dated, refined transactions as a streaming DataFrame."""
    raw = raw_transactions_stream(spark, raw_path, schema, max_files_per_trigger)
    if dedupe_within is None:
        return transactions_dated(transactions_refined(raw))
    raw = raw.withWatermark("ingest_time", dedupe_within)
    rows = transactions_dated(transactions_refined(raw, keep=["ingest_time"]))
    # 32 bytes of state a row, dealt to the state store's partitions by the digest
    fresh = rows.withColumn("_key", row_identity()).dropDuplicatesWithinWatermark(["_key"])
    return _by_day(fresh.select(*[f.name for f in schemas.TRANSACTIONS_REFINED.fields]), max_records_per_file)


def start_transactions_append(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    checkpoint: str,
    schema: T.StructType,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    max_records_per_file: int = 200000,
    dedupe_within: str | None = None,
) -> StreamingQuery:
    """Start the append stream into ``out_path`` partitioned by txn year / month / day.

    ``dedupe_within`` (such as ``"30 days"``): drop rows that were seen within
    this span of ingest time; see the module notes. It is a part of the
    checkpointed query, so it is given from the first run on or never.

    ``checkpoint`` must be on shared storage (for example below
    ``spark.checkpoint.dir``); it is what makes restarts exactly-once.
    """
    writer = (
        refined_transactions_stream(spark, raw_path, schema, max_files_per_trigger, dedupe_within, int(max_records_per_file))
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", int(max_records_per_file))
        .partitionBy(*schemas.TRANSACTIONS_REFINED_PARTITIONS)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
