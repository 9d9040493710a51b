"""Parquet writers for raw, index, history and refined tables.

* Overwrites default to *dynamic* partition overwrite: only the partitions
  present in the written data are replaced, so ingesting a new day keeps the
  earlier days (``dynamic=False`` restores Spark's static overwrite, which
  clears the whole table first).
* ``rebalance`` adds a ``REBALANCE`` hint on the partition columns: one
  shuffle after which AQE sizes output files to the advisory partition size
  and splits a partition value that holds a large share of the rows over
  several tasks, instead of one task per value.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.derived import row_digest
from ledgerlake.operators.dedupe import latest_per_key
from ledgerlake.operators.refine import flag_counts, transactions_dated, transactions_undated


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    dynamic: bool = True,
    rebalance: bool = False,
    max_records_per_file: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write parquet, optionally partitioned; see the module notes for the options.

    ``options`` go to the parquet writer, such as :func:`bloom_options`.
    """
    parts = list(partition_by or [])
    if rebalance and parts:
        df = df.hint("rebalance", *parts)
    writer = df.write.mode(mode).options(**(options or {}))
    if mode == "overwrite" and parts:
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def clustered(df: DataFrame, key: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` dealt by ranges of ``key`` within the partition columns and sorted by it.

    Files and row groups then hold narrow ranges of the key, so a lookup by
    literal keys skips the others by their minimum and maximum. Rows that share
    a key are dealt by a hash of the row as well, so a key with very many rows
    lies in several files.
    """
    parts = list(partition_by or [])
    spread = F.xxhash64(*[c for c in df.columns if c not in (*parts, key)])
    return df.repartitionByRange(*parts, key, spread).sortWithinPartitions(*parts, key)


def bloom_options(*columns: str, distinct: int = 1_000_000) -> dict[str, str]:
    """Parquet writer options for a bloom filter per row group on each column.

    ``distinct``: values a row group is expected to hold; more raise the rate
    of false positives, which cost a read and no row.
    """
    options = {}
    for c in columns:
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{c}"] = str(int(distinct))
    return options


_SAFE_VALUE = re.compile(r"[0-9A-Za-z_.-]+")


def append_batch(df: DataFrame, path: str, batch_id: str, batch_column: str = "batch_id") -> None:
    """Create-or-extend an append-only log partitioned by batch.

    The partition of ``batch_id`` is overwritten by the rows of ``df`` (its
    ``batch_column``, if any, is left out and read back from the partition), so
    rerunning a batch does not double it, a rerun without rows clears it, and
    earlier batches are never rewritten.
    """
    if not _SAFE_VALUE.fullmatch(batch_id):
        raise ValueError(f"batch id {batch_id!r} may hold letters, digits, '.', '_' and '-' only")
    df.drop(batch_column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{batch_column}={batch_id}")


def table_exists_at(spark, path: str, schema=None) -> bool:
    """Whether there is a parquet table at ``path``.

    Only a missing path (or one without files to take a schema from) counts as
    absent; any other failure is raised. With a declared schema no footer is read.
    """
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        reader.parquet(path)
        return True
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def has_sink_log(spark, path: str) -> bool:
    """Whether a streaming file sink owns ``path`` (readers follow its log)."""
    return _text_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def _text_exists(spark, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


# Raw columns that tell transactions apart; all of them for rows without an id.
_WITHOUT_ID = ["txn_timestamp", "client_id_raw", "card_id_raw", "amount_raw", "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors"]


def _row_key() -> Column:
    """Identity of a refined transaction within its day: the raw id, else the whole row's raw values."""
    values = F.to_json(F.struct(*_WITHOUT_ID))
    return F.struct(F.col("transaction_id_raw").alias("id"), F.when(F.col("transaction_id_raw").isNull(), values).alias("values"))


def row_identity() -> Column:
    """Digest of what tells refined transactions apart: the day and the raw id, else all raw values."""
    parts = schemas.TRANSACTIONS_REFINED_PARTITIONS
    return F.when(F.col("transaction_id_raw").isNotNull(), row_digest([*parts, "transaction_id_raw"])).otherwise(row_digest([*parts, *_WITHOUT_ID]))


def append_refined_transactions(
    refined: DataFrame,
    path: str | None = None,
    max_records_per_file: int = 200000,
    dedupe: bool = False,
    table: str | None = None,
) -> None:
    """Incremental append of refined transactions by txn year / month / day.

    Rows without a parsed date are dropped. One write replaces the
    reference's per-month loop; the ``REBALANCE`` hint spreads a busy day
    over several writers and caps file sizes, ``maxRecordsPerFile`` caps rows
    per file.

    ``dedupe`` makes the append idempotent: a row whose raw id (for rows
    without one: whose raw values) already stands in the same day, or earlier
    in the batch, is skipped; of equal keys in the batch the greatest row is
    kept. The target is read between the first and the last day of the batch
    (one row of day bounds, then a partition filter), and only the key columns.

    With ``table`` (a partitioned catalog table, see
    :func:`ledgerlake.sinks.catalog.register_table`) instead of ``path``, the
    existing rows are read through the catalog, and the append registers its
    new partitions there (``insertInto``). A path that a streaming sink owns
    is refused: its readers follow the sink's log and would not see the rows.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path and table")
    parts = schemas.TRANSACTIONS_REFINED_PARTITIONS
    columns = [f.name for f in schemas.TRANSACTIONS_REFINED.fields]
    batch = transactions_dated(refined).select(*columns)
    spark = refined.sparkSession
    if path is not None and has_sink_log(spark, path):
        raise ValueError(f"{path} belongs to a streaming sink; append through the stream or to another path")
    exists = spark.catalog.tableExists(table) if table else table_exists_at(spark, path, schemas.TRANSACTIONS_REFINED)
    if table and not exists:
        raise ValueError(f"table {table} does not exist; register it first")
    if dedupe:
        batch = latest_per_key(batch.withColumn("_key", _row_key()), [*parts, "_key"])
        if exists:
            existing = spark.table(table) if table else spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path)
            day = F.struct(*parts)
            first, last = transactions_dated(refined).agg(F.min(day), F.max(day)).first()
            if first is not None:
                bounds = [F.struct(*[F.lit(v).cast("int").alias(p) for p, v in zip(parts, d)]) for d in (first, last)]
                existing = existing.filter((day >= bounds[0]) & (day <= bounds[1]))
            there = existing.select(*[F.col(p).alias(f"_{p}") for p in parts], _row_key().alias("_there"))
            same = F.col("_key").eqNullSafe(F.col("_there"))
            for p in parts:
                same = same & (F.col(p) == F.col(f"_{p}"))
            batch = batch.join(there, same, "left_anti")
        batch = batch.select(*columns)
    if table:
        writer = batch.hint("rebalance", *parts).write.option("maxRecordsPerFile", int(max_records_per_file))
        writer.insertInto(table)
    else:
        write_partitioned(batch, path, parts, mode="append", rebalance=True, max_records_per_file=max_records_per_file)


def write_observed(df: DataFrame, path: str, partition_by: list[str], keep: Column | None = None, mode: str = "append", max_records_per_file: int = 200000) -> dict[str, int]:
    """Write a refined table and return its quality counts, taken by the writing pass.

    The counts (:func:`ledgerlake.operators.refine.flag_counts`) are an
    ``Observation`` behind the shuffle that sizes the files: there each row
    passes in the stage that writes, where a task that is run again counts
    once. ``keep``: of the counted rows, those to write.
    """
    observed = Observation()
    rows = df.hint("rebalance", *partition_by).observe(observed, *[c.alias(name) for name, c in flag_counts(df).items()])
    write_partitioned(rows if keep is None else rows.filter(keep), path, partition_by, mode=mode, max_records_per_file=max_records_per_file)
    return {name: int(n or 0) for name, n in observed.get.items()}


def append_with_rejects(refined: DataFrame, path: str, rejects_path: str, report_path: str, batch_id: str, max_records_per_file: int = 200000) -> dict[str, int]:
    """Append refined transactions, keep the undated ones, and log the batch's quality counts.

    One pass writes the dated rows and counts nulls, unknowns and undated rows
    of the batch. Undated rows, which have no partition to stand in, go to
    ``rejects_path``, partitioned by batch; the batch is read a second time for
    that only if there are any. ``report_path`` gets a row per count. Both are
    replaced when a batch is run again; the append itself is not idempotent
    (see :func:`append_refined_transactions`).
    """
    if has_sink_log(refined.sparkSession, path):
        raise ValueError(f"{path} belongs to a streaming sink; append through the stream or to another path")
    parts = schemas.TRANSACTIONS_REFINED_PARTITIONS
    columns = [f.name for f in schemas.TRANSACTIONS_REFINED.fields]
    dated = F.col("txn_year").isNotNull() & F.col("txn_month").isNotNull() & F.col("txn_day").isNotNull()
    counts = write_observed(refined.select(*columns), path, parts, dated, max_records_per_file=max_records_per_file)
    undated = transactions_undated(refined).select(*columns)
    append_batch(undated if counts["undated"] else undated.limit(0), rejects_path, batch_id)
    report = refined.sparkSession.createDataFrame(sorted(counts.items()), "metric string, value long")
    append_batch(report.coalesce(1), report_path, batch_id)
    return counts
