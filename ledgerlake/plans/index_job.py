"""Build the transaction index from raw transactions; look ids up through it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.index import day_occurrences, lookup_transactions, missing_ids, one_day_occurrences, survivors, transaction_index
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.partitions import partition_name, publish_partitions, published
from ledgerlake.sinks.writers import bloom_options, clustered, table_exists_at, write_partitioned


def build_index(spark: SparkSession, transactions_path: str, index_path: str, survivor: str = "latest", cluster: bool = False) -> None:
    """Full rebuild: read raw transactions (8 columns only), de-duplicate, write.

    The index is rewritten as a whole (static overwrite), partitioned by
    ingest day; the rebalance sizes files and splits a busy day. With
    ``cluster`` the rows of a day are ranged and sorted by id instead, with
    bloom filters on it, for point lookups.
    """
    raw = spark.read.parquet(transactions_path)
    index = transaction_index(raw, survivor=survivor)
    if cluster:
        rows = clustered(index, "transaction_id", schemas.INGEST_PARTITIONS)
        write_partitioned(rows, index_path, schemas.INGEST_PARTITIONS, dynamic=False, options=bloom_options("transaction_id"))
    else:
        write_partitioned(index, index_path, schemas.INGEST_PARTITIONS, dynamic=False, rebalance=True)


def cluster_transactions(spark: SparkSession, transactions_path: str, clustered_path: str) -> None:
    """A copy of the raw transactions that lookups by id read: a day's rows ranged and sorted by id."""
    rows = clustered(spark.read.parquet(transactions_path), "id", schemas.INGEST_PARTITIONS)
    write_partitioned(rows, clustered_path, schemas.INGEST_PARTITIONS, dynamic=False, options=bloom_options("id"))


def lookup(spark: SparkSession, index_path: str, transactions_path: str, ids, prune: bool = False) -> tuple[DataFrame, DataFrame]:
    """(found records, ids not found) for an id, a list, or a DataFrame of ids."""
    index = spark.read.parquet(index_path)
    txn = spark.read.parquet(transactions_path)
    return lookup_transactions(index, txn, ids, prune=prune), missing_ids(index, ids)


def updated_index(index: DataFrame, transactions: DataFrame, days: list[tuple[int, int, int]]) -> DataFrame:
    """``index`` brought up to date after the given ingest days were (re-)ingested.

    An id is touched if a raw row of those days has it, or an index row of
    those days (its raw row may be gone now). Touched ids are indexed anew
    from all of their raw rows; all other index rows stay as they are. So the
    result equals a rebuild, whatever was added, moved or removed on the days.
    """
    day = F.struct(*schemas.INGEST_PARTITIONS)
    on_days = day.isin([F.struct(*[F.lit(v) for v in d]) for d in days])
    old = index.filter(on_days).select("transaction_id")
    new = transactions.filter(on_days).select(F.col("id").alias("transaction_id"))
    touched = old.unionByName(new).distinct()
    same_id = F.col("id").eqNullSafe(F.col("transaction_id"))
    fresh = transaction_index(transactions.join(touched, same_id, "left_semi"))
    left = touched.withColumnRenamed("transaction_id", "_touched")
    untouched = index.join(left, F.col("transaction_id").eqNullSafe(F.col("_touched")), "left_anti")
    return untouched.select(*schemas.INDEX_COLUMNS).unionByName(fresh)


def update_index(
    spark: SparkSession,
    transactions_path: str,
    index_path: str,
    new_index_path: str,
    days: list[tuple[int, int, int]],
) -> str:
    """Write the index after ``days`` were ingested as a new version; returns its path.

    The version at ``index_path`` is only read, so a failed job leaves it as
    it was, and days that have become empty are absent from the new version.
    Without an index at ``index_path`` the new version is a full build.
    """
    if not table_exists_at(spark, index_path):
        build_index(spark, transactions_path, new_index_path)
        return new_index_path
    index = spark.read.parquet(index_path).select(*schemas.INDEX_COLUMNS)
    rows = updated_index(index, spark.read.parquet(transactions_path), days)
    write_partitioned(rows, new_index_path, schemas.INGEST_PARTITIONS, dynamic=False, rebalance=True)
    return new_index_path


# --- index with an occurrences table -----------------------------------------
#
# Beside the index stands a table with, for every id and every ingest day that
# has it, the row of that day that would survive. A day is then brought up to
# date from its own raw rows and this table: other days' raw rows are not read,
# and index days that hold no touched id are not written.


def _on_days(days: list[tuple[int, int, int]]):
    """A filter that prunes the partitions of other days."""
    one = [(F.col("ingest_year") == y) & (F.col("ingest_month") == m) & (F.col("ingest_day") == d) for y, m, d in days]
    wanted = one[0]
    for c in one[1:]:
        wanted = wanted | c
    return wanted


def _on_other_days(days: list[tuple[int, int, int]]):
    return ~F.coalesce(_on_days(days), F.lit(False))


def _scratch(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written below the shared folder and read back, so that what reads them twice computes them once."""
    path = fresh_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _write_occurrences(raw: DataFrame, occurrences_path: str, days) -> None:
    """Replace the named days of the occurrences table, also by nothing."""
    for day in days:
        found = one_day_occurrences(raw.filter(_on_days([day])))
        found.write.mode("overwrite").parquet(f"{occurrences_path.rstrip('/')}/{partition_name(schemas.INGEST_PARTITIONS, day)}")


def build_index_table(spark: SparkSession, transactions_path: str, table: str, base_path: str, occurrences_path: str, version: str) -> None:
    """Build the occurrences table and the index ``table`` from all raw transactions."""
    found = day_occurrences(spark.read.parquet(transactions_path))
    write_partitioned(found, occurrences_path, schemas.INGEST_PARTITIONS, dynamic=False, rebalance=True)
    schema = found.select(*schemas.INDEX_COLUMNS).schema
    occurrences = spark.read.schema(schema).parquet(occurrences_path)
    days = [tuple(r) for r in occurrences.select(*schemas.INGEST_PARTITIONS).distinct().collect()]
    _, places = published(spark, table, base_path)
    gone = [tuple(int(x.split("=")[1]) for x in p.split("/")) for p in places]
    _publish_index(_scratch(survivors(occurrences), "survivors"), table, base_path, version, schema, sorted({*days, *gone}))


def _publish_index(rows: DataFrame, table: str, base_path: str, version: str, schema, days) -> None:
    """The days' rows, clustered for lookups by id, as the next version of the index.

    Ranges are drawn in a pass of its own over ``rows``, so these lie in files.
    """
    rows = clustered(rows, "transaction_id", schemas.INGEST_PARTITIONS)
    publish_partitions(rows, table, base_path, version, schema, schemas.INGEST_PARTITIONS, days, options=bloom_options("transaction_id"))


def update_index_table(
    spark: SparkSession,
    transactions_path: str,
    table: str,
    base_path: str,
    occurrences_path: str,
    days: list[tuple[int, int, int]],
    version: str,
) -> list[tuple[int, int, int]]:
    """Bring the index up to date after the given ingest days were (re-)ingested.

    Raw rows are read of these days only. Touched ids are those that the days
    hold now or the index has on them; their survivors are elected again from
    the occurrences table. The days on which a touched id stood or stands are
    written anew, from their untouched rows and the new survivors; all others
    keep their files. The result equals a rebuild. Returns the written days
    (days of ingest, so a bounded list).
    """
    days = [tuple(int(v) for v in d) for d in days]
    if not days:
        return []
    index = spark.table(table)
    schema = index.schema
    _write_occurrences(spark.read.parquet(transactions_path), occurrences_path, days)
    occurrences = spark.read.schema(schema).parquet(occurrences_path)
    stood = index.filter(_on_days(days)).select("transaction_id")
    ids = stood.unionByName(occurrences.filter(_on_days(days)).select("transaction_id")).distinct()
    touched = _scratch(ids, "touched").withColumnRenamed("transaction_id", "_touched")
    same = F.col("transaction_id").eqNullSafe(F.col("_touched"))
    # whatever lies on the named days is touched, so only other days' rows are looked up
    elsewhere = occurrences.filter(_on_other_days(days)).join(touched, same, "left_semi")
    fresh = _scratch(survivors(occurrences.filter(_on_days(days)).unionByName(elsewhere)), "survivors")
    parts = schemas.INGEST_PARTITIONS
    others = index.filter(_on_other_days(days))
    before = others.join(touched, same, "left_semi").select(*parts)
    moved = {tuple(r) for r in before.unionByName(fresh.select(*parts)).distinct().collect()} | set(days)
    kept = _scratch(others.filter(_on_days(sorted(moved))).join(touched, same, "left_anti"), "kept")
    _publish_index(kept.unionByName(fresh), table, base_path, version, schema, sorted(moved))
    return sorted(moved)
