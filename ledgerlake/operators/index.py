"""Slim transaction index and lookups through it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.dedupe import latest_per_key

# Ingest order used to pick the surviving index row of a repeated id.
LATEST_INGEST = ["ingest_time", "ingest_year", "ingest_month", "ingest_day"]


def index_projection(transactions: DataFrame) -> DataFrame:
    """``id`` as ``transaction_id``, the two locator ids and the lineage columns."""
    return transactions.select(
        F.col("id").alias("transaction_id"),
        "client_id",
        "card_id",
        *schemas.LINEAGE_COLUMNS,
    )


def transaction_index(transactions: DataFrame, survivor: str = "latest") -> DataFrame:
    """One index row per transaction id.

    ``survivor="latest"`` keeps the row of the latest ingest (ties broken by
    the remaining columns), a deterministic choice; ``"any"`` keeps Spark's
    ``dropDuplicates`` survivor, as the reference does.
    """
    slim = index_projection(transactions)
    if survivor == "any":
        return slim.dropDuplicates(["transaction_id"])
    return latest_per_key(slim, "transaction_id", order=LATEST_INGEST)


def day_occurrences(transactions: DataFrame) -> DataFrame:
    """One index row per transaction id and ingest day: the one of that day that would survive."""
    return latest_per_key(index_projection(transactions), ["transaction_id", *schemas.INGEST_PARTITIONS], order=LATEST_INGEST[:1])


def one_day_occurrences(transactions: DataFrame) -> DataFrame:
    """:func:`day_occurrences` of the rows of a single ingest day, without the day's columns.

    The id alone is the key, a single long by which Spark sorts faster.
    """
    slim = index_projection(transactions).drop(*schemas.INGEST_PARTITIONS)
    return latest_per_key(slim, "transaction_id", order=LATEST_INGEST[:1])


def survivors(occurrences: DataFrame) -> DataFrame:
    """The index of the transactions that ``occurrences`` was made from.

    A survivor is the greatest row of its id in one total order, so it is the
    greatest of the days' greatest rows.
    """
    return latest_per_key(occurrences, "transaction_id", order=LATEST_INGEST)


def _literal_ids(ids) -> list[int]:
    """An id or an iterable of ids as a list of ints (given by the caller, so bounded)."""
    return [int(ids)] if isinstance(ids, (int, str)) else [int(v) for v in ids]


def _ids_frame(ids, column: str = "transaction_id") -> DataFrame:
    return ids.select(F.col(ids.columns[0]).cast("long").alias(column)) if len(ids.columns) == 1 else ids.select(column)


def find_in_index(index: DataFrame, ids) -> DataFrame:
    """Index rows for an id, a list of ids, or a DataFrame of requested ids.

    Literal ids become a pushed-down parquet filter; a DataFrame of requests
    becomes a left-semi join (AQE broadcasts it when it turns out small).
    """
    if isinstance(ids, DataFrame):
        # distinct first: a repeated request id collapses map-side instead of
        # landing whole in one shuffle partition
        return index.join(_ids_frame(ids).distinct(), "transaction_id", "left_semi")
    return index.filter(F.col("transaction_id").isin(_literal_ids(ids)))


def missing_ids(index: DataFrame, ids) -> DataFrame:
    """Requested ids absent from the index (the not-found outcome), one row each."""
    if isinstance(ids, DataFrame):
        req = _ids_frame(ids).distinct()
    else:
        values = sorted(set(_literal_ids(ids)))
        req = index.sparkSession.createDataFrame([(v,) for v in values], "transaction_id long")
    return req.join(index.select("transaction_id"), "transaction_id", "left_anti")


def lookup_transactions(index: DataFrame, transactions: DataFrame, ids, prune: bool = False) -> DataFrame:
    """Index rows of the requested ids joined to their full records.

    Joined on the id alone, as in the reference; ``prune=True`` also joins on
    the ingest columns, which lets Spark prune the record table's partitions
    to the days the index rows point at (dynamic partition pruning, which
    Spark applies when the requests are selective - point lookups, filtered
    request sets). With literal ids the record scan is filtered by the same
    ids as well.
    """
    hits = find_in_index(index, ids)
    if isinstance(ids, DataFrame):
        # The semi join above leaves the hits partitioned by id, and a record
        # join on that very column would take them as they are; AQE splits a
        # hot id only between two shuffles made for the join itself. The key
        # is therefore an expression of the id, so both sides are shuffled
        # for the record join (or the hits broadcast, if they turn out small).
        hits = hits.withColumn("_key", F.col("transaction_id").bitwiseXOR(F.lit(0).cast("long")))
    else:
        hits = hits.withColumn("_key", F.col("transaction_id"))
    hits = hits.alias("idx")
    records = transactions
    if not isinstance(ids, DataFrame):
        records = records.filter(F.col("id").isin(_literal_ids(ids)))
    txn = records.alias("txn")
    cond = F.col("txn.id") == F.col("idx._key")
    if prune:
        for p in schemas.INGEST_PARTITIONS:
            cond = cond & (F.col(f"txn.{p}") == F.col(f"idx.{p}"))
    # records on the left: in a sort-merge join the left side is streamed and
    # the right side buffered per key, so an id repeated across many records
    # is streamed past the single index row instead of being buffered
    return txn.join(hits, cond, "inner").select(
        *[F.col(f"idx.{c}") for c in schemas.INDEX_COLUMNS],
        *[F.col(f"txn.{c}") for c in schemas.LOOKUP_RECORD_COLUMNS],
    )
