"""Transaction index: deterministic survivor, point and batch lookups, pruning."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import index as IX
from ledgerlake.operators.dedupe import latest_per_key
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.writers import write_partitioned
from ledgerlake.sources import tpch_fixtures as X
from tests.conftest import SF_SMALL, plan_of, rows


def raw_txn(spark, data):
    return spark.createDataFrame(
        [(i, c, d, "src", dt.datetime(2026, 4, day, 1), 2026, 4, day, "2001-01-01", "$1", "m", None, "S", None)
         for i, c, d, day in data],
        "id long, client_id long, card_id long, table_source string, ingest_time timestamp, ingest_year int, "
        "ingest_month int, ingest_day int, date string, amount string, merchant_id string, merchant_city string, "
        "merchant_state string, errors string",
    )


def test_latest_ingest_survives(spark):
    df = raw_txn(spark, [(1, 10, 1, 21), (1, 11, 1, 23), (1, 12, 1, 22), (2, 20, 2, 21)])
    got = rows(IX.transaction_index(df), "transaction_id")
    assert [(r["transaction_id"], r["client_id"], r["ingest_day"]) for r in got] == [(1, 11, 23), (2, 20, 21)]
    assert IX.transaction_index(df).columns == schemas.INDEX_COLUMNS


def test_latest_per_key_handles_null_key_and_ties(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 5, "x"), (1, 5, "y")], "k long, o int, v string")
    got = rows(latest_per_key(df, "k", order=["o"]), "k")
    assert [(r["k"], r["o"], r["v"]) for r in got] == [(1, 5, "y"), (None, 2, "b")]


def test_point_lookup_pushes_filter(spark):
    base = fresh_dir(spark, "idx_test")
    raw = raw_txn(spark, [(1, 10, 1, 21), (2, 20, 2, 22), (3, 30, 3, 23)])
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    write_partitioned(IX.transaction_index(raw), f"{base}/idx", schemas.INGEST_PARTITIONS)
    idx, txn = spark.read.parquet(f"{base}/idx"), spark.read.parquet(f"{base}/raw")
    hit = IX.lookup_transactions(idx, txn, 2, prune=True)
    got = rows(hit)
    assert [(r["transaction_id"], r["client_id"], r["amount"]) for r in got] == [(2, 20, "$1")]
    assert hit.columns == schemas.INDEX_COLUMNS + schemas.LOOKUP_RECORD_COLUMNS
    plan = plan_of(hit)
    assert "PushedFilters: [IsNotNull(transaction_id), In(transaction_id, [2])]" in plan or "EqualTo(transaction_id,2)" in plan
    assert IX.lookup_transactions(idx, txn, 99).count() == 0
    assert [r["transaction_id"] for r in IX.missing_ids(idx, [2, 99]).collect()] == [99]


def test_batch_lookup(spark):
    raw = raw_txn(spark, [(1, 10, 1, 21), (2, 20, 2, 22), (2, 21, 2, 23)])
    idx = IX.transaction_index(raw)
    req = spark.createDataFrame([(2,), (5,)], "transaction_id long")
    got = rows(IX.lookup_transactions(idx, raw, req), "client_id")
    # the index keeps one row for id 2; the record side has two rows with that id
    assert [(r["transaction_id"], r["client_id"]) for r in got] == [(2, 21), (2, 21)]
    assert [r[0] for r in IX.missing_ids(idx, req).collect()] == [5]


def test_fixture_index_unique(spark):
    idx = IX.transaction_index(X.transactions_with_duplicates(spark, SF_SMALL))
    assert idx.groupBy("transaction_id").count().filter(F.col("count") > 1).count() == 0


def test_incremental_update_equals_rebuild_even_for_backfill(spark):
    from ledgerlake.plans.index_job import update_index

    base = fresh_dir(spark, "idx_update_test")
    raw = X.transactions_with_duplicates(spark, SF_SMALL)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    # index of the later days first, then the earliest day arrives late
    write_partitioned(IX.transaction_index(raw.filter("ingest_day > 21")), f"{base}/idx", schemas.INGEST_PARTITIONS)
    path = update_index(spark, f"{base}/raw", f"{base}/idx", f"{base}/idx2", [(2026, 4, 21)])
    got = spark.read.parquet(path).select(*schemas.INDEX_COLUMNS)
    want = IX.transaction_index(raw)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prune_adds_dynamic_partition_pruning(spark):
    base = fresh_dir(spark, "idx_dpp_test")
    raw = X.transactions(spark, SF_SMALL)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    write_partitioned(IX.transaction_index(raw), f"{base}/idx", schemas.INGEST_PARTITIONS)
    idx, txn = spark.read.parquet(f"{base}/idx"), spark.read.parquet(f"{base}/raw")
    req = txn.filter("id % 50 = 0").select(F.col("id").alias("transaction_id"))
    pruned = IX.lookup_transactions(idx, txn, req, prune=True)
    assert "dynamicpruning" in plan_of(pruned).lower()
    assert "dynamicpruning" not in plan_of(IX.lookup_transactions(idx, txn, req)).lower()
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, IX.lookup_transactions(idx, txn, req).collect()))


def test_incremental_update_without_an_index_builds_one(spark):
    from ledgerlake.plans.index_job import update_index

    base = fresh_dir(spark, "idx_first_update_test")
    raw = X.transactions_with_duplicates(spark, SF_SMALL)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    update_index(spark, f"{base}/raw", f"{base}/none", f"{base}/idx", [(2026, 4, 21)])
    update_index(spark, f"{base}/raw", f"{base}/idx", f"{base}/idx2", [(2026, 4, 22), (2026, 4, 23)])
    got = spark.read.parquet(f"{base}/idx2").select(*schemas.INDEX_COLUMNS)
    want = IX.transaction_index(raw)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_update_equals_rebuild_when_rows_move_vanish_or_lack_an_id(spark):
    from ledgerlake.plans.index_job import updated_index

    before = raw_txn(spark, [(1, 10, 1, 21), (2, 20, 2, 21), (3, 30, 3, 22), (3, 31, 3, 21), (None, 5, 5, 22), (4, 40, 4, 22)])
    # day 22 is ingested again without 3 and the row without an id, and brings 1; day 23 is new
    after = raw_txn(spark, [(1, 10, 1, 21), (2, 20, 2, 21), (3, 31, 3, 21), (1, 11, 1, 22), (4, 41, 4, 22), (2, 22, 2, 23)])
    got = updated_index(IX.transaction_index(before), after, [(2026, 4, 22), (2026, 4, 23)])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, IX.transaction_index(after).collect()))
    # day 21 is left to the index rows of 3 alone
    assert [r["transaction_id"] for r in got.filter("ingest_day = 21").collect()] == [3]
