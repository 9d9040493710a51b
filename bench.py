"""Benchmark: the reference's jobs end to end at one scale factor.

Setup (not timed) derives raw users, cards and transactions from the TPC-H
tables of ``$BENCH_SF_DIR`` into a fresh scratch directory, partitioned by
ingest day as the raw ingest writes them. Timed steps mirror the reference's
run log (database, refine and write of the three warehouse tables) plus the
data-lake jobs (index build, lookup, users history, cards SCD2 merge).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlake-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # small inputs spread over thousands of day partitions: let AQE keep
        # one task per core instead of merging shuffle blocks up to 1 MB
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # optional: Spark's event log, for stage and task times
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from ledgerlake import schemas
    from ledgerlake.operators import history, index, refine, scd2
    from ledgerlake.plans.index_job import build_index_table, update_index_table
    from ledgerlake.plans.registered import BATCH_1, BATCH_2, CLOCK_1, CLOCK_2
    from ledgerlake.session import fresh_dir
    from ledgerlake.sinks import catalog
    from ledgerlake.sinks.writers import append_batch, append_refined_transactions, write_partitioned
    from ledgerlake.sources import parquet as P
    from ledgerlake.sources import tpch_fixtures as X

    base = fresh_dir(spark, "bench")
    # --- setup: raw sources as the data-lake jobs would have left them ----------
    write_partitioned(X.users(spark, sf_dir), f"{base}/raw/users", schemas.INGEST_PARTITIONS)
    write_partitioned(X.transactions(spark, sf_dir), f"{base}/raw/transactions", schemas.INGEST_PARTITIONS)
    write_partitioned(X.transactions_with_duplicates(spark, sf_dir), f"{base}/raw/transactions_dup", schemas.INGEST_PARTITIONS)
    X.cards_snapshot_1(spark, sf_dir).write.parquet(f"{base}/raw/cards_1")
    X.cards_snapshot_2(spark, sf_dir).write.parquet(f"{base}/raw/cards_2")
    X.users_snapshot_1(spark, sf_dir).write.parquet(f"{base}/raw/users_1")
    X.users_snapshot_2(spark, sf_dir).write.parquet(f"{base}/raw/users_2")
    scd2.initial_versions(
        scd2.normalize_cards(spark.read.parquet(f"{base}/raw/cards_1")), CLOCK_1, BATCH_1
    ).write.parquet(f"{base}/history/cards_scd2_v1")

    # warm-up (not timed): compile the builders' code paths once, so the first
    # timed step does not also pay JIT and class-loading costs
    for warm in (
        refine.users_refined(spark.read.parquet(f"{base}/raw/users"), current_year=2026),
        refine.transactions_refined(spark.read.parquet(f"{base}/raw/transactions")),
        refine.cards_refined(spark.read.parquet(f"{base}/history/cards_scd2_v1"), current_year=2026),
    ):
        warm.write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}

    errors: dict[str, str] = {}

    def timed(name, fn):
        # a failing step is reported (and left out of the total) instead of
        # losing the whole result line
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        try:
            fn()
        except Exception as err:  # noqa: BLE001
            errors[name] = f"{type(err).__name__}: {str(err)[:300]}"
            return
        times[name] = round(time.perf_counter() - t0, 3)

    read = spark.read.parquet
    db = f"ledgerlake_bench_{os.getpid()}"

    timed("create_database", lambda: catalog.ensure_database(spark, db, f"{base}/db"))
    timed(
        "users_refined_write",
        lambda: write_partitioned(
            refine.users_refined(P.latest_batch(read(f"{base}/raw/users")), current_year=2026),
            f"{base}/dw/users_refined",
            schemas.USERS_REFINED_PARTITIONS,
            dynamic=False,
        ),
    )
    timed(
        "cards_scd2_merge_write",
        lambda: scd2.merge(
            read(f"{base}/history/cards_scd2_v1"),
            scd2.normalize_cards(read(f"{base}/raw/cards_2")),
            CLOCK_2,
            BATCH_2,
        ).write.parquet(f"{base}/history/cards_scd2_v2"),
    )
    timed(
        "cards_refined_write",
        lambda: write_partitioned(
            refine.cards_refined(read(f"{base}/history/cards_scd2_v2"), current_year=2026),
            f"{base}/dw/cards_refined_scd2",
            schemas.CARDS_REFINED_PARTITIONS,
            dynamic=False,
            rebalance=True,
        ),
    )
    timed(
        "transactions_refined_append",
        lambda: append_refined_transactions(
            refine.transactions_refined(P.latest_batch(read(f"{base}/raw/transactions"))),
            f"{base}/dw/transactions_refined",
        ),
    )
    timed(
        "users_history_append",
        lambda: append_batch(
            history.history_delta(
                history.normalize_users(read(f"{base}/raw/users_1")),
                history.normalize_users(read(f"{base}/raw/users_2")),
                CLOCK_2,
                BATCH_2,
            ),
            f"{base}/history/users_history",
            BATCH_2,
        ),
    )
    # not timed: the published index that the one-day update starts from
    build_index_table(spark, f"{base}/raw/transactions_dup", f"{db}.transaction_index", f"{base}/index", f"{base}/index_occurrences", BATCH_1)
    timed(
        "txn_index_build",
        lambda: write_partitioned(
            index.transaction_index(read(f"{base}/raw/transactions_dup")),
            f"{base}/raw/transaction_index",
            schemas.INGEST_PARTITIONS,
            dynamic=False,
            rebalance=True,
        ),
    )

    timed(
        "txn_index_update_one_day",
        lambda: update_index_table(spark, f"{base}/raw/transactions_dup", f"{db}.transaction_index", f"{base}/index", f"{base}/index_occurrences", [(2026, 4, 23)], BATCH_2),
    )

    def lookups():
        idx = read(f"{base}/raw/transaction_index")
        txn = read(f"{base}/raw/transactions_dup")
        some = idx.select("transaction_id").first()[0]
        index.lookup_transactions(idx, txn, some, prune=True).collect()
        index.lookup_transactions(idx, txn, txn.select(txn["id"].alias("transaction_id"))).write.format("noop").mode("overwrite").save()

    timed("txn_lookup", lookups)

    total = round(sum(times.values()), 3)
    result = {"metric": "jobs_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
