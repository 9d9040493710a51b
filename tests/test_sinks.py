"""Writers, publication, catalog registration and the jobs built on them."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import refine
from ledgerlake.plans.history_job import run_users_history
from ledgerlake.plans.ingest import IngestSpec, run_raw_ingest, source_specs
from ledgerlake.plans.scd2_job import run_cards_scd2
from ledgerlake.session import fresh_dir
from ledgerlake.sinks import catalog
from ledgerlake.sinks.publish import publish_version
from ledgerlake.sinks.writers import append_refined_transactions, write_partitioned
from ledgerlake.sources import jdbc
from ledgerlake.sources import parquet as P
from ledgerlake.sources import tpch_fixtures as X
from tests.conftest import SF_SMALL, layout, plan_of


def test_dynamic_overwrite_keeps_other_days(spark):
    path = fresh_dir(spark, "raw_test")
    orders = X.load(spark, SF_SMALL, "orders")
    spec = IngestSpec("t", "orders", path, "transactions_data.csv")
    run_raw_ingest([spec], lambda s: orders, clock="2026-04-21 01:00:00")
    run_raw_ingest([spec], lambda s: orders, clock="2026-04-22 01:00:00")
    run_raw_ingest([spec], lambda s: orders, clock="2026-04-22 02:00:00")  # same day again: replaced
    df = spark.read.parquet(path)
    assert df.count() == 2 * orders.count()
    assert P.latest_batch_key(df) == (2026, 4, 22)
    static = IngestSpec("t", "orders", path, "x")
    run_raw_ingest([static], lambda s: orders, clock="2026-04-23 01:00:00", dynamic=False)
    assert spark.read.parquet(path).count() == orders.count()


def test_latest_batch_prunes_partitions(spark):
    path = fresh_dir(spark, "latest_test")
    write_partitioned(X.transactions(spark, SF_SMALL), path, schemas.INGEST_PARTITIONS)
    df = spark.read.parquet(path)
    latest = P.latest_batch(df)
    assert "PartitionFilters: [isnotnull(ingest_year" in plan_of(latest)
    assert {tuple(r) for r in P.batch_days(latest).collect()} == {(2026, 4, 23)}
    empty = df.limit(0)
    assert P.latest_batch(empty).count() == 0


def test_append_dedupe_is_idempotent(spark):
    path = fresh_dir(spark, "append_test")
    refined = refine.transactions_refined(X.transactions(spark, SF_SMALL))
    append_refined_transactions(refined, path, dedupe=True)
    append_refined_transactions(refined, path, dedupe=True)
    back = spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path)
    assert back.count() == refine.transactions_dated(refined).count()
    append_refined_transactions(refined, path)  # without dedupe a rerun doubles, as in the reference
    assert spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path).count() == 2 * back.count()


def test_publish_moves_table_between_versions(spark):
    base = fresh_dir(spark, "publish_test")
    table = "ledgerlake_publish_test"
    p1 = publish_version(spark.range(3), base, "v1", table=table)
    p2 = publish_version(spark.table(table).withColumn("id", F.col("id") + 10), base, "v2", table=table)
    assert p1 != p2
    assert sorted(r[0] for r in spark.table(table).collect()) == [10, 11, 12]
    assert spark.read.parquet(p1).count() == 3  # the old version is untouched


def test_history_job_append_is_per_batch(spark):
    base = fresh_dir(spark, "history_test")
    u1, u2 = X.users_snapshot_1(spark, SF_SMALL), X.users_snapshot_2(spark, SF_SMALL)
    d = run_users_history(u1, u2, f"{base}/h", f"{base}/c", "2026-04-24 00:00:00", "b2")
    n = d.count()
    run_users_history(u1, u2, f"{base}/h", f"{base}/c", "2026-04-24 00:00:00", "b2")  # rerun: replaced
    assert spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/h").count() == n


def test_scd2_job_first_and_next_run(spark):
    base = fresh_dir(spark, "scd2_test")
    table = "ledgerlake_scd2_job_test"
    run_cards_scd2(spark, X.cards_snapshot_1(spark, SF_SMALL), table, base, "2026-04-23 00:00:00")
    n1 = spark.table(table).count()
    run_cards_scd2(spark, X.cards_snapshot_2(spark, SF_SMALL), table, base, "2026-04-24 00:00:00")
    df = spark.table(table)
    assert df.count() > n1
    assert df.filter("is_current").groupBy("card_id").count().filter("count > 1").count() == 0


def test_catalog_ddl_matches_schema(spark):
    ddl = catalog.table_ddl("`db`.`users_refined`", schemas.USERS_REFINED, schemas.USERS_REFINED_PARTITIONS, "/x")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS `db`.`users_refined` (`user_id` BIGINT")
    assert "PARTITIONED BY (`load_day`)" in ddl and "USING parquet" in ddl
    base = fresh_dir(spark, "catalog_test")
    loc = f"{base}/users_refined"
    write_partitioned(refine.users_refined(X.users(spark, SF_SMALL), 2026), loc, schemas.USERS_REFINED_PARTITIONS)
    catalog.register_refined_tables(spark, "ledgerlake_catalog_test", {"users_refined": loc},
                                    database_location=f"{base}/db")
    t = spark.table("ledgerlake_catalog_test.users_refined")
    assert layout(t.schema) == layout(schemas.USERS_REFINED)
    assert t.count() == X.users(spark, SF_SMALL).count()


def test_registered_table_with_another_location_or_schema_is_refused(spark):
    base = fresh_dir(spark, "register_test")
    db = "ledgerlake_register_test"
    catalog.ensure_database(spark, db, f"{base}/db")
    args = (spark, f"`{db}`.`t`", schemas.TRANSACTIONS_REFINED, schemas.TRANSACTIONS_REFINED_PARTITIONS)
    assert catalog.register_table(*args, f"{base}/t") is True
    assert catalog.register_table(*args, f"{base}/t") is False
    with pytest.raises(ValueError, match="not at"):
        catalog.register_table(*args, f"{base}/elsewhere")
    with pytest.raises(ValueError, match="another schema"):
        catalog.register_table(spark, f"`{db}`.`t`", schemas.USERS_REFINED, schemas.USERS_REFINED_PARTITIONS, f"{base}/t")


def test_append_to_a_streaming_sink_is_refused(spark):
    path = fresh_dir(spark, "sink_log_test")
    spark.createDataFrame([("v1",)], "value string").write.text(f"{path}/_spark_metadata")
    with pytest.raises(ValueError, match="streaming sink"):
        append_refined_transactions(refine.transactions_refined(X.transactions(spark, SF_SMALL)), path)


def test_bucketed_version_has_one_file_per_bucket(spark):
    base = fresh_dir(spark, "bucket_test")
    path = publish_version(spark.range(1000).repartition(16), base, "v1", table="ledgerlake_bucket_test", bucket_by=(8, "id"))
    files = spark.read.parquet(path).inputFiles()
    assert len(files) <= 8 and spark.table("ledgerlake_bucket_test").count() == 1000


def test_ingest_registers_its_tables(spark):
    base = fresh_dir(spark, "ingest_register_test")
    orders = X.load(spark, SF_SMALL, "orders")
    for clock in ("2026-04-21 01:00:00", "2026-04-22 01:00:00"):
        run_raw_ingest([IngestSpec("t", "orders", f"{base}/t", "x")], lambda s: orders, clock=clock, database="ledgerlake_ingest_test")
    table = "`ledgerlake_ingest_test`.`t`"
    assert P.latest_batch_key_from_catalog(spark, table) == (2026, 4, 22)
    assert P.latest_batch_of_table(spark, table).count() == orders.count()


def test_source_specs_and_jdbc_options():
    specs = source_specs("/lake", "id", 4)
    assert [s.dbtable for s in specs] == ["raw_users", "raw_cards", "raw_transactions"]
    assert all((s.partition_column, s.num_partitions) == ("id", 4) for s in specs)
    opts = jdbc.jdbc_options("jdbc:x://h/db", "t", user="u", fetchsize=10000, partition_column="id",
                             lower_bound=1, upper_bound=100, num_partitions=4)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "4" and opts["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_append_through_catalog_table(spark):
    base = fresh_dir(spark, "append_table_test")
    db = "ledgerlake_append_table_test"
    catalog.ensure_database(spark, db, f"{base}/db")
    table = f"`{db}`.`transactions_refined`"
    catalog.register_table(spark, table, schemas.TRANSACTIONS_REFINED, schemas.TRANSACTIONS_REFINED_PARTITIONS, f"{base}/t")
    raw = X.transactions(spark, SF_SMALL)
    refined = refine.transactions_refined(raw)
    append_refined_transactions(refine.transactions_refined(P.latest_batch(raw)), table=table, dedupe=True)
    append_refined_transactions(refined, table=table, dedupe=True)
    append_refined_transactions(refined, table=table, dedupe=True)
    want = refine.transactions_dated(refined).count()
    assert spark.table(table).count() == want
    # the appends registered their partitions: the catalog alone knows every day
    days = spark.sql(f"SHOW PARTITIONS {table}").count()
    assert days == refine.transactions_dated(refined).select(*schemas.TRANSACTIONS_REFINED_PARTITIONS).distinct().count()
    # the latest day of the table, found from the catalog only
    top = P.latest_batch_key_from_catalog(spark, table, schemas.TRANSACTIONS_REFINED_PARTITIONS)
    assert top == tuple(refine.transactions_dated(refined).selectExpr(
        "max(struct(txn_year, txn_month, txn_day)) AS k").first()["k"])
    assert P.latest_batch_of_table(spark, table, schemas.TRANSACTIONS_REFINED_PARTITIONS).count() > 0


def test_warehouse_refines_latest_users_snapshot(spark):
    from ledgerlake.plans.warehouse import RefineTargets, run_warehouse
    from ledgerlake.operators import scd2

    base = fresh_dir(spark, "warehouse_test")
    users = X.users(spark, SF_SMALL)
    write_partitioned(users, f"{base}/raw/users", schemas.INGEST_PARTITIONS)
    # a second, later ingest day of the same snapshot
    write_partitioned(users.withColumn("ingest_day", F.lit(24)), f"{base}/raw/users", schemas.INGEST_PARTITIONS)
    scd2.initial_versions(scd2.normalize_cards(X.cards(spark, SF_SMALL)), "2026-04-23 00:00:00", "b1").write.parquet(f"{base}/scd2")
    write_partitioned(X.transactions(spark, SF_SMALL), f"{base}/raw/transactions", schemas.INGEST_PARTITIONS)
    cfg = dict(database="ledgerlake_wh_test", users_source=f"{base}/raw/users", cards_scd2_source=f"{base}/scd2",
               transactions_source=f"{base}/raw/transactions", users_refined=f"{base}/dw/u",
               cards_refined_scd2=f"{base}/dw/c", transactions_refined=f"{base}/dw/t",
               database_location=f"{base}/db", register_tables=False)
    run_warehouse(spark, RefineTargets(**cfg), clock="2026-04-25 00:00:00")
    u = spark.read.parquet(f"{base}/dw/u")
    assert u.count() == users.count()
    assert [str(r[0]) for r in u.select("load_day").distinct().collect()] == ["2026-04-24"]


def test_republishing_the_live_version_is_refused(spark):
    from ledgerlake.sinks.publish import table_location

    base = fresh_dir(spark, "republish_test")
    table = "ledgerlake_republish_test"
    path = publish_version(spark.range(3), base, "v1", table=table)
    assert table_location(spark, table).rstrip("/").endswith(path.split("://")[-1].rstrip("/"))
    with pytest.raises(ValueError, match="already published"):
        publish_version(spark.table(table), base, "v1", table=table)
    publish_version(spark.table(table), base, "v2", table=table)
    assert spark.table(table).count() == 3


def test_ingest_spreads_an_unsplit_read(spark):
    from tests.conftest import confs

    one_task = X.load(spark, SF_SMALL, "orders").coalesce(1)
    path = fresh_dir(spark, "ingest_spread_test")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    with confs(spark, **small):
        run_raw_ingest([IngestSpec("t", "orders", path, "x")], lambda s: one_task, clock="2026-04-23 00:00:00")
    assert len(spark.read.parquet(path).inputFiles()) > 1 and spark.read.parquet(path).count() == one_task.count()


def test_warehouse_reruns_through_catalog_tables(spark):
    from ledgerlake.operators import scd2
    from ledgerlake.plans.warehouse import RefineTargets, run_warehouse

    base = fresh_dir(spark, "warehouse_rerun_test")
    users = X.users(spark, SF_SMALL)
    write_partitioned(users, f"{base}/raw/users", schemas.INGEST_PARTITIONS)
    scd2.initial_versions(scd2.normalize_cards(X.cards(spark, SF_SMALL)), "2026-04-23 00:00:00", "b1").write.parquet(f"{base}/scd2")
    raw = X.transactions(spark, SF_SMALL)
    write_partitioned(raw, f"{base}/raw/transactions", schemas.INGEST_PARTITIONS)
    db = "ledgerlake_rerun_test"
    cfg = RefineTargets(database=db, users_source=f"{base}/raw/users", cards_scd2_source=f"{base}/scd2",
                          transactions_source=f"{base}/raw/transactions", users_refined=f"{base}/dw/u",
                          cards_refined_scd2=f"{base}/dw/c", transactions_refined=f"{base}/dw/t",
                          database_location=f"{base}/db", dedupe_transactions=True)
    for _ in range(2):
        run_warehouse(spark, cfg, clock="2026-04-25 00:00:00")
    latest = refine.transactions_dated(refine.transactions_refined(P.latest_batch(raw))).count()
    assert spark.table(f"{db}.users_refined").count() == users.count()
    assert spark.table(f"{db}.cards_refined_scd2").count() == X.cards(spark, SF_SMALL).count()
    assert spark.table(f"{db}.transactions_refined").count() == latest
