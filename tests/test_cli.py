"""The spark-submit entry points, run in-process on fixture data."""

import json

from ledgerlake import cli, schemas
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.writers import write_partitioned
from ledgerlake.sources import tpch_fixtures as X
from tests.conftest import SF_SMALL


def test_index_lookup_history_scd2_warehouse(spark, tmp_path):
    base = fresh_dir(spark, "cli_test")
    write_partitioned(X.transactions(spark, SF_SMALL), f"{base}/raw/transactions", schemas.INGEST_PARTITIONS)
    write_partitioned(X.users(spark, SF_SMALL), f"{base}/raw/users", schemas.INGEST_PARTITIONS)
    X.users_snapshot_1(spark, SF_SMALL).write.parquet(f"{base}/u1")
    X.users_snapshot_2(spark, SF_SMALL).write.parquet(f"{base}/u2")
    X.cards_snapshot_1(spark, SF_SMALL).write.parquet(f"{base}/c1")
    X.cards_snapshot_2(spark, SF_SMALL).write.parquet(f"{base}/c2")

    cli.main(["index", "--transactions", f"{base}/raw/transactions", "--index", f"{base}/raw/index"], spark)
    out = cli.main(["index", "--transactions", f"{base}/raw/transactions", "--index", f"{base}/raw/index",
                    "--update-days", "2026-04-23", "--output", f"{base}/raw/index2"], spark)
    assert out["index"] == f"{base}/raw/index2"
    assert spark.read.parquet(out["index"]).count() == spark.read.parquet(f"{base}/raw/index").count()
    some = spark.read.parquet(f"{base}/raw/index").select("transaction_id").first()[0]
    out = cli.main(["lookup", "--transactions", f"{base}/raw/transactions", "--index", f"{base}/raw/index",
                    "--prune", "--output", f"{base}/lookup_ids", str(some), "-1"], spark)
    assert [r["transaction_id"] for r in spark.read.parquet(f"{base}/lookup_ids/found").collect()] == [some]
    assert [r["transaction_id"] for r in spark.read.parquet(f"{base}/lookup_ids/missing").collect()] == [-1]
    assert out["found_count"] == 1 and out["index_schema"].startswith("struct<transaction_id:bigint")

    spark.read.parquet(f"{base}/raw/transactions").select("id").write.parquet(f"{base}/requests")
    cli.main(["lookup", "--transactions", f"{base}/raw/transactions", "--index", f"{base}/raw/index",
              "--ids-parquet", f"{base}/requests", "--output", f"{base}/lookup_out"], spark)
    assert spark.read.parquet(f"{base}/lookup_out/found").count() == X.transactions(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{base}/lookup_out/missing").count() == 0

    cli.main(["users-history", "--current", f"{base}/u1", "--incoming", f"{base}/u2", "--history", f"{base}/h",
              "--current-base", f"{base}/current", "--clock", "2026-04-24 00:00:00"], spark)
    assert spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/h").count() > 0

    table = "ledgerlake_cli_cards"
    for src, clock in ((f"{base}/c1", "2026-04-23 00:00:00"), (f"{base}/c2", "2026-04-24 00:00:00")):
        cli.main(["cards-scd2", "--incoming", src, "--table", table, "--base", f"{base}/scd2", "--clock", clock], spark)

    cfg = tmp_path / "warehouse.json"
    cfg.write_text(json.dumps({
        "database": "ledgerlake_cli_dw",
        "users_source": f"{base}/raw/users",
        "cards_scd2_source": table,
        "transactions_source": f"{base}/raw/transactions",
        "users_refined": f"{base}/dw/users_refined",
        "cards_refined_scd2": f"{base}/dw/cards_refined_scd2",
        "transactions_refined": f"{base}/dw/transactions_refined",
        "database_location": f"{base}/dw/db",
        "register_tables": False,
    }))
    out = cli.main(["warehouse", "--config", str(cfg), "--clock", "2026-04-24 00:00:00"], spark)
    assert set(out["tables"]) == {"users_refined", "cards_refined_scd2", "transactions_refined"}
    assert spark.read.parquet(f"{base}/dw/cards_refined_scd2").count() == spark.table(table).count()
