"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import history as H
from ledgerlake.operators import index as IX
from ledgerlake.operators import scd2 as S
from ledgerlake.operators.patch import keyed_patch
from ledgerlake.session import fresh_dir
from ledgerlake.plans.corrections_job import apply_corrections


def test_index_hot_id(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("id"),
        (F.col("id") % 97).alias("client_id"),
        F.lit(1).cast("long").alias("card_id"),
        F.lit("s").alias("table_source"),
        F.make_timestamp(F.lit(2026), F.lit(4), (F.col("id") % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)).alias("ingest_time"),
        F.lit(2026).alias("ingest_year"),
        F.lit(4).alias("ingest_month"),
        (F.col("id") % 28 + 1).cast("int").alias("ingest_day"),
        *[F.lit("v").alias(c) for c in schemas.LOOKUP_RECORD_COLUMNS],
    )
    idx = IX.transaction_index(df)
    assert idx.count() == 1 + (n - n // 3)
    hot = idx.filter("transaction_id = 7").first()
    assert hot["ingest_day"] == 28 and hot["client_id"] == 96  # latest day, then greatest client
    # lookups of the hot id return every record carrying it
    got = IX.lookup_transactions(idx, df, spark.createDataFrame([(7,)] * 50, "transaction_id long"))
    assert got.count() == n // 3


def test_history_hot_key_on_current_side(spark):
    attrs = schemas.USER_COLUMNS[1:]
    ddl = "id long, " + ", ".join(f"{c} string" for c in attrs)
    cur = [(1, *(["a"] * len(attrs)))] * 500 + [(1, *(["b"] * len(attrs)))] * 500 + [(k, *(["a"] * len(attrs))) for k in range(2, 2000)]
    inc = [(1, *(["a"] * len(attrs)))] + [(k, *(["a"] * len(attrs))) for k in range(2, 1000)]
    delta = H.history_delta(H.normalize_users(spark.createDataFrame(cur, ddl)), H.normalize_users(spark.createDataFrame(inc, ddl)), "2026-04-24 00:00:00", "b")
    counts = {r["change_type"]: r["count"] for r in delta.groupBy("change_type").count().collect()}
    assert counts == {"UPDATE": 500, "DELETE": 1000}


def test_scd2_many_versions_of_one_key(spark):
    ddl = "card_id long, client_id long, " + ", ".join(f"{c} string" for c in schemas.CARD_COLUMNS[2:])
    rest = ["x"] * (len(schemas.CARD_COLUMNS) - 3)
    v = S.initial_versions(S.normalize_cards(spark.createDataFrame([(1, 1, "v0", *rest), (2, 1, "w", *rest)], ddl)), "2026-01-01 00:00:00", "b0")
    for i in range(1, 8):
        inc = S.normalize_cards(spark.createDataFrame([(1, 1, f"v{i}", *rest), (2, 1, "w", *rest)], ddl))
        v = S.merge(v, inc, f"2026-01-0{i + 1} 00:00:00", f"b{i}")
        v = v.checkpoint()  # cut the growing plan (reliable checkpoint, shared dir)
    assert v.filter("card_id = 1").count() == 8
    assert v.filter("card_id = 1 AND is_current").first()["card_brand"] == "v7"
    assert v.filter("card_id = 2").count() == 1


def test_keyed_patch_and_corrections_job(spark):
    base = fresh_dir(spark, "corrections_test")
    src = spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("x"), F.lit("s").alias("y"))
    src.write.parquet(f"{base}/src")
    fixes = spark.createDataFrame([(3, None, "t"), (5, 1, "u")], "id long, x long, y string")
    out = apply_corrections(spark, f"{base}/src", fixes, f"{base}/out")
    got = {r["id"]: r for r in spark.read.parquet(f"{base}/out").collect()}
    assert got[3]["x"] is None and got[3]["y"] == "t" and got[5]["x"] == 1 and got[6]["x"] == 12
    assert out.count() == 100
    assert keyed_patch(src, fixes.select("id", "y")).filter("y = 's'").count() == 98


from tests.conftest import confs  # noqa: E402


LARGE_DATA_MODE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_history_join_is_split_for_a_hot_key(spark):
    from tests.conftest import plan_of

    attrs = schemas.USER_COLUMNS[1:]
    ddl = "id long, " + ", ".join(f"{c} string" for c in attrs)
    pad = ["x" * 40] * (len(attrs) - 1)
    cur = [(1, "a", *pad)] * 3000 + [(k, "a", *pad) for k in range(2, 500)]
    inc = [(1, "b", *pad)] + [(k, "a", *pad) for k in range(2, 400)]
    with confs(spark, **LARGE_DATA_MODE):
        delta = H.history_delta(
            H.normalize_users(spark.createDataFrame(cur, ddl).repartition(8)),
            H.normalize_users(spark.createDataFrame(inc, ddl)),
            "2026-04-24 00:00:00", "b",
        )
        counts = {r["change_type"]: r["count"] for r in delta.groupBy("change_type").count().collect()}
        delta.collect()
        final = plan_of(delta, "simple")
    assert counts == {"UPDATE": 3000, "DELETE": 100}
    assert "SortMergeJoin" in final and "skew=true" in final, final


def test_append_spreads_a_hot_day_over_writers(spark):
    from ledgerlake.operators import refine
    from ledgerlake.sinks.writers import append_refined_transactions
    from ledgerlake.sources import tpch_fixtures as X
    from tests.conftest import SF_SMALL

    raw = X.transactions(spark, SF_SMALL)
    # a third of all rows on one day
    hot = raw.withColumn("date", F.when(F.col("id") % 3 == 0, F.lit("1998-01-01 00:00:00")).otherwise(F.col("date")))
    path = fresh_dir(spark, "hot_day_test")
    with confs(spark, **LARGE_DATA_MODE):
        append_refined_transactions(refine.transactions_refined(hot), path)
    back = spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path)
    day = back.filter("txn_year = 1998 AND txn_month = 1 AND txn_day = 1")
    assert day.count() >= raw.count() // 3
    assert len(day.inputFiles()) > 1  # the hot day was split over several writers
    assert back.count() == refine.transactions_dated(refine.transactions_refined(hot)).count()


def test_keyed_patch_join_is_split_for_a_hot_key(spark):
    from tests.conftest import plan_of

    # distinct padding per row, so the hot key's shuffle block stays large
    # after compression
    hot = [(1, "old", f"{i:060d}") for i in range(3000)]
    rest = [(k, "old", f"{k:060d}") for k in range(2, 500)]
    table = spark.createDataFrame(hot + rest, "id long, v string, w string").repartition(8)
    fixes = spark.createDataFrame([(1, "new")] + [(k, "new") for k in range(400, 450)], "id long, v string")
    with confs(spark, **LARGE_DATA_MODE):
        out = keyed_patch(table, fixes)
        counts = {r["v"]: r["count"] for r in out.groupBy("v").count().collect()}
        out.collect()
        final = plan_of(out, "simple")
    assert counts == {"new": 3050, "old": 448}
    assert "SortMergeJoin(skew=true)" in final, final


def test_lookup_splits_a_hot_id(spark):
    from tests.conftest import plan_of

    n = 6000
    # distinct padding per row, so the hot id's shuffle block stays large after compression
    records = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("id"),
        F.lit(1).cast("long").alias("client_id"), F.lit(1).cast("long").alias("card_id"),
        F.lit("s").alias("table_source"), F.lit(None).cast("timestamp").alias("ingest_time"),
        F.lit(2026).alias("ingest_year"), F.lit(4).alias("ingest_month"), F.lit(21).alias("ingest_day"),
        *[F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256).alias(c) for c in schemas.LOOKUP_RECORD_COLUMNS],
    )
    index = IX.transaction_index(records)
    requests = records.select(F.col("id").alias("transaction_id"))
    with confs(spark, **LARGE_DATA_MODE):
        found = IX.lookup_transactions(index, records, requests)
        assert len(found.collect()) == n
        plan = plan_of(found, "simple")
    # the record join (the topmost) is between two shuffles of its own and is split
    joins = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "SortMergeJoin" in line]
    assert "SortMergeJoin(skew=true)" in joins[0] and "[id#" in joins[0], plan
