"""SCD2 merge: invariants, NULL and duplicate keys, idempotence, one join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import scd2 as S
from ledgerlake.sources import tpch_fixtures as X
from tests.conftest import SF_SMALL, plan_of, rows

T1, T2, T3 = "2026-04-23 00:00:00", "2026-04-24 00:00:00", "2026-04-25 00:00:00"
DDL = "card_id long, client_id long, " + ", ".join(f"{c} string" for c in schemas.CARD_COLUMNS[2:])


def cards(spark, data):
    full = [(k, 1, v, *(["x"] * (len(schemas.CARD_COLUMNS) - 3))) for k, v in data]
    return S.normalize_cards(spark.createDataFrame(full, DDL))


def check_invariants(df):
    cur = df.filter((F.col("is_current") == True) & F.col("card_id").isNotNull()).groupBy("card_id").count()  # noqa: E712
    assert cur.filter(F.col("count") > 1).count() == 0
    # closed versions end where the next one starts; current ones are open
    assert df.filter((F.col("is_current") == True) & F.col("effective_to").isNotNull()).count() == 0  # noqa: E712
    assert df.filter((F.col("is_current") == False) & (F.col("effective_to") < F.col("effective_from"))).count() == 0  # noqa: E712


def test_insert_update_absent(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a"), (2, "b"), (3, "c")]), T1, "b1")
    v2 = S.merge(v1, cards(spark, [(1, "a"), (2, "B"), (4, "d")]), T2, "b2")
    got = rows(v2, "card_id", "effective_from")
    assert [(r["card_id"], r["card_brand"], r["is_current"]) for r in got] == [
        (1, "a", True), (2, "b", False), (2, "B", True), (3, "c", True), (4, "d", True)]
    closed = [r for r in got if r["is_current"] is False][0]
    new = [r for r in got if r["card_id"] == 2 and r["is_current"]][0]
    assert closed["effective_to"] == new["effective_from"] == dt.datetime(2026, 4, 24)
    assert closed["batch_id"] == "b1" and new["batch_id"] == "b2"
    check_invariants(v2)


def test_rerun_with_same_batch_changes_nothing(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a"), (2, "b")]), T1, "b1")
    inc = cards(spark, [(1, "a"), (2, "B")])
    v2 = S.merge(v1, inc, T2, "b2")
    v3 = S.merge(v2, inc, T3, "b3")
    assert sorted(map(tuple, v2.collect())) == sorted(map(tuple, v3.collect()))


def test_null_key_and_null_is_current_survive(spark):
    v1 = S.initial_versions(cards(spark, [(None, "n"), (1, "a")]), T1, "b1")
    v1 = v1.withColumn("is_current", F.when(F.col("card_id").isNull(), F.col("is_current")).otherwise(F.col("is_current")))
    odd = v1.filter(F.col("card_id") == 1).withColumn("is_current", F.lit(None).cast("boolean")).withColumn("card_brand", F.lit("old"))
    v1 = v1.unionByName(odd)
    v2 = S.merge(v1, cards(spark, [(None, "m"), (1, "A")]), T2, "b2")
    got = rows(v2, "card_id", "card_brand")
    assert any(r["card_id"] is None and r["card_brand"] == "n" for r in got)   # NULL key kept as is
    assert not any(r["card_brand"] == "m" for r in got)                         # NULL incoming key ignored
    assert any(r["card_brand"] == "old" and r["is_current"] is None for r in got)  # NULL is_current kept
    assert [r["card_brand"] for r in got if r["card_id"] == 1 and r["is_current"]] == ["A"]


def test_duplicate_incoming_keys(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a")]), T1, "b1")
    inc = cards(spark, [(1, "b"), (1, "c")])
    v2 = S.merge(v1, inc, T2, "b2", order=["card_brand"])
    check_invariants(v2)
    assert [r["card_brand"] for r in rows(v2.filter("is_current"))] == ["c"]
    for broken in (S.merge(v1, inc, T2, "b2"), S.initial_versions(inc, T2, "b2")):
        with pytest.raises(Exception, match="incoming cards has duplicate keys, e.g. 1 in 2 rows"):
            broken.count()


def test_two_current_versions_of_one_key_are_refused(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a")]), T1, "b1")
    with pytest.raises(Exception, match="current versions has duplicate keys"):
        S.merge(v1.unionByName(v1), cards(spark, [(1, "b")]), T2, "b2").collect()


def test_first_load_takes_the_order_and_refuses_repeats_without_it(spark):
    from ledgerlake.plans.scd2_job import run_cards_scd2
    from ledgerlake.session import fresh_dir

    base, inc = fresh_dir(spark, "scd2_first_test"), cards(spark, [(1, "b"), (1, "c")])
    with pytest.raises(Exception, match="duplicate keys"):
        run_cards_scd2(spark, inc, "ledgerlake_first_refused", f"{base}/r", "2026-04-23 00:00:00")
    run_cards_scd2(spark, inc, "ledgerlake_first_ordered", f"{base}/o", "2026-04-23 00:00:00", order=["card_brand"])
    assert [r["card_brand"] for r in spark.table("ledgerlake_first_ordered").collect()] == ["c"]


def test_close_missing(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a"), (2, "b")]), T1, "b1")
    v2 = S.merge(v1, cards(spark, [(1, "a")]), T2, "b2", close_missing=True)
    got = {r["card_id"]: r for r in rows(v2)}
    assert got[2]["is_current"] is False and got[2]["effective_to"] == dt.datetime(2026, 4, 24)


def test_normalize_validation(spark):
    bad = spark.createDataFrame([(1,)], "x long")
    with pytest.raises(ValueError, match="lacks card_id, client_id"):
        S.normalize_cards(bad)
    with pytest.raises(ValueError, match="lacks client_id"):
        S.normalize_cards(spark.createDataFrame([(1,)], "id long"))
    with pytest.raises(ValueError, match="lacks card_brand"):
        S.normalize_cards(spark.createDataFrame([(1, 2)], "id long, client_id long"))


def test_merge_plan_has_one_join(spark):
    v1 = S.initial_versions(S.normalize_cards(X.cards_snapshot_1(spark, SF_SMALL)), T1, "b1")
    merged = S.merge(v1, S.normalize_cards(X.cards_snapshot_2(spark, SF_SMALL)), T2, "b2")
    plan = plan_of(merged, "simple")
    joins = plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin")
    assert joins == 1, plan
    check_invariants(merged)


def test_updated_keys_closed_and_kept_partition_the_existing_rows(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a"), (2, "b"), (3, "c")]), T1, "b1")
    inc = cards(spark, [(1, "A"), (2, "b"), (4, "d")])
    assert [r[0] for r in S.updated_keys(v1, inc).collect()] == [1]
    closed = S.closed_versions(v1, inc, T2)
    kept = S.kept_versions(v1, inc)
    assert closed.count() + kept.count() == v1.count()
    assert [r["card_id"] for r in rows(S.insert_rows(v1, inc, T2, "b2"))] == [4]


def test_initial_load_keeps_one_current_version_per_key(spark):
    v1 = S.initial_versions(cards(spark, [(1, "a"), (1, "b"), (None, "n"), (None, "m"), (2, "c")]), T1, "b1", order=["card_brand"])
    got = sorted((r["card_id"] is None, r["card_id"], r["card_brand"]) for r in v1.collect())
    assert got == [(False, 1, "b"), (False, 2, "c"), (True, None, "m"), (True, None, "n")]
    check_invariants(v1)


def test_bucketed_versions_give_the_same_rows_with_a_one_sided_shuffle(spark):
    from ledgerlake.plans.scd2_job import run_cards_scd2
    from ledgerlake.session import fresh_dir

    base = fresh_dir(spark, "scd2_bucketed_test")
    runs = [(X.cards_snapshot_1(spark, SF_SMALL), T1), (X.cards_snapshot_2(spark, SF_SMALL), T2)]
    for table, buckets in (("ledgerlake_scd2_plain", None), ("ledgerlake_scd2_bucketed", 8)):
        for src, clock in runs:
            run_cards_scd2(spark, src, table, f"{base}/{table}", clock, bucket_count=buckets)
    plain, bucketed = spark.table("ledgerlake_scd2_plain"), spark.table("ledgerlake_scd2_bucketed")
    assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0
    check_invariants(bucketed)
    from tests.conftest import confs

    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with confs(spark, **no_broadcast):
        nxt = S.merge(bucketed, S.normalize_cards(X.cards_snapshot_1(spark, SF_SMALL)), T3, "b3")
        plan = plan_of(nxt, "simple")
        assert plan.count("SortMergeJoin") == 1
        # the bucketed dimension is not shuffled; only the incoming side is
        # (its rows, and its keys once more for the check of repeats)
        assert plan.count("Exchange hashpartitioning") == 2, plan
        plain_plan = plan_of(S.merge(plain, S.normalize_cards(X.cards_snapshot_1(spark, SF_SMALL)), T3, "b3"), "simple")
        assert plain_plan.count("Exchange hashpartitioning") == 4, plain_plan


def test_split_storage_appends_closed_versions_and_never_reads_them(spark):
    from ledgerlake.plans.scd2_job import dimension, run_cards_scd2, run_cards_scd2_split
    from ledgerlake.session import fresh_dir

    base = fresh_dir(spark, "scd2_split_test")
    batches = [[(1, "a"), (2, "b"), (None, "n")], [(1, "A"), (2, "b")], [(1, "x"), (2, "y"), (3, "z")]]
    for i, data in enumerate(batches):
        clock = f"2026-04-{23 + i} 00:00:00"
        run_cards_scd2(spark, cards(spark, data), "ledgerlake_whole", f"{base}/whole", clock)
        before = spark.table("ledgerlake_split") if i else None
        run_cards_scd2_split(spark, cards(spark, data), "ledgerlake_split", f"{base}/live", f"{base}/closed", clock)
        assert before is None or "closed" not in plan_of(S.merge(before, cards(spark, data), clock, "b"), "extended")
    whole, split = spark.table("ledgerlake_whole"), dimension(spark, "ledgerlake_split", f"{base}/closed")
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, split.select(*whole.columns).collect()), key=repr)
    assert spark.table("ledgerlake_split").filter("not is_current").count() == 0
    # running the last batch's log part again replaces it
    assert spark.read.parquet(f"{base}/closed").groupBy("closed_by_batch").count().count() == 2
