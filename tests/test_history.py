"""Users change history: UPDATE / DELETE before images, NULL and duplicate keys."""

import pytest

from ledgerlake import schemas
from ledgerlake.operators import history as H
from tests.conftest import plan_of, rows

ATTRS = schemas.USER_COLUMNS[1:]
DDL = "id long, " + ", ".join(f"{c} string" for c in ATTRS)


def users(spark, data):
    full = [(k, *([v] + ["x"] * (len(ATTRS) - 1))) for k, v in data]
    return H.normalize_users(spark.createDataFrame(full, DDL))


def test_update_delete_and_no_insert(spark):
    cur = users(spark, [(1, "a"), (2, "b"), (3, None), (4, "d")])
    inc = users(spark, [(1, "a"), (2, "B"), (3, None), (5, "e")])
    out = rows(H.history_delta(cur, inc, "2026-04-24 00:00:00", "b2"), "user_id")
    assert [(r["user_id"], r["change_type"], r["current_age"]) for r in out] == [(2, "UPDATE", "b"), (4, "DELETE", "d")]
    assert all(r["batch_id"] == "b2" for r in out)
    assert list(H.history_delta(cur, inc, "2026-04-24 00:00:00", "b2").columns) == schemas.USER_COLUMNS + schemas.HISTORY_META


def test_null_safe_comparison(spark):
    cur = users(spark, [(1, None), (2, None), (3, "c")])
    inc = users(spark, [(1, None), (2, "v"), (3, None)])
    out = rows(H.history_delta(cur, inc, "2026-04-24 00:00:00", "b"), "user_id")
    assert [r["user_id"] for r in out] == [2, 3]


def test_null_keys_are_never_logged(spark):
    cur = users(spark, [(None, "a"), (1, "a")])
    inc = users(spark, [(None, "b"), (1, "a")])
    assert H.history_delta(cur, inc, "2026-04-24 00:00:00", "b").count() == 0


def test_duplicate_incoming_keys(spark):
    cur = users(spark, [(1, "a")])
    inc = users(spark, [(1, "a"), (1, "z")])
    # by the named order the row "z" counts -> one UPDATE, never two
    out = rows(H.history_delta(cur, inc, "2026-04-24 00:00:00", "b", order=["current_age"]))
    assert [(r["user_id"], r["change_type"]) for r in out] == [(1, "UPDATE")]
    # without an order the result cannot be computed, not even counted
    for broken in (H.history_delta(cur, inc, "2026-04-24 00:00:00", "b"), H.row_changed(cur, inc)):
        with pytest.raises(Exception, match="incoming snapshot has duplicate keys, e.g. 1 in 2 rows"):
            broken.count()


def test_superseded_rows_are_what_the_order_drops(spark):
    from ledgerlake.operators.dedupe import latest_per_key, superseded_rows

    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (1, None, "c"), (2, 5, "x"), (None, 1, "n"), (None, 3, "m")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    kept = [tuple(r) for r in latest_per_key(df, "k", ["o"]).collect()]
    dropped = [tuple(r) for r in superseded_rows(df, "k", ["o"]).collect()]
    assert sorted(kept + dropped, key=repr) == sorted(data, key=repr)
    assert sorted(dropped, key=repr) == sorted([(1, 1, "a"), (1, 2, "b"), (1, None, "c"), (None, 1, "n")], key=repr)


def test_published_snapshot_has_one_row_per_key(spark):
    from ledgerlake.plans.history_job import run_users_history
    from ledgerlake.session import fresh_dir

    base = fresh_dir(spark, "history_order_test")
    cur = users(spark, [(1, "a"), (2, "b")])
    inc = users(spark, [(1, "p"), (1, "q"), (2, "b"), (None, "n")])
    for batch in ("b1", "b2"):  # the same snapshot again logs nothing more
        run_users_history(cur, inc, f"{base}/log", f"{base}/current", "2026-04-24 00:00:00", batch, order=["current_age"])
        cur = spark.read.parquet(f"{base}/current/version_{batch}")
    assert sorted((r["user_id"] or 0, r["current_age"]) for r in cur.collect()) == [(0, "n"), (1, "q"), (2, "b")]
    log = spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/log").collect()
    assert [(r["user_id"], r["batch_id"]) for r in log] == [(1, "b1")]


def test_user_id_column_accepted_after_refresh(spark):
    df = users(spark, [(7, "a")])  # already has user_id
    assert H.normalize_users(df).first()["user_id"] == 7


def test_one_join_and_change_count(spark):
    cur = users(spark, [(1, "a"), (2, "b")])
    inc = users(spark, [(1, "A")])
    delta = H.history_delta(cur, inc, "2026-04-24 00:00:00", "b")
    assert H.change_count(delta).first()["change_count"] == 2
    plan = plan_of(delta)
    assert plan.count("Join ") + plan.count("Join(") >= 1
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") <= 2


def test_bucketed_snapshot_makes_the_diff_shuffle_one_side(spark):
    from ledgerlake.plans.history_job import run_users_history
    from ledgerlake.session import fresh_dir
    from ledgerlake.sources import tpch_fixtures as X
    from tests.conftest import SF_SMALL, confs

    base = fresh_dir(spark, "history_bucketed_test")
    table = "ledgerlake_users_current_bucketed"
    u1, u2 = X.users_snapshot_1(spark, SF_SMALL), X.users_snapshot_2(spark, SF_SMALL)
    run_users_history(u1, u1, f"{base}/h", f"{base}/c", "2026-04-23 00:00:00", "b1", table, bucket_count=8)
    with confs(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        delta = H.history_delta(spark.table(table), H.normalize_users(u2), "2026-04-24 00:00:00", "b2")
        plan = plan_of(delta, "simple")
        # the bucketed snapshot is not shuffled; the incoming rows are, and their keys for the check
        assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2, plan
        want = H.history_delta(H.normalize_users(u1), H.normalize_users(u2), "2026-04-24 00:00:00", "b2")
        assert delta.exceptAll(want).count() == 0 and want.exceptAll(delta).count() == 0
