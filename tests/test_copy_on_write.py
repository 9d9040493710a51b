"""Copy-on-write of SCD2 buckets and index days; the repeated-key guard; logs of batches without rows."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.derived import row_digest, same_values
from ledgerlake.operators import history as H
from ledgerlake.operators import index as IX
from ledgerlake.operators import scd2 as S
from ledgerlake.operators.dedupe import refuse_repeats
from ledgerlake.operators.patch import keyed_patch
from ledgerlake.plans.history_job import run_users_history
from ledgerlake.plans.index_job import build_index_table, update_index_table
from ledgerlake.plans.registered import _unique
from ledgerlake.plans.scd2_job import dimension, run_cards_scd2_buckets, run_cards_scd2_split
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.partitions import publish_partitions, published
from ledgerlake.sinks.writers import append_batch, write_partitioned
from ledgerlake.sources import tpch_fixtures as X
from tests.conftest import SF_SMALL, plan_of

T1, T2, T3 = "2026-04-23 00:00:00", "2026-04-24 00:00:00", "2026-04-25 00:00:00"
CARDS = "card_id long, client_id long, " + ", ".join(f"{c} string" for c in schemas.CARD_COLUMNS[2:])
USERS = "user_id long, " + ", ".join(f"{c} string" for c in schemas.USER_COLUMNS[1:])


def cards(spark, data):
    return spark.createDataFrame([(k, 1, v, *(["x"] * (len(schemas.CARD_COLUMNS) - 3))) for k, v in data], CARDS)


def users(spark, data):
    return spark.createDataFrame([(k, v, *(["x"] * (len(schemas.USER_COLUMNS) - 2))) for k, v in data], USERS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


# ---- the guard ----------------------------------------------------------------

def guarded(spark):
    """(name, result that must not be computed, columns to filter by)."""
    old = S.initial_versions(S.normalize_cards(cards(spark, [(1, "a"), (2, "b")])), T1, "b1")
    inc = S.normalize_cards(cards(spark, [(1, "A"), (1, "B"), (3, "c")]))
    cur, new = users(spark, [(1, "a"), (2, "b")]), users(spark, [(1, "x"), (1, "y")])
    fixes = spark.createDataFrame([(1, "p"), (1, "q")], "card_id long, card_brand string")
    return {
        "closed_versions": (S.closed_versions(old, inc, T2), "is_current = false"),
        "updated_keys": (S.updated_keys(old, inc), "card_id > 1"),
        "insert_rows": (S.insert_rows(old, inc, T2, "b2"), "card_brand is not null"),
        "kept_versions": (S.kept_versions(old, inc), "is_current"),
        "merge": (S.merge(old, inc, T2, "b2"), "not is_current"),
        "diff": (S.diff(old, inc), "action = 'INSERT'"),
        "changed_keys": (S.changed_keys(old, inc), "action = 'INSERT'"),
        "initial_versions": (S.initial_versions(inc, T1, "b1"), "is_current"),
        "current_versions": (S.current_versions(S.initial_versions(inc, T1, "b1")), "batch_id = 'b1'"),
        "history_delta": (H.history_delta(cur, new, T2, "b2"), "change_type = 'DELETE'"),
        "row_changed": (H.row_changed(cur, new), "not row_changed"),
        "keyed_patch": (keyed_patch(cards(spark, [(1, "a"), (2, "b")]), fixes, "card_id"), "client_id = 1"),
    }


@pytest.mark.parametrize("name", ["closed_versions", "updated_keys", "insert_rows", "kept_versions", "merge", "diff", "changed_keys", "initial_versions", "current_versions", "history_delta", "row_changed", "keyed_patch"])
def test_repeated_keys_raise_under_any_filter_and_projection(spark, name):
    result, condition = guarded(spark)[name]
    for df in (result.select(result.columns[-1]), result.filter(condition), result.filter(condition).agg(F.count(F.lit(1)))):
        with pytest.raises(Exception, match="duplicate keys"):
            df.collect()


def test_the_guard_leaves_other_rows_alone(spark):
    df = spark.range(50).withColumn("v", F.lit("x"))
    checked = refuse_repeats(df, df, "id", "rows")
    assert checked.filter("v = 'x'").count() == checked.select("v").count() == 50
    assert checked.filter("v is null").count() == 0


# ---- digests --------------------------------------------------------------------

def test_digests_are_equal_for_equal_rows_only(spark):
    values = [None, "", "-", "1:a", "a", "0:", "1", "é"]
    data = [(i * 8 + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)]
    df = spark.createDataFrame(data, "i int, a string, b string").withColumn("d", row_digest(["a", "b"]))
    assert df.select("d").distinct().count() == len(data)
    x, y = df.alias("x"), df.alias("y")
    pairs = x.join(y, F.expr("x.d = y.d")).select(same_values("x", "y", ["a", "b"]).alias("same"), F.expr("x.i = y.i").alias("one"))
    assert pairs.filter("not same or not one").count() == 0


def test_changed_keys_equal_the_diff_and_shuffle_narrow_rows(spark):
    old = S.initial_versions(S.normalize_cards(X.cards_snapshot_1(spark, SF_SMALL)), T1, "b1")
    inc = S.normalize_cards(X.cards_snapshot_2(spark, SF_SMALL))
    wide = S.diff(old, inc).select("card_id", "action")
    assert rows_of(S.changed_keys(old, inc)) == rows_of(wide.filter("action in ('INSERT', 'UPDATE')"))
    assert rows_of(S.changed_keys(old, inc, close_missing=True)) == rows_of(wide.filter("action <> 'UNCHANGED'"))
    plan = plan_of(S.changed_keys(old, inc), "simple")
    assert all("card_brand" not in line for line in plan.splitlines() if "Exchange" in line)


# ---- SCD2 by buckets ----------------------------------------------------------------

def test_only_buckets_with_a_changed_key_are_written(spark):
    base, table = fresh_dir(spark, "cow"), _unique("cow")
    first = [(i, f"v{i}") for i in range(400)]
    assert run_cards_scd2_buckets(spark, cards(spark, first), table, base, f"{base}/closed", T1, "b1", buckets=32) == list(range(32))
    before = files(base)
    changed = {7, 130, 255, 399}  # one per cent
    second = [(i, "new" if i in changed else v) for i, v in first]
    touched = run_cards_scd2_buckets(spark, cards(spark, second), table, base, f"{base}/closed", T2, "b2")
    after = files(base)
    assert 1 <= len(touched) <= 4 and all(after[f] == t for f, t in before.items())
    data = {f.split("/bucket=")[1].split("/")[0] for f in after if f not in before and "/bucket=" in f}
    assert {int(b) for b in data} == set(touched)
    expected = S.merge(S.initial_versions(S.normalize_cards(cards(spark, first)), T1, "b1"), S.normalize_cards(cards(spark, second)), T2, "b2")
    assert rows_of(dimension(spark, table, f"{base}/closed")) == rows_of(expected)
    # nothing changed: no data is written, the table is published under the new version
    assert run_cards_scd2_buckets(spark, cards(spark, second), table, base, f"{base}/closed", T3, "b3") == []
    assert not [f for f in files(base) if f not in after and "/bucket=" in f]
    assert published(spark, table, base)[0] == "b3" and rows_of(dimension(spark, table, f"{base}/closed")) == rows_of(expected)
    with pytest.raises(ValueError, match="already published"):
        run_cards_scd2_buckets(spark, cards(spark, second), table, base, f"{base}/closed", T3, "b3")


def test_a_reader_prunes_buckets_and_emptied_buckets_go(spark):
    base, table = fresh_dir(spark, "cow"), _unique("cow")
    run_cards_scd2_buckets(spark, cards(spark, [(i, "a") for i in range(40)] + [(None, "n")]), table, base, f"{base}/closed", T1, "b1", buckets=8)
    bucket = spark.table(table).filter("card_id = 3").first()["bucket"]
    assert f"PartitionFilters: [isnotnull(bucket#" in plan_of(spark.table(table).filter(F.col("bucket") == bucket), "simple")
    gone = [r["card_id"] for r in spark.table(table).filter((F.col("bucket") == bucket) & F.col("card_id").isNotNull()).collect()]
    left = [(i, "a") for i in range(40) if i not in gone]
    run_cards_scd2_buckets(spark, cards(spark, left), table, base, f"{base}/closed", T2, "b2", close_missing=True)
    open_ = spark.table(table)
    assert sorted(r["card_id"] for r in open_.filter("card_id is not null").collect()) == [i for i, _ in left]
    assert open_.filter("card_id is null").count() == 1
    assert dimension(spark, table, f"{base}/closed").count() == 41


def test_a_failed_version_is_written_anew(spark):
    base, table = fresh_dir(spark, "cow"), _unique("cow")
    run_cards_scd2_buckets(spark, cards(spark, [(1, "a"), (2, "b")]), table, base, f"{base}/closed", T1, "b1", buckets=4)
    with pytest.raises(Exception, match="duplicate keys"):
        run_cards_scd2_buckets(spark, cards(spark, [(1, "x"), (1, "y")]), table, base, f"{base}/closed", T2, "b2")
    assert published(spark, table, base)[0] == "b1" and spark.table(table).count() == 2
    run_cards_scd2_buckets(spark, cards(spark, [(1, "x"), (2, "b")]), table, base, f"{base}/closed", T2, "b2")
    assert sorted(r["card_brand"] for r in spark.table(table).collect()) == ["b", "x"]


def test_rows_outside_of_the_replaced_partitions_are_refused(spark):
    base, table = fresh_dir(spark, "cow"), _unique("cow")
    df = spark.range(4).select("id", F.col("id").cast("int").alias("p"))
    with pytest.raises(ValueError, match="outside"):
        publish_partitions(df, table, base, "v1", df.schema, ["p"], [(0,), (1,)])
    assert not spark.catalog.tableExists(table)


# ---- logs ------------------------------------------------------------------------------

def test_an_empty_rerun_clears_its_batch(spark):
    path = fresh_dir(spark, "log")
    df = spark.createDataFrame([(1, "b1")], "v int, batch_id string")
    append_batch(df, path, "b1")
    append_batch(df, path, "b2")
    append_batch(df.limit(0), path, "b1")
    read = lambda: rows_of(spark.read.schema("v int, batch_id string").parquet(path))
    assert read() == [(1, "b2")]
    append_batch(df.limit(0), path, "b2")
    assert read() == []
    with pytest.raises(ValueError):
        append_batch(df, path, "b/1")


def test_an_empty_rerun_of_the_jobs(spark):
    base = fresh_dir(spark, "rerun")
    one, two = users(spark, [(1, "a"), (2, "b")]), users(spark, [(1, "A")])
    run_users_history(one, two, f"{base}/history", f"{base}/current", T2, "b2")
    log = lambda: spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/history")
    assert log().count() == 2
    delta = run_users_history(one, one, f"{base}/history", f"{base}/current", T2, "b2")
    assert log().count() == 0 and delta.count() == 0
    table = _unique("split")
    run_cards_scd2_split(spark, cards(spark, [(1, "a")]), table, base, f"{base}/closed", T1, "b1")
    run_cards_scd2_split(spark, cards(spark, [(1, "b")]), table, base, f"{base}/closed", T2, "b2")
    assert dimension(spark, table, f"{base}/closed").count() == 2


def test_the_returned_delta_is_what_was_logged(spark):
    base, table = fresh_dir(spark, "delta"), _unique("current")
    run_users_history(users(spark, [(1, "a")]), users(spark, [(1, "a")]), f"{base}/history", f"{base}/current", T1, "b1", current_table=table)
    delta = run_users_history(spark.table(table), users(spark, [(1, "b")]), f"{base}/history", f"{base}/current", T2, "b2", current_table=table)
    assert [(r["user_id"], r["change_type"], r["batch_id"]) for r in delta.collect()] == [(1, "UPDATE", "b2")]


def test_the_split_merge_is_computed_once(spark):
    """Incoming rows that differ between two reads still give a log and a table that agree."""
    base, table = fresh_dir(spark, "once"), _unique("once")
    run_cards_scd2_split(spark, cards(spark, [(i, "a") for i in range(50)]), table, base, f"{base}/closed", T1, "b1")
    drawn = cards(spark, [(i, "a") for i in range(50)]).withColumn("card_brand", F.when(F.expr("rand() < 0.5"), "a").otherwise("b"))
    run_cards_scd2_split(spark, drawn, table, base, f"{base}/closed", T2, "b2")
    new = spark.table(table).filter("batch_id = 'b2'").count()
    assert new == spark.read.parquet(f"{base}/closed").count() and spark.table(table).count() == 50


# ---- index days ---------------------------------------------------------------------------

def raw_rows(spark, data):
    """(id, day, hour) rows with the columns that an index reads, and one that it does not."""
    df = spark.createDataFrame(data, "id long, day int, hour int")
    return df.select("id", F.col("hour").cast("long").alias("client_id"), F.lit(1).cast("long").alias("card_id"), F.lit("t").alias("table_source"), F.expr("make_timestamp(2026, 4, day, hour, 0, 0)").alias("ingest_time"), F.lit(2026).alias("ingest_year"), F.lit(4).alias("ingest_month"), F.col("day").alias("ingest_day"), F.lit("w").alias("errors"))


def test_index_days_equal_a_rebuild(spark):
    base, table = fresh_dir(spark, "days"), _unique("days")
    day = {1: [(1, 1, 1), (2, 1, 1), (3, 1, 1), (None, 1, 1)], 2: [(2, 2, 5), (4, 2, 1), (4, 2, 3)], 3: [(9, 3, 1)]}

    def ingest(*days):
        for d in days:
            write_partitioned(raw_rows(spark, day[d]), f"{base}/raw", schemas.INGEST_PARTITIONS)

    ingest(1, 2, 3)
    build_index_table(spark, f"{base}/raw", table, base, f"{base}/occurrences", "v1")
    version = 1

    def update(*days):
        nonlocal version
        version += 1
        written = update_index_table(spark, f"{base}/raw", table, base, f"{base}/occurrences", [(2026, 4, d) for d in days], f"v{version}")
        rebuilt = IX.transaction_index(spark.read.parquet(f"{base}/raw")).select(*schemas.INDEX_COLUMNS)
        assert rows_of(spark.table(table)) == rows_of(rebuilt)
        return [d for _, _, d in written]

    day[4] = [(1, 4, 1), (5, 4, 1)]  # an id moves from day 1 to day 4
    ingest(4)
    before = files(f"{base}/version_v1")
    assert update(4) == [1, 4] and files(f"{base}/version_v1") == before
    assert published(spark, table, base)[1]["ingest_year=2026/ingest_month=4/ingest_day=3"] == "v1"
    day[2] = [(4, 2, 2), (None, 2, 9)]  # id 2 leaves the day, so day 1 has its survivor again
    ingest(2)
    assert update(2) == [1, 2]
    day[3] = [(9, 3, 1), (3, 3, 1)]
    day[4] = [(5, 4, 1)]
    ingest(3, 4)
    assert update(3, 4) == [1, 3, 4]
    spark.createDataFrame([], raw_rows(spark, day[1]).drop(*schemas.INGEST_PARTITIONS).schema).write.mode("overwrite").parquet(f"{base}/raw/ingest_year=2026/ingest_month=4/ingest_day=3")
    assert update(3) == [1, 3]  # the day is empty now
    assert update() == []


def test_an_update_looks_up_other_days_only_and_publishes_from_files(spark, monkeypatch):
    from ledgerlake.plans import index_job

    base, table = fresh_dir(spark, "looked_up"), _unique("looked_up")
    merged, plans = [], []
    survivors, publish = index_job.survivors, index_job._publish_index
    monkeypatch.setattr(index_job, "survivors", lambda df: (merged.append(plan_of(df, "simple")), survivors(df))[1])
    monkeypatch.setattr(index_job, "_publish_index", lambda df, *rest: (plans.append(plan_of(df, "simple")), publish(df, *rest))[1])
    write_partitioned(raw_rows(spark, [(1, 1, 1), (2, 1, 1), (None, 1, 1), (3, 2, 1)]), f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index_table(spark, f"{base}/raw", table, base, f"{base}/occurrences", "v1")
    write_partitioned(raw_rows(spark, [(1, 2, 1), (None, 2, 1), (4, 2, 1), (4, 2, 2)]), f"{base}/raw", schemas.INGEST_PARTITIONS)
    assert update_index_table(spark, f"{base}/raw", table, base, f"{base}/occurrences", [(2026, 4, 2)], "v2") == [(2026, 4, 1), (2026, 4, 2)]
    assert rows_of(spark.table(table)) == rows_of(IX.transaction_index(spark.read.parquet(f"{base}/raw")).select(*schemas.INDEX_COLUMNS))
    assert "Union" in merged[-1]  # the named day's occurrences take part in no join
    for plan in plans:  # drawing the ranges repeats no join and no aggregate
        assert "Join" not in plan and "Aggregate" not in plan


def test_an_update_reads_raw_rows_of_its_days_only(spark):
    from ledgerlake.plans.index_job import _on_days

    base = fresh_dir(spark, "pruned")
    write_partitioned(X.transactions_with_duplicates(spark, SF_SMALL), base, schemas.INGEST_PARTITIONS)
    plan = plan_of(IX.day_occurrences(spark.read.parquet(base).filter(_on_days([(2026, 4, 23)]))), "simple")
    [scan] = [line for line in plan.splitlines() if "FileScan" in line]
    assert "PartitionFilters: [" in scan and "ingest_day#" in scan.split("PartitionFilters")[1] and "PartitionFilters: []" not in scan
    assert "merchant_id" not in scan.split("ReadSchema")[1]
