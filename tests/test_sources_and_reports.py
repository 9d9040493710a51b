"""Quantile splits, drifting ingest days, quality counts and rejects, stream de-duplication, narrow diffs, clustered lookups."""

import datetime as dt
import json
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.operators import history as H
from ledgerlake.operators import refine
from ledgerlake.operators.lineage import stamp_lineage
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.writers import append_refined_transactions, append_with_rejects, bloom_options, clustered, write_observed, write_partitioned
from ledgerlake.sources import jdbc
from ledgerlake.sources import parquet as P
from ledgerlake.sources import tpch_fixtures as X
from ledgerlake.streaming.transactions_stream import start_transactions_append
from tests.conftest import SF_SMALL, plan_of


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- JDBC splits at quantiles ----------------------------------------------------

class StandIn:
    """A reader that answers JDBC reads from a DataFrame and remembers how it was asked."""

    def __init__(self, spark, table):
        self.session, self.table, self.calls, self.opts = spark, table, [], {}
        self.sparkContext = spark.sparkContext

    @property
    def read(self):
        self.opts = {}
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **opts):
        self.opts.update(opts)
        return self

    def load(self):
        self.calls.append(dict(self.opts))
        if "query" in self.opts:
            return self.table.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        return self.table.select("k") if self.opts["dbtable"].startswith("(SELECT k ") else self.table

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"predicates": predicates, "table": table, **properties})
        parts = [self.table.filter(p).withColumn("split", F.lit(i)) for i, p in enumerate(predicates)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def test_quantile_splits_are_even_for_a_skewed_key(spark):
    skewed = spark.range(20000).select((F.col("id") * F.col("id") * F.col("id") % 1_000_003 % (F.col("id") + 1)).alias("k"), "id")
    stand_in = StandIn(spark, skewed)
    got = jdbc.read_jdbc_quantiles(stand_in, "jdbc:x", "t", "k", 8, user="u")
    sizes = sorted(r["count"] for r in got.groupBy("split").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[0]
    assert got.count() == 20000 and got.select("id").distinct().count() == 20000
    assert [c for c in stand_in.calls if "predicates" in c][0]["user"] == "u"
    lo, hi = skewed.agg(F.min("k"), F.max("k")).first()
    even = sorted(r["count"] for r in skewed.groupBy(F.expr(f"least((k - {lo}) * 8 div ({hi} - {lo}), 7)")).count().collect())
    assert even[-1] > 2 * even[0]  # what equal ranges would give


def test_every_row_meets_one_split(spark):
    df = spark.createDataFrame([(None,), (5,), (5,), (5,), (5,), (9,), (-3,)], "k long")
    bounds = jdbc.quantile_bounds(df, "k", 4)
    hits = [F.expr(f"int({p})") for p in (f"coalesce({c}, false)" for c in jdbc.split_predicates("k", bounds))]
    assert {r[0] for r in df.select(sum(hits[1:], hits[0])).collect()} == {1}
    assert jdbc.split_predicates("k", []) == ["1 = 1"] and jdbc.quantile_bounds(df.limit(0), "k", 4) == []
    assert jdbc.read_jdbc_quantiles(StandIn(spark, df.withColumn("id", F.lit(1)).limit(0)), "jdbc:x", "t", "k", 4).count() == 0


# ---- drifting columns -------------------------------------------------------------

def test_wider_types():
    I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType
    for a, b, both in [(I, L, L), (I, D, D), (L, D, S), (S, I, S), (dec(10, 2), dec(8, 4), dec(12, 4)), (dec(38, 0), dec(38, 10), S), (T.FloatType(), D, D), (T.DateType(), T.TimestampType(), T.TimestampType()), (T.NullType(), I, I), (T.BooleanType(), I, S)]:
        assert P.wider_type(a, b) == both == P.wider_type(b, a)


def test_days_that_differ_are_read_as_one_table(spark):
    base = fresh_dir(spark, "drift")
    day = lambda d: [F.lit(2026).alias("ingest_year"), F.lit(4).alias("ingest_month"), F.lit(d).alias("ingest_day")]
    frames = [
        spark.createDataFrame([(1, "a")], "id int, v string").select("*", *day(1)),
        spark.createDataFrame([(2**40, "b")], "id long, w string").select("*", *day(2)),
        spark.createDataFrame([(3, 7)], "id int, v int").select("*", *day(3)),
        spark.createDataFrame([(4, "c")], "id int, v string").select("*", *day(4)),
    ]
    for f in frames:
        write_partitioned(f, base, schemas.INGEST_PARTITIONS)
    df = P.read_reconciled(spark, base)
    assert rows_of(df.select("id", "v", "w", "ingest_day")) == sorted([(1, "a", None, 1), (2**40, None, "b", 2), (3, "7", None, 3), (4, "c", None, 4)], key=str)
    assert dict(df.dtypes)["id"] == "bigint"
    plan = plan_of(df.filter("ingest_day = 2"), "simple")
    assert plan.count("FileScan") <= 3 and "PartitionFilters: [isnotnull(ingest_day" in plan


# ---- quality counts and rejects ------------------------------------------------------

def test_counts_of_the_writing_pass_and_rejects(spark):
    base = fresh_dir(spark, "report")
    raw = X.transactions(spark, SF_SMALL)
    refined = refine.transactions_refined(raw)
    for _ in range(2):  # a rerun replaces rejects and report
        counts = append_with_rejects(refined, f"{base}/out", f"{base}/rejects", f"{base}/report", "b1")
    expected = refined.agg(*[c.alias(n) for n, c in refine.flag_counts(refined).items()]).first().asDict()
    assert counts == expected and counts["undated"] > 0
    rejects = spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{base}/rejects")
    assert rows_of(rejects.select(*refined.columns)) == rows_of(refine.transactions_undated(refined))
    assert spark.read.parquet(f"{base}/out").count() == 2 * (counts["rows"] - counts["undated"])
    assert {r["metric"]: r["value"] for r in spark.read.parquet(f"{base}/report").collect()} == counts
    clean = refine.transactions_dated(refined)
    assert append_with_rejects(clean, f"{base}/out", f"{base}/rejects", f"{base}/report", "b1")["undated"] == 0
    assert spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{base}/rejects").count() == 0
    assert append_with_rejects(clean.limit(0), f"{base}/out", f"{base}/rejects", f"{base}/report", "b2")["rows"] == 0


def test_counting_adds_no_scan(spark):
    from pyspark.sql import Observation

    df = refine.users_refined(X.users(spark, SF_SMALL), current_year=2026)
    observed = df.hint("rebalance", "load_day").observe(Observation(), *[c.alias(n) for n, c in refine.flag_counts(df).items()])
    plan = plan_of(observed, "simple")
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange")  # counted in the stage that writes
    path = fresh_dir(spark, "observed")
    assert write_observed(df, path, ["load_day"])["rows"] == spark.read.parquet(path).count()


# ---- stream de-duplication -------------------------------------------------------------

def test_a_reingested_day_gives_each_row_once_and_state_is_bounded(spark):
    base = fresh_dir(spark, "stream_dedupe")
    raw = X.transactions(spark, SF_SMALL)
    late = lambda df, span: df.withColumn("ingest_time", F.expr(f"ingest_time + interval {span}"))
    dated = refine.transactions_dated(refine.transactions_refined(raw)).count()

    def run(rows):
        write_partitioned(rows, f"{base}/raw", schemas.INGEST_PARTITIONS, mode="append")
        q = start_transactions_append(spark, f"{base}/raw", f"{base}/out", f"{base}/checkpoint", raw.schema, dedupe_within="10 days")
        q.awaitTermination()
        [state] = q.lastProgress["stateOperators"] if q.lastProgress else [{"numRowsTotal": -1}]
        return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{base}/out"), state["numRowsTotal"]

    out, _ = run(raw)
    assert out.count() == dated
    out, held = run(late(raw.filter("ingest_day = 23"), "5 days"))
    assert out.count() == dated and held == dated
    assert out.groupBy("transaction_id").count().filter("count > 1").count() == 0
    # beyond the span the rows are refined again, and the state of the first days is gone
    some = late(raw.filter("ingest_day = 21"), "60 days")
    out, _ = run(some)
    again = refine.transactions_dated(refine.transactions_refined(some)).count()
    _, held = run(late(raw.limit(1), "61 days"))
    assert held <= again + 1


# ---- users diff from keys and digests -----------------------------------------------------

def test_narrow_delta_equals_the_wide_one(spark):
    u1, u2 = (H.normalize_users(x) for x in (X.users_snapshot_1(spark, SF_SMALL), X.users_snapshot_2(spark, SF_SMALL)))
    twice = u1.unionByName(u1.filter("user_id % 5 = 0")).unionByName(u1.limit(3).withColumn("user_id", F.lit(None).cast("long")))
    for current in (u1, twice):
        wide = H.history_delta(current, u2, "2026-04-24 00:00:00", "b2")
        narrow = H.before_images(current, H.changed_rows(current, u2), "2026-04-24 00:00:00", "b2")
        assert narrow.columns == wide.columns and rows_of(narrow) == rows_of(wide)
    assert H.changed_rows(u1, u1).count() == 0
    plan = plan_of(H.changed_rows(u1, u2), "simple")
    assert all("address" not in line for line in plan.splitlines() if "Exchange" in line)
    with pytest.raises(Exception, match="duplicate keys"):
        H.changed_rows(u1, u2.unionByName(u2)).filter("change_type = 'DELETE'").collect()


# ---- clustered lookups -------------------------------------------------------------------------

_READ = """
import sys
from pyspark.sql import SparkSession
path, log, key = sys.argv[1:]
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log).config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate()
df = spark.read.parquet(path)
spark.sparkContext.setJobGroup("lookup", "lookup")
rows = df.filter(df["id"] == int(key)).collect()
assert len(rows) == 1, rows
spark.stop()
"""


def records_read(path, key):
    """Rows that the tasks of a lookup read, from Spark's event log."""
    log = tempfile.mkdtemp(prefix="events-")
    subprocess.run([sys.executable, "-c", _READ, path, log, str(key)], check=True, capture_output=True, timeout=300)
    [name] = os.listdir(log)
    events = [json.loads(line) for line in open(os.path.join(log, name))]
    jobs = [e for e in events if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "lookup"]
    stages = {s for e in jobs for s in e["Stage IDs"]}
    return sum(e["Task Metrics"]["Input Metrics"]["Records Read"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages)


def test_a_point_lookup_skips_row_groups(spark):
    base = fresh_dir(spark, "clustered")
    # ids in no order, as they arrive; one file, many row groups
    df = spark.range(200_000).select((F.xxhash64("id") % 10_000_000).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    small = {"parquet.block.size": str(256 * 1024), "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100", "parquet.enable.dictionary": "false"}
    df.coalesce(1).write.options(**small).parquet(f"{base}/plain")
    clustered(df, "id").coalesce(1).write.options(**small, **bloom_options("id", distinct=5000)).parquet(f"{base}/by_id")
    df.coalesce(1).write.options(**small, **bloom_options("id", distinct=5000)).parquet(f"{base}/bloom")
    key = df.groupBy("id").count().filter("count = 1").orderBy(F.abs("id")).first()["id"]  # in the middle of the range
    plain, by_id, bloom = (records_read(f"{base}/{n}", key) for n in ("plain", "by_id", "bloom"))
    assert plain > 100_000 and by_id < plain / 10 and bloom < plain / 4, (plain, by_id, bloom)


def test_a_hot_id_lies_in_several_files(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    path = fresh_dir(spark, "hot_id")
    clustered(df, "id").write.parquet(path)
    files = spark.read.parquet(path).filter("id = 7").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) == 1 or max(r["count"] for r in files) < 13_334  # one file only if the table is one file
    assert rows_of(spark.read.parquet(path)) == rows_of(df)


# ---- clock -----------------------------------------------------------------------------------

def test_the_default_clock_is_the_time_of_the_query(spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    df = stamp_lineage(spark.range(1000).repartition(4), "t")
    [r] = df.select("ingest_time", *schemas.INGEST_PARTITIONS).distinct().collect()
    with_zone = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("now")).first()["now"]
    now = dt.datetime.strptime(with_zone, "%Y-%m-%d %H:%M:%S")
    stamped = dt.datetime(r["ingest_year"], r["ingest_month"], r["ingest_day"])
    assert before - dt.timedelta(days=1) <= stamped <= now


def test_an_append_to_the_same_rows_with_identity(spark):
    """The streaming identity and the batch identity tell the same rows apart."""
    from ledgerlake.sinks.writers import _row_key, row_identity

    refined = refine.transactions_dated(refine.transactions_refined(X.transactions_with_odd_ids(spark, SF_SMALL)))
    keys = refined.select(F.struct(*schemas.TRANSACTIONS_REFINED_PARTITIONS, _row_key()).alias("a"), row_identity().alias("b")).distinct()
    assert keys.count() == keys.select("a").distinct().count() == keys.select("b").distinct().count()
    path = fresh_dir(spark, "identity")
    append_refined_transactions(refined, path, dedupe=True)
    assert spark.read.parquet(path).count() == keys.count()
