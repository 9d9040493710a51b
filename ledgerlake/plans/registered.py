"""Registered queries: one per operator of the inventory, as (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables through :mod:`ledgerlake.sources.tpch_fixtures`
and runs one operator (or job) over all of their rows. Clock values and batch
ids are fixed arguments so the results repeat and can be compared with the
SQL in :mod:`ledgerlake.oracle.queries_sql`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import derived as D
from ledgerlake.functions import quality as Q
from ledgerlake.operators import history as H
from ledgerlake.operators import index as IX
from ledgerlake.operators import refine
from ledgerlake.operators import scd2 as S
from ledgerlake.operators.dedupe import superseded_rows
from ledgerlake.operators.lineage import stamp_lineage
from ledgerlake.operators.patch import keyed_patch
from ledgerlake.plans.history_job import run_users_history
from ledgerlake.plans.index_job import build_index, build_index_table, cluster_transactions, lookup, update_index, update_index_table
from ledgerlake.plans.ingest import IngestSpec, run_raw_ingest, source_specs
from ledgerlake.plans.scd2_job import dimension, run_cards_scd2, run_cards_scd2_buckets, run_cards_scd2_split
from ledgerlake.plans.corrections_job import apply_corrections
from ledgerlake.plans.warehouse import RefineTargets, run_warehouse
from ledgerlake.session import batch_id_for, fresh_dir
from ledgerlake.sinks import catalog
from ledgerlake.sinks.writers import append_batch, append_refined_transactions, append_with_rejects, write_observed, write_partitioned
from ledgerlake.sources import parquet as P
from ledgerlake.sources import tpch_fixtures as X
from ledgerlake.streaming.transactions_stream import start_transactions_append

# Fixed arguments of the registered queries.
CLOCK_1 = "2026-04-23 04:22:19"   # first SCD2 load, first history run
CLOCK_2 = "2026-04-24 04:22:19"   # second batch
CLOCK_3 = "2026-04-25 04:22:19"   # third run (history written back the other way)
BATCH_1 = batch_id_for(CLOCK_1)
BATCH_2 = batch_id_for(CLOCK_2)
BATCH_3 = batch_id_for(CLOCK_3)
CURRENT_YEAR = 2026
POINT_IDS = [11, 13, 21, 6001, 4003, -1]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _read_back(spark, path, like: DataFrame) -> DataFrame:
    """Read a written table with the schema it was written with (no type inference)."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --- quality rules and column groups --------------------------------------

@register
def q_quality_integer(spark, sf):
    u = X.users(spark, sf)
    cols = [F.col("id").alias("user_id")]
    for c in refine_ints():
        cols += Q.integer_group(c, c, "int")
    return u.select(*cols)


def refine_ints():
    return ["current_age", "retirement_age", "birth_year", "birth_month", "credit_score", "num_credit_cards"]


@register
def q_quality_decimal(spark, sf):
    u = X.users(spark, sf)
    return u.select(
        F.col("id").alias("user_id"),
        *Q.decimal_group("latitude", "latitude"),
        *Q.decimal_group("longitude", "longitude"),
    )


@register
def q_quality_currency(spark, sf):
    u = X.users(spark, sf)
    cols = [F.col("id").alias("user_id")]
    for c in ["per_capita_income", "yearly_income", "total_debt"]:
        cols += Q.currency_group(c, f"{c}_raw", f"{c}_amount", f"{c}_currency")
    return u.select(*cols)


@register
def q_quality_currency_inplace(spark, sf):
    t = refine.transactions_refined(X.transactions(spark, sf))
    return t.select("transaction_id", "amount_raw", "amount", "amount_null_flag", "amount_unknown_flag", "amount_currency")


# --- derived columns -------------------------------------------------------

@register
def q_outlier_flags(spark, sf):
    r = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    return r.select("user_id", "birth_year_outlier_flag", "current_age_outlier_flag", "retirement_age_outlier_flag")


@register
def q_outlier_flags_cards(spark, sf):
    c = X.cards(spark, sf).select(
        F.col("id").alias("card_id"), *Q.integer_group("year_pin_last_changed", "year_pin_last_changed", "int")
    )
    return c.select(
        "card_id",
        "year_pin_last_changed",
        D.above("year_pin_last_changed", CURRENT_YEAR).alias("year_pin_last_changed_outlier_flag"),
    )


@register
def q_age_group(spark, sf):
    r = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    return r.select("user_id", "current_age", "age_group")


@register
def q_income_group(spark, sf):
    r = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    return r.select("user_id", "yearly_income_amount", "income_group")


@register
def q_load_day(spark, sf):
    r = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    return r.select("user_id", "load_day")


@register
def q_month_year_date(spark, sf):
    c = X.cards(spark, sf)
    return c.select(F.col("id").alias("card_id"), *D.month_year_group("acct_open_date", "acct_open_date"))


@register
def q_date_parts(spark, sf):
    t = X.transactions(spark, sf)
    return t.select(
        F.col("id").alias("transaction_id"),
        *D.timestamp_parts("date", "txn_timestamp", "txn_year", "txn_month", "txn_day"),
    )


# --- refined tables ----------------------------------------------------------

@register
def q_users_refined(spark, sf):
    return refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)


@register
def q_users_refined_signed(spark, sf):
    """users_refined with the signed-money option (negative income and debt are read)."""
    return refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR, signed_money=True)


@register
def q_transactions_refined(spark, sf):
    return refine.transactions_refined(P.latest_batch(X.transactions(spark, sf)))


@register
def q_transactions_refined_all(spark, sf):
    """transactions_refined over every batch, default options."""
    return refine.transactions_refined(X.transactions(spark, sf))


@register
def q_transactions_refined_options(spark, sf):
    """transactions_refined with both options: code from the raw text, signed money."""
    return refine.transactions_refined(X.transactions(spark, sf), currency_from_raw=True, signed_money=True)


@register
def q_transactions_dated(spark, sf):
    return refine.transactions_dated(refine.transactions_refined(X.transactions(spark, sf)))


@register
def q_month_keys(spark, sf):
    return refine.month_keys(refine.transactions_refined(X.transactions(spark, sf)))


# --- batches -----------------------------------------------------------------

@register
def q_latest_batch(spark, sf):
    return P.latest_batch(X.transactions(spark, sf))


@register
def q_latest_batch_catalog(spark, sf):
    """Latest batch of a registered, partitioned raw table, keyed from SHOW PARTITIONS."""
    base = fresh_dir(spark, "raw_catalog")
    raw = X.transactions(spark, sf)
    write_partitioned(raw, f"{base}/transactions", schemas.INGEST_PARTITIONS)
    database = _unique("ledgerlake_raw")
    catalog.ensure_database(spark, database, f"{base}/db")
    table = f"`{database}`.`transactions`"
    catalog.register_table(spark, table, raw.schema, schemas.INGEST_PARTITIONS, f"{base}/transactions")
    return P.latest_batch_of_table(spark, table).select(*raw.columns)


@register
def q_batch_days(spark, sf):
    return P.batch_days(X.transactions(spark, sf))


# --- lineage, index and lookup -------------------------------------------------


@register
def q_raw_lineage(spark, sf):
    return stamp_lineage(X.load(spark, sf, "customer"), "users_data.csv", CLOCK_1)


@register
def q_txn_index(spark, sf):
    return IX.transaction_index(X.transactions_with_duplicates(spark, sf))


def _lookup_requests(spark, sf):
    """Every id of the line-item transactions, looked up in the order index."""
    return X.transactions_with_duplicates(spark, sf).select(F.col("id").alias("transaction_id"))


@register
def q_txn_lookup(spark, sf):
    txn = X.transactions(spark, sf)
    return IX.lookup_transactions(IX.transaction_index(txn), txn, _lookup_requests(spark, sf))


@register
def q_txn_lookup_pruned(spark, sf):
    """The same lookup over partitioned tables, joined on the ingest columns too.

    With a selective request set (point lookups) Spark adds a dynamic
    partition filter to the record scan; this request set spans every day,
    so Spark plans none. The rows are the same either way.
    """
    base = fresh_dir(spark, "lookup")
    write_partitioned(X.transactions(spark, sf), f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index(spark, f"{base}/raw", f"{base}/index")
    index, txn = spark.read.parquet(f"{base}/index"), spark.read.parquet(f"{base}/raw")
    return IX.lookup_transactions(index, txn, _lookup_requests(spark, sf), prune=True)


@register
def q_txn_point_lookup(spark, sf):
    """Literal ids (as on the command line), some without a record, through a built index."""
    base = fresh_dir(spark, "point_lookup")
    write_partitioned(X.transactions_with_duplicates(spark, sf), f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index(spark, f"{base}/raw", f"{base}/index")
    return lookup(spark, f"{base}/index", f"{base}/raw", POINT_IDS)[0]


@register
def q_txn_point_lookup_clustered(spark, sf):
    """The same ids through an index and records that are clustered by id, with bloom filters."""
    base = fresh_dir(spark, "point_lookup_clustered")
    write_partitioned(X.transactions_with_duplicates(spark, sf), f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index(spark, f"{base}/raw", f"{base}/index", cluster=True)
    cluster_transactions(spark, f"{base}/raw", f"{base}/by_id")
    return lookup(spark, f"{base}/index", f"{base}/by_id", POINT_IDS)[0]


@register
def q_txn_lookup_missing(spark, sf):
    txn = X.transactions(spark, sf)
    return IX.missing_ids(IX.transaction_index(txn), _lookup_requests(spark, sf))


# --- users change history ----------------------------------------------------------

def _users_pair(spark, sf):
    return H.normalize_users(X.users_snapshot_1(spark, sf)), H.normalize_users(X.users_snapshot_2(spark, sf))


@register
def q_users_normalize(spark, sf):
    return H.normalize_users(X.users(spark, sf))


@register
def q_row_changed(spark, sf):
    return H.row_changed(*_users_pair(spark, sf))


@register
def q_users_history_delta(spark, sf):
    return H.history_delta(*_users_pair(spark, sf), detected_at=CLOCK_2, batch_id=BATCH_2)


@register
def q_users_history_repeated_keys(spark, sf):
    """The history delta when the incoming snapshot repeats keys (D5): the latest row of a key counts."""
    incoming = H.normalize_users(X.users_snapshot_2_with_copies(spark, sf), keep=["ingest_time"])
    current = H.normalize_users(X.users_snapshot_1(spark, sf))
    return H.history_delta(current, incoming, detected_at=CLOCK_2, batch_id=BATCH_2, order=["ingest_time"])


@register
def q_users_superseded(spark, sf):
    """The rows of the same snapshot that the latest row of their key replaces."""
    incoming = H.normalize_users(X.users_snapshot_2_with_copies(spark, sf), keep=["ingest_time"])
    return superseded_rows(incoming, H.KEY, ["ingest_time"])


@register
def q_change_count(spark, sf):
    return H.change_count(H.history_delta(*_users_pair(spark, sf), detected_at=CLOCK_2, batch_id=BATCH_2))


# --- cards SCD2 -------------------------------------------------------------------

def _scd2_start(spark, sf):
    initial = S.initial_versions(S.normalize_cards(X.cards_snapshot_1(spark, sf)), CLOCK_1, BATCH_1)
    return initial, S.normalize_cards(X.cards_snapshot_2(spark, sf))


def _scd2_merged(spark, sf):
    existing, incoming = _scd2_start(spark, sf)
    return S.merge(existing, incoming, CLOCK_2, BATCH_2)


@register
def q_cards_normalize(spark, sf):
    return S.normalize_cards(X.cards(spark, sf))


@register
def q_scd2_initial(spark, sf):
    return S.initial_versions(S.normalize_cards(X.cards(spark, sf)), CLOCK_1, BATCH_1)


@register
def q_scd2_diff(spark, sf):
    return S.diff(*_scd2_start(spark, sf)).select("card_id", "action")


@register
def q_scd2_insert_rows(spark, sf):
    return S.insert_rows(*_scd2_start(spark, sf), effective_at=CLOCK_2, batch_id=BATCH_2)


@register
def q_scd2_updated_keys(spark, sf):
    return S.updated_keys(*_scd2_start(spark, sf))


@register
def q_scd2_closed(spark, sf):
    return S.closed_versions(*_scd2_start(spark, sf), effective_at=CLOCK_2)


@register
def q_scd2_kept(spark, sf):
    return S.kept_versions(*_scd2_start(spark, sf))


@register
def q_scd2_merge(spark, sf):
    return _scd2_merged(spark, sf)


@register
def q_scd2_merge_repeated_keys(spark, sf):
    """The merge when the incoming snapshot repeats keys (D5): the latest row of a key counts."""
    existing = _scd2_start(spark, sf)[0]
    incoming = S.normalize_cards(X.cards_snapshot_2_with_copies(spark, sf), keep=["ingest_time"])
    return S.merge(existing, incoming, CLOCK_2, BATCH_2, order=["ingest_time"])


@register
def q_scd2_merge_close_missing(spark, sf):
    """The merge with the D8 option: cards absent from the snapshot are closed."""
    existing, incoming = _scd2_start(spark, sf)
    return S.merge(existing, incoming, CLOCK_2, BATCH_2, close_missing=True)


@register
def q_scd2_current(spark, sf):
    return S.current_versions(_scd2_merged(spark, sf))


@register
def q_cards_refined(spark, sf):
    return refine.cards_refined(_scd2_merged(spark, sf), current_year=CURRENT_YEAR)


@register
def q_keyed_patch(spark, sf):
    return keyed_patch(X.cards(spark, sf), X.card_corrections(spark, sf), key="id")


# --- sinks: write, read back (each run writes below a fresh shared directory) --------


@register
def q_raw_ingest_roundtrip(spark, sf):
    base = fresh_dir(spark, "raw")
    spec = IngestSpec("transactions", "orders", f"{base}/transactions", "transactions_data.csv")
    # stands in for the JDBC read, which yields TIMESTAMP (not TIMESTAMP_NTZ)
    orders = X.load(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    run_raw_ingest([spec], lambda s: orders, clock=CLOCK_1)
    return _read_back(spark, spec.output_path, stamp_lineage(orders, spec.table_source, CLOCK_1))


@register
def q_txn_index_roundtrip(spark, sf):
    base = fresh_dir(spark, "index")
    raw = X.transactions_with_duplicates(spark, sf)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index(spark, f"{base}/raw", f"{base}/index")
    return _read_back(spark, f"{base}/index", IX.transaction_index(raw))


@register
def q_txn_index_incremental(spark, sf):
    """Index built from the first two ingest days, then updated with the third."""
    base = fresh_dir(spark, "index_incremental")
    raw = X.transactions_with_duplicates(spark, sf)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    first_days = raw.filter(F.col("ingest_day") < 23)
    write_partitioned(IX.transaction_index(first_days), f"{base}/index", schemas.INGEST_PARTITIONS)
    path = update_index(spark, f"{base}/raw", f"{base}/index", f"{base}/index_2", [(2026, 4, 23)])
    return _read_back(spark, path, IX.transaction_index(raw))


@register
def q_txn_index_emptied_day(spark, sf):
    """A later day brings all ids of day 21 again, so no index row is left on day 21."""
    base = fresh_dir(spark, "index_emptied")
    raw = X.transactions_with_duplicates(spark, sf)
    write_partitioned(IX.transaction_index(raw.filter(F.col("ingest_day") == 21)), f"{base}/index", schemas.INGEST_PARTITIONS)
    write_partitioned(X.brought_again(raw, 21, 24), f"{base}/raw", schemas.INGEST_PARTITIONS)
    path = update_index(spark, f"{base}/raw", f"{base}/index", f"{base}/index_2", [(2026, 4, 22), (2026, 4, 23), (2026, 4, 24)])
    return _read_back(spark, path, IX.transaction_index(raw))


@register
def q_txn_index_reingested_day(spark, sf):
    """Day 23 is ingested again without the ids divisible by 3: their older rows, if any, are indexed."""
    base = fresh_dir(spark, "index_reingested")
    raw = X.transactions_with_duplicates(spark, sf)
    write_partitioned(IX.transaction_index(raw), f"{base}/index", schemas.INGEST_PARTITIONS)
    left = raw.filter((F.col("ingest_day") != 23) | (F.col("id") % 3 != 0))
    write_partitioned(left, f"{base}/raw", schemas.INGEST_PARTITIONS)
    path = update_index(spark, f"{base}/raw", f"{base}/index", f"{base}/index_2", [(2026, 4, 23)])
    return _read_back(spark, path, IX.transaction_index(raw))


def _updated_index_table(spark, before: DataFrame, after: DataFrame, days: list[int]) -> DataFrame:
    """The index table built over ``before`` and brought up to date for ``days`` of April 2026 of ``after``."""
    base, table = fresh_dir(spark, "index_table"), _unique("ledgerlake_index")
    write_partitioned(before, f"{base}/raw", schemas.INGEST_PARTITIONS)
    build_index_table(spark, f"{base}/raw", table, base, f"{base}/occurrences", BATCH_1)
    write_partitioned(after, f"{base}/raw_2", schemas.INGEST_PARTITIONS)
    update_index_table(spark, f"{base}/raw_2", table, base, f"{base}/occurrences", [(2026, 4, d) for d in days], BATCH_2)
    return spark.table(table)


@register
def q_txn_index_occurrences(spark, sf):
    """Index and occurrences of the first two ingest days, brought up to date with the third."""
    raw = X.transactions_with_duplicates(spark, sf)
    return _updated_index_table(spark, raw.filter(F.col("ingest_day") < 23), raw, [23])


@register
def q_txn_index_occurrences_emptied(spark, sf):
    """As txn_index_emptied_day, from the occurrences: no index row is left on day 21."""
    raw = X.transactions_with_duplicates(spark, sf)
    return _updated_index_table(spark, raw.filter(F.col("ingest_day") == 21), X.brought_again(raw, 21, 24), [22, 23, 24])


@register
def q_txn_index_occurrences_reingested(spark, sf):
    """As txn_index_reingested_day, from the occurrences: ids that left day 23 get their older rows back."""
    raw = X.transactions_with_duplicates(spark, sf)
    left = raw.filter((F.col("ingest_day") != 23) | (F.col("id") % 3 != 0))
    return _updated_index_table(spark, raw, left, [23])


@register
def q_users_refined_roundtrip(spark, sf):
    path = fresh_dir(spark, "users_refined")
    df = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    write_partitioned(df, path, schemas.USERS_REFINED_PARTITIONS)
    return _read_back(spark, path, df)


@register
def q_cards_refined_roundtrip(spark, sf):
    path = fresh_dir(spark, "cards_refined")
    df = refine.cards_refined(_scd2_merged(spark, sf), current_year=CURRENT_YEAR)
    write_partitioned(df, path, schemas.CARDS_REFINED_PARTITIONS)
    return _read_back(spark, path, df)


@register
def q_transactions_append_roundtrip(spark, sf):
    """Append the latest batch, then every batch with de-duplication on the id."""
    path = fresh_dir(spark, "transactions_refined")
    raw = X.transactions(spark, sf)
    append_refined_transactions(refine.transactions_refined(P.latest_batch(raw)), path)
    append_refined_transactions(refine.transactions_refined(raw), path, dedupe=True)
    return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path)


@register
def q_transactions_append_rerun(spark, sf):
    """Three idempotent appends of one batch that holds repeats, unparsable ids and missing ids."""
    path = fresh_dir(spark, "transactions_rerun")
    refined = refine.transactions_refined(X.transactions_with_odd_ids(spark, sf))
    for _ in range(3):
        append_refined_transactions(refined, path, dedupe=True)
    return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(path)


def _with_rejects(spark, sf, name: str) -> str:
    base = fresh_dir(spark, name)
    refined = refine.transactions_refined(X.transactions(spark, sf))
    append_with_rejects(refined, f"{base}/refined", f"{base}/rejects", f"{base}/report", BATCH_1)
    return base


@register
def q_transactions_rejects(spark, sf):
    """The undated transactions that an append keeps apart."""
    columns = [f.name for f in schemas.TRANSACTIONS_REFINED.fields]
    return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{_with_rejects(spark, sf, 'rejects')}/rejects").select(*columns)


@register
def q_transactions_quality_report(spark, sf):
    """Null, unknown and undated counts that the writing pass of an append took."""
    return spark.read.schema("metric string, value long, batch_id string").parquet(f"{_with_rejects(spark, sf, 'report')}/report")


@register
def q_users_quality_report(spark, sf):
    """Null, unknown and outlier counts that the writing pass of users_refined took."""
    path = fresh_dir(spark, "users_observed")
    df = refine.users_refined(X.users(spark, sf), current_year=CURRENT_YEAR)
    counts = write_observed(df, path, schemas.USERS_REFINED_PARTITIONS)
    return spark.createDataFrame(sorted(counts.items()), "metric string, value long")


@register
def q_cards_refined_rewrite(spark, sf):
    """cards_refined written twice by the job's write; the second dimension starts in another month."""
    path = fresh_dir(spark, "cards_refined_rewrite")
    cards = S.normalize_cards(X.cards(spark, sf))
    for clock in ("2026-02-01 00:00:00", CLOCK_1):
        versions = S.initial_versions(cards, clock, BATCH_1)
        df = refine.cards_refined(versions, current_year=CURRENT_YEAR)
        write_partitioned(df, path, schemas.CARDS_REFINED_PARTITIONS, dynamic=False, rebalance=True)
    return _read_back(spark, path, df)


@register
def q_users_history_numeric(spark, sf):
    """Source columns that are numbers: the log reads back with its declared schema."""
    path = fresh_dir(spark, "users_history_numeric")
    numbers = {c: F.col(c).cast("int") for c in ("birth_year", "credit_score")}
    u1, u2 = (H.normalize_users(x.withColumns(numbers)) for x in (X.users_snapshot_1(spark, sf), X.users_snapshot_2(spark, sf)))
    append_batch(H.history_delta(u1, u2, detected_at=CLOCK_2, batch_id=BATCH_2), path, BATCH_2)
    return spark.read.schema(schemas.users_history_schema()).parquet(path)


@register
def q_corrections_roundtrip(spark, sf):
    """The corrections job: read, patch, write un-partitioned (twice: the second replaces)."""
    base = fresh_dir(spark, "corrections")
    X.cards(spark, sf).write.parquet(f"{base}/cards")
    for _ in range(2):
        apply_corrections(spark, f"{base}/cards", X.card_corrections(spark, sf), f"{base}/corrected")
    return spark.read.parquet(f"{base}/corrected")


def _ingested(spark, sf, database=None):
    """The ingest job over three tables, read by a stand-in for JDBC; returns the paths."""
    base = fresh_dir(spark, "ingest")
    tables = {"users": X.load(spark, sf, "customer"), "cards": X.load(spark, sf, "part"), "transactions": X.load(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))}
    for clock in (CLOCK_1, CLOCK_2):
        paths = run_raw_ingest(source_specs(base), lambda s: tables[s.name], clock=clock, database=database)
    return paths


@register
def q_ingest_tables(spark, sf):
    """Three source tables ingested on two days; rows per table and day."""
    paths = _ingested(spark, sf)
    parts = [
        spark.read.parquet(path).groupBy("table_source", *schemas.INGEST_PARTITIONS).agg(F.count(F.lit(1)).alias("row_count"))
        for path in paths.values()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _ingested_table(name: str) -> Query:
    """A query that gives all columns of one ingested table, both days."""
    def query(spark, sf):
        return spark.read.parquet(_ingested(spark, sf)[name])

    query.__name__ = f"q_ingest_{name}"
    return query


for _name in ("users", "cards", "transactions"):
    register(_ingested_table(_name))


def _drifting_days(spark, sf, base: str) -> DataFrame:
    """Raw transactions by ingest day, as a source whose columns change would leave them.

    Day 22 lacks ``errors`` and has ``amount`` as a number and ``client_id`` as
    an INT; day 23 has a new column ``channel`` and ``mcc`` as an INT.
    """
    raw = X.transactions(spark, sf)
    number = F.regexp_replace("amount", "[$]", "").cast("double")
    days = {
        21: raw,
        22: raw.drop("errors").withColumns({"amount": number, "client_id": F.col("client_id").cast("int")}),
        23: raw.withColumns({"mcc": F.col("mcc").cast("int"), "channel": F.col("use_chip")}),
    }
    for day, rows in days.items():
        write_partitioned(rows.filter(F.col("ingest_day") == day), base, schemas.INGEST_PARTITIONS)
    return P.read_reconciled(spark, base)


@register
def q_raw_reconciled_days(spark, sf):
    """Ingest days whose columns differ, read as one table."""
    return _drifting_days(spark, sf, fresh_dir(spark, "drift"))


@register
def q_transactions_refined_drifting(spark, sf):
    """The refined transactions of those days."""
    return refine.transactions_refined(_drifting_days(spark, sf, fresh_dir(spark, "drift_refined")))


@register
def q_ingest_latest_batch_catalog(spark, sf):
    """The ingest job registers its tables; the latest batch comes from SHOW PARTITIONS."""
    database = _unique("ledgerlake_ingest")
    _ingested(spark, sf, database)
    return P.latest_batch_of_table(spark, f"`{database}`.`users`")


@register
def q_users_history_append(spark, sf):
    """Two runs into one log: snapshot 1 -> 2, then back 2 -> 1."""
    base = fresh_dir(spark, "users_history")
    u1, u2 = X.users_snapshot_1(spark, sf), X.users_snapshot_2(spark, sf)
    run_users_history(u1, u2, f"{base}/history", f"{base}/current", CLOCK_2, BATCH_2)
    run_users_history(u2, u1, f"{base}/history", f"{base}/current", CLOCK_3, BATCH_3)
    return spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/history")


@register
def q_users_history_narrow(spark, sf):
    """As users_history_append, with keys and digests compared first."""
    base = fresh_dir(spark, "users_history_narrow")
    u1, u2 = X.users_snapshot_1(spark, sf), X.users_snapshot_2(spark, sf)
    run_users_history(u1, u2, f"{base}/history", f"{base}/current", CLOCK_2, BATCH_2, narrow=True)
    run_users_history(u2, u1, f"{base}/history", f"{base}/current", CLOCK_3, BATCH_3, narrow=True)
    return spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/history")


@register
def q_users_history_unchanged_rerun(spark, sf):
    """A batch is run, then run again after the snapshot was taken back: its part of the log is empty."""
    base = fresh_dir(spark, "users_history_rerun")
    u1, u2 = X.users_snapshot_1(spark, sf), X.users_snapshot_2(spark, sf)
    run_users_history(u1, u2, f"{base}/history", f"{base}/current", CLOCK_2, BATCH_2)
    run_users_history(u2, u1, f"{base}/history", f"{base}/current", CLOCK_3, BATCH_3)
    run_users_history(u2, u2, f"{base}/history", f"{base}/current", CLOCK_3, BATCH_3)
    return spark.read.schema(schemas.users_history_schema()).parquet(f"{base}/history")


@register
def q_users_current_refresh(spark, sf):
    """Snapshot refresh through a catalog table moved between versions."""
    base = fresh_dir(spark, "users_current")
    table = _unique("ledgerlake_users_current")
    u1, u2 = X.users_snapshot_1(spark, sf), X.users_snapshot_2(spark, sf)
    run_users_history(u1, u1, f"{base}/history", f"{base}/current", CLOCK_1, BATCH_1, current_table=table)
    run_users_history(spark.table(table), u2, f"{base}/history", f"{base}/current", CLOCK_2, BATCH_2, current_table=table)
    return spark.table(table)


@register
def q_scd2_roundtrip(spark, sf):
    """Initial load and one merge, each published as a version of a catalog table."""
    base = fresh_dir(spark, "cards_scd2")
    table = _unique("ledgerlake_cards_scd2")
    run_cards_scd2(spark, X.cards_snapshot_1(spark, sf), table, base, CLOCK_1, BATCH_1)
    run_cards_scd2(spark, X.cards_snapshot_2(spark, sf), table, base, CLOCK_2, BATCH_2)
    return spark.table(table)


@register
def q_scd2_bucketed_roundtrip(spark, sf):
    """As scd2_roundtrip, with versions bucketed by card_id (one-sided merge shuffle)."""
    base = fresh_dir(spark, "cards_scd2_bucketed")
    table = _unique("ledgerlake_cards_scd2_bucketed")
    run_cards_scd2(spark, X.cards_snapshot_1(spark, sf), table, base, CLOCK_1, BATCH_1, bucket_count=8)
    run_cards_scd2(spark, X.cards_snapshot_2(spark, sf), table, base, CLOCK_2, BATCH_2, bucket_count=8)
    return spark.table(table)


@register
def q_scd2_split_roundtrip(spark, sf):
    """As scd2_roundtrip, with closed versions appended to a log that no merge rewrites."""
    base = fresh_dir(spark, "cards_scd2_split")
    table = _unique("ledgerlake_cards_scd2_split")
    for cards, clock, batch in ((X.cards_snapshot_1(spark, sf), CLOCK_1, BATCH_1), (X.cards_snapshot_2(spark, sf), CLOCK_2, BATCH_2)):
        run_cards_scd2_split(spark, cards, table, base, f"{base}/closed", clock, batch)
    return dimension(spark, table, f"{base}/closed")


@register
def q_scd2_buckets_roundtrip(spark, sf):
    """As scd2_split_roundtrip, by copy-on-write of hash buckets."""
    base = fresh_dir(spark, "cards_scd2_buckets")
    table = _unique("ledgerlake_cards_scd2_buckets")
    for cards, clock, batch in ((X.cards_snapshot_1(spark, sf), CLOCK_1, BATCH_1), (X.cards_snapshot_2(spark, sf), CLOCK_2, BATCH_2)):
        run_cards_scd2_buckets(spark, cards, table, base, f"{base}/closed", clock, batch, buckets=16)
    return dimension(spark, table, f"{base}/closed")


@register
def q_catalog_register(spark, sf):
    """Refined transactions registered as an external table; rows per partition."""
    base = fresh_dir(spark, "catalog")
    database = _unique("ledgerlake_dw")
    location = f"{base}/transactions_refined"
    append_refined_transactions(refine.transactions_refined(X.transactions(spark, sf)), location)
    catalog.register_refined_tables(
        spark, database, {"transactions_refined": location}, database_location=f"{base}/db"
    )
    return spark.sql(
        f"SELECT txn_year, txn_month, txn_day, count(*) AS row_count "
        f"FROM `{database}`.`transactions_refined` GROUP BY txn_year, txn_month, txn_day"
    )


def _warehouse(spark, sf) -> RefineTargets:
    """The whole warehouse refine job over the three sources."""
    base = fresh_dir(spark, "warehouse")
    src_cards = f"{base}/cards_scd2"
    _scd2_merged(spark, sf).write.parquet(src_cards)
    src_txn = f"{base}/raw_transactions"
    write_partitioned(X.transactions(spark, sf), src_txn, schemas.INGEST_PARTITIONS)
    src_users = f"{base}/raw_users"
    write_partitioned(X.users(spark, sf), src_users, schemas.INGEST_PARTITIONS)
    config = RefineTargets(
        database=_unique("ledgerlake_dw"),
        users_source=src_users,
        cards_scd2_source=src_cards,
        transactions_source=src_txn,
        users_refined=f"{base}/users_refined",
        cards_refined_scd2=f"{base}/cards_refined_scd2",
        transactions_refined=f"{base}/transactions_refined",
        database_location=f"{base}/db",
    )
    run_warehouse(spark, config, clock=CLOCK_2)
    return config


@register
def q_warehouse_counts(spark, sf):
    """Rows per refined table after the warehouse job."""
    config = _warehouse(spark, sf)
    parts = [
        spark.table(f"`{config.database}`.`{name}`").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in ("users_refined", "cards_refined_scd2", "transactions_refined")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def q_warehouse_users(spark, sf):
    """The users table of the warehouse job, read back through the catalog."""
    return spark.table(f"`{_warehouse(spark, sf).database}`.`users_refined`")


@register
def q_warehouse_cards(spark, sf):
    """The cards table of the warehouse job, read back through the catalog."""
    return spark.table(f"`{_warehouse(spark, sf).database}`.`cards_refined_scd2`")


@register
def q_warehouse_transactions(spark, sf):
    """The transactions table of the warehouse job, read back through the catalog."""
    return spark.table(f"`{_warehouse(spark, sf).database}`.`transactions_refined`")


# --- streaming -------------------------------------------------------------------------


@register
def q_transactions_stream_roundtrip(spark, sf):
    """Raw ingest days arrive as files; the stream refines each exactly once.

    Two runs of the same stream: the second finds nothing new, so nothing is
    appended twice.
    """
    base = fresh_dir(spark, "stream")
    raw = X.transactions(spark, sf)
    write_partitioned(raw, f"{base}/raw", schemas.INGEST_PARTITIONS)
    schema = spark.read.parquet(f"{base}/raw").schema
    for _ in range(2):
        q = start_transactions_append(spark, f"{base}/raw", f"{base}/out", f"{base}/checkpoint", schema)
        q.awaitTermination()
    return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{base}/out")


@register
def q_transactions_stream_reingested(spark, sf):
    """Day 23 is ingested again, an hour later and as new files; the stream refines each row once."""
    base = fresh_dir(spark, "stream_reingested")
    raw = X.transactions(spark, sf)
    again = raw.filter(F.col("ingest_day") == 23).withColumn("ingest_time", F.expr("ingest_time + interval 1 hour"))
    for rows in (raw, again):
        write_partitioned(rows, f"{base}/raw", schemas.INGEST_PARTITIONS, mode="append")
        q = start_transactions_append(spark, f"{base}/raw", f"{base}/out", f"{base}/checkpoint", raw.schema, dedupe_within="30 days")
        q.awaitTermination()
    return spark.read.schema(schemas.TRANSACTIONS_REFINED).parquet(f"{base}/out")
