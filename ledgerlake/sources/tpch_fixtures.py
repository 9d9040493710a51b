"""Card-payment source tables derived from the TPC-H-style test tables.

The reference reads users, cards and transactions from a database. The test
data has customers, parts, orders and line items instead, so these functions
derive source tables of the same shape from them - every row of the input
becomes one row of the output, so the work grows with the tables. Values are
built to exercise each quality rule: NULL, blank, signed, junk and
out-of-range text, money with and without ``$``, unparsable dates.

Snapshot membership for the change-tracking pairs is a rule on the key
(``k % 11 <> 0`` for the first snapshot, ``k % 7 <> 0`` for the second) so
that both inserts and deletes occur; it is part of the fixture definition,
not a sample.

The same derivations are written in DuckDB SQL in
:mod:`ledgerlake.oracle.fixtures_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixture constants (ingest date of the raw batches).
INGEST_YEAR = 2026
INGEST_MONTH = 4
USERS_INGEST_DAY = 23
CARDS_INGEST_DAY = 23
FIRST_TXN_INGEST_DAY = 21


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def money(x: Column) -> Column:
    """``$`` followed by the value rounded to cents."""
    return F.concat(F.lit("$"), _s(x.cast("decimal(18,2)")))


def mmyyyy(m: Column, y: Column) -> Column:
    return F.concat(F.lpad(_s(m), 2, "0"), F.lit("/"), _s(y))


def _ingest(day: Column, hour: int, source: str) -> list[Column]:
    return [
        F.lit(source).alias("table_source"),
        F.make_timestamp(F.lit(INGEST_YEAR), F.lit(INGEST_MONTH), day, F.lit(hour), F.lit(0), F.lit(0)).alias("ingest_time"),
        F.lit(INGEST_YEAR).alias("ingest_year"),
        F.lit(INGEST_MONTH).alias("ingest_month"),
        day.cast("int").alias("ingest_day"),
    ]


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw users, one per customer (``id`` = ``c_custkey``)."""
    c = load(spark, sf_dir, "customer")
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    return c.select(
        k.alias("id"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 19 == 0, F.lit(""))
        .when(k % 23 == 0, F.lit("-5"))
        .when(k % 29 == 0, F.lit("n/a"))
        .otherwise(_s(18 + (k * 7) % 70))
        .alias("current_age"),
        _s(50 + k % 60).alias("retirement_age"),
        _s(1940 + k % 90).alias("birth_year"),
        _s(1 + k % 12).alias("birth_month"),
        F.when(k % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.col("c_name").alias("address"),
        F.when(k % 31 == 0, F.lit("abc")).otherwise(_s(((k % 180) - 90).cast("decimal(9,2)"))).alias("latitude"),
        _s(((k % 360) - 180).cast("decimal(9,2)")).alias("longitude"),
        money(b * 5).alias("per_capita_income"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 19 == 0, F.lit(""))
        .when(k % 23 == 0, _s((F.abs(b) * 10).cast("decimal(18,2)")))
        .otherwise(money(F.abs(b) * 10))
        .alias("yearly_income"),
        money(b).alias("total_debt"),
        _s(300 + k % 551).alias("credit_score"),
        _s(k % 9).alias("num_credit_cards"),
        *_ingest(F.lit(USERS_INGEST_DAY), 1, "customer"),
    )


def users_snapshot_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First full users snapshot: every customer with ``k % 11 <> 0``."""
    return users(spark, sf_dir).filter(F.col("id") % 11 != 0)


def users_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: ``k % 7 <> 0``; ``k % 13 = 0`` changed, ``k % 26 = 0`` debt cleared."""
    u = users(spark, sf_dir).filter(F.col("id") % 7 != 0)
    k = F.col("id")
    hit = k % 13 == 0
    return u.withColumns(
        {
            "address": F.when(hit, F.concat(F.col("address"), F.lit(" UPDATED"))).otherwise(F.col("address")),
            "yearly_income": F.when(hit, F.lit("$999999")).otherwise(F.col("yearly_income")),
            "total_debt": F.when(k % 26 == 0, F.lit(None).cast("string"))
            .when(hit, F.lit("$12345"))
            .otherwise(F.col("total_debt")),
        }
    )


def users_snapshot_2_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second users snapshot where every user with ``k % 17 = 0`` appears twice.

    The copy was ingested an hour later and has ``address`` ``A_COPY``, so a
    repeated key carries two different rows and the ingest time decides.
    """
    u2 = users_snapshot_2(spark, sf_dir)
    copies = u2.filter(F.col("id") % 17 == 0).withColumn("address", F.lit("A_COPY"))
    return u2.unionByName(copies.withColumn("ingest_time", F.expr("ingest_time + interval 1 hour")))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cards, one per part (``id`` = ``p_partkey``)."""
    p = F.col("p_partkey")
    return load(spark, sf_dir, "part").select(
        p.alias("id"),
        ((p * 3) % 1500).alias("client_id"),
        F.col("p_brand").alias("card_brand"),
        F.col("p_type").alias("card_type"),
        F.lpad(_s(p), 16, "4").alias("card_number"),
        mmyyyy(1 + p % 12, 2024 + p % 6).alias("expires"),
        F.lpad(_s(p % 1000), 3, "0").alias("cvv"),
        F.when(p % 2 == 0, F.lit("YES")).otherwise(F.lit("NO")).alias("has_chip"),
        _s(F.col("p_size")).alias("num_cards_issued"),
        money(F.col("p_retailprice")).alias("credit_limit"),
        F.when(p % 37 == 0, F.lit("13/2002"))
        .when(p % 41 == 0, F.lit(None).cast("string"))
        .otherwise(mmyyyy(1 + p % 12, 1995 + p % 30))
        .alias("acct_open_date"),
        _s(2000 + p % 30).alias("year_pin_last_changed"),
        F.lit("No").alias("card_on_dark_web"),
        *_ingest(F.lit(CARDS_INGEST_DAY), 1, "part"),
    )


def cards_snapshot_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards(spark, sf_dir).filter(F.col("id") % 11 != 0)


def cards_snapshot_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p % 7 <> 0``; ``p % 13 = 0`` gets a new limit, chip and type."""
    c = cards(spark, sf_dir).filter(F.col("id") % 7 != 0)
    hit = F.col("id") % 13 == 0
    return c.withColumns(
        {
            "credit_limit": F.when(hit, F.lit("$99999.00")).otherwise(F.col("credit_limit")),
            "has_chip": F.when(hit, F.lit("NO")).otherwise(F.col("has_chip")),
            "card_type": F.when(hit, F.lit("UPDATED_TYPE")).otherwise(F.col("card_type")),
        }
    )


def cards_snapshot_2_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot where every card with ``p % 17 = 0`` appears twice.

    The copy was ingested an hour later and has ``card_type`` ``A_COPY``, so a
    repeated key carries two different rows and the ingest time decides.
    """
    c2 = cards_snapshot_2(spark, sf_dir)
    copies = c2.filter(F.col("id") % 17 == 0).withColumn("card_type", F.lit("A_COPY"))
    return c2.unionByName(copies.withColumn("ingest_time", F.expr("ingest_time + interval 1 hour")))


def card_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed corrections for every part with ``p % 13 = 0`` (three columns)."""
    p = F.col("p_partkey")
    return (
        load(spark, sf_dir, "part")
        .filter(p % 13 == 0)
        .select(
            p.alias("id"),
            F.lit("$99999.00").alias("credit_limit"),
            F.lit("NO").alias("has_chip"),
            F.lit("UPDATED_TYPE").alias("card_type"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, one per order (unique ``id``), three ingest days."""
    o = F.col("o_orderkey")
    cents = _s(F.col("o_totalprice").cast("decimal(18,2)"))
    day = F.lit(FIRST_TXN_INGEST_DAY) + o % 3
    return load(spark, sf_dir, "orders").select(
        o.alias("id"),
        F.when(o % 101 == 0, F.lit("not a date")).otherwise(_s(F.col("o_orderdate"))).alias("date"),
        F.col("o_custkey").alias("client_id"),
        (o % 2000).alias("card_id"),
        F.concat(F.when(o % 9 == 0, F.lit("$-")).otherwise(F.lit("$")), cents).alias("amount"),
        F.col("o_orderpriority").alias("use_chip"),
        _s(o % 100).alias("merchant_id"),
        F.concat(F.lit("city_"), _s(F.col("o_custkey") % 97)).alias("merchant_city"),
        F.col("o_orderstatus").alias("merchant_state"),
        F.lpad(_s(o % 100000), 5, "0").alias("zip"),
        _s(5000 + o % 300).alias("mcc"),
        F.when(o % 53 == 0, F.lit("Insufficient Balance")).otherwise(F.lit(None).cast("string")).alias("errors"),
        *_ingest(day, 2, "orders"),
    )


def transactions_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions from line items; ids repeat across rows and ingest days."""
    li = load(spark, sf_dir, "lineitem")
    tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    day = F.lit(FIRST_TXN_INGEST_DAY) + F.col("l_partkey") % 3
    return li.select(
        tid.alias("id"),
        _s(F.col("l_shipdate")).alias("date"),
        F.col("l_partkey").alias("client_id"),
        F.col("l_suppkey").alias("card_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        F.col("l_returnflag").alias("use_chip"),
        _s(F.col("l_suppkey") % 100).alias("merchant_id"),
        F.lit(None).cast("string").alias("merchant_city"),
        F.col("l_linestatus").alias("merchant_state"),
        F.lit(None).cast("string").alias("zip"),
        F.lit(None).cast("string").alias("mcc"),
        F.lit(None).cast("string").alias("errors"),
        *_ingest(day, 3, "lineitem"),
    )


def transactions_with_odd_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with text ids: ``o % 15 = 0`` has none, else ``o % 10 = 0`` an unparsable
    one; every row with ``o % 4 = 0`` stands twice."""
    t = transactions(spark, sf_dir)
    o = F.col("id")
    twice = t.unionByName(t.filter(o % 4 == 0))
    text = F.when(o % 15 == 0, F.lit(None).cast("string")).when(o % 10 == 0, F.concat(F.lit("bad"), o.cast("string"))).otherwise(o.cast("string"))
    return twice.withColumn("id", text)


def brought_again(txn: DataFrame, day: int, later: int) -> DataFrame:
    """``txn`` and all rows of ingest day ``day`` once more on day ``later``."""
    again = txn.filter(F.col("ingest_day") == day).withColumns(
        {"ingest_day": F.lit(later).cast("int"), "ingest_time": F.expr(f"ingest_time + interval {later - day} days")}
    )
    return txn.unionByName(again.select(*txn.columns))
