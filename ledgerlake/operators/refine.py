"""Refined warehouse tables: typed columns beside their raw text and flags.

Each builder is two ``select`` layers: layer 1 reads only source columns and
emits the quality groups, layer 2 derives outliers and groups from the typed
values and casts to the declared schema in its order. Both run in one
whole-stage-codegen stage over the scan: a builder is a narrow, shuffle-free
map, and only the source columns it names are read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import derived as D
from ledgerlake.functions import quality as Q


def _cast_to(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def users_refined(
    source: DataFrame,
    current_year: int | None = None,
    load_day_default: Column | str | _dt.date | None = None,
    signed_money: bool = False,
) -> DataFrame:
    """users_refined (59 columns, ``load_day`` last).

    ``signed_money=True`` reads negative money text instead of flagging it
    unknown (see :func:`ledgerlake.functions.quality.currency_group`).

    ``current_year`` bounds the birth-year outlier (default: this year).
    ``load_day`` comes from the ingest parts when all three exist, else from
    ``load_day_default`` (default: today).
    """
    cols = source.columns
    current_year = current_year if current_year is not None else _dt.date.today().year
    uid = Q.first_present(cols, "id", "user_id")

    layer1 = list(Q.integer_group(uid, "user_id", "bigint"))
    for name in ["current_age", "retirement_age", "birth_year", "birth_month", "credit_score", "num_credit_cards"]:
        layer1 += Q.integer_group(name, name, "int")
    layer1 += Q.decimal_group("latitude", "latitude")
    layer1 += Q.decimal_group("longitude", "longitude")
    for name in ["per_capita_income", "yearly_income", "total_debt"]:
        layer1 += Q.currency_group(name, f"{name}_raw", f"{name}_amount", f"{name}_currency", signed_money)
    layer1 += [F.col("gender"), F.col("address")]
    if Q.has_columns(cols, schemas.INGEST_PARTITIONS):
        layer1.append(D.day_from_parts(*schemas.INGEST_PARTITIONS).alias("load_day"))
    elif load_day_default is None:
        layer1.append(F.current_date().alias("load_day"))
    else:
        layer1.append(F.lit(load_day_default).cast("date").alias("load_day"))

    step = source.select(*layer1)
    step = step.select(
        "*",
        D.above("birth_year", current_year).alias("birth_year_outlier_flag"),
        D.below("current_age", 0).alias("current_age_outlier_flag"),
        D.above("retirement_age", D.RETIREMENT_AGE_LIMIT).alias("retirement_age_outlier_flag"),
        D.age_group("current_age").alias("age_group"),
        D.income_group("yearly_income_amount").alias("income_group"),
    )
    return _cast_to(step, schemas.USERS_REFINED)


def cards_refined(source: DataFrame, current_year: int | None = None, signed_money: bool = False) -> DataFrame:
    """cards_refined_scd2 (39 columns, effective year and month last).

    The source is the cards type 2 dimension: business columns plus
    ``effective_from``, ``effective_to``, ``is_current`` and ``batch_id``.
    """
    cols = source.columns
    current_year = current_year if current_year is not None else _dt.date.today().year
    key = Q.first_present(cols, "card_id", "id")
    limit = Q.first_present(cols, "credit_limit", "credit_limit_raw")

    layer1 = list(Q.integer_group(key, "card_id", "bigint"))
    layer1 += Q.integer_group("client_id", "client_id", "bigint")
    layer1 += Q.integer_group("num_cards_issued", "num_cards_issued", "int")
    layer1 += Q.currency_group(limit, "credit_limit_raw", "credit_limit_amount", "credit_limit_currency", signed_money)
    layer1 += Q.integer_group("year_pin_last_changed", "year_pin_last_changed", "int")
    layer1 += D.month_year_group("acct_open_date" if "acct_open_date" in cols else None, "acct_open_date")
    layer1 += [F.col(c) for c in ["card_brand", "card_type", "card_number", "expires", "cvv", "has_chip", "card_on_dark_web"]]
    layer1 += [F.col(c) for c in schemas.SCD2_META]
    layer1 += [
        F.year("effective_from").cast("int").alias("effective_year"),
        F.month("effective_from").cast("int").alias("effective_month"),
    ]

    step = source.select(*layer1)
    step = step.select(
        "*",
        D.above("year_pin_last_changed", current_year).alias("year_pin_last_changed_outlier_flag"),
    )
    return _cast_to(step, schemas.CARDS_REFINED)


def transactions_refined(source: DataFrame, currency_from_raw: bool = False, signed_money: bool = False, keep: list[str] | None = None) -> DataFrame:
    """transactions_refined (28 columns, txn year, month and day last), then the source columns ``keep``.

    When source and output are both ``amount`` the reference derives the
    currency code after ``amount`` has become a DOUBLE; no ``$`` is left, so
    the code is always ``UNKNOWN``. That is the default here, written as the
    constant it provably is; ``currency_from_raw=True`` reads the code from
    the raw text instead.
    """
    cols = source.columns
    tid = Q.first_present(cols, "id", "transaction_id")
    amount = Q.first_present(cols, "amount", "amount_raw")
    when = Q.first_present(cols, "date", "txn_timestamp")

    money = Q.currency_group(amount, "amount_raw", "amount", "amount_currency", signed_money)
    if not currency_from_raw and amount == "amount":
        money[-1] = F.lit(Q.CURRENCY_CODE_OTHER).alias("amount_currency")

    layer1 = list(Q.integer_group(tid, "transaction_id", "bigint"))
    layer1 += Q.integer_group("client_id", "client_id", "bigint")
    layer1 += Q.integer_group("card_id", "card_id", "bigint")
    layer1 += money
    layer1 += D.timestamp_parts(when, "txn_timestamp", "txn_year", "txn_month", "txn_day")
    layer1 += [F.col(c) for c in ["use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors"]]
    step = source.select(*layer1, *(keep or []))
    return step.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TRANSACTIONS_REFINED.fields], *(keep or []))


def transactions_dated(refined: DataFrame) -> DataFrame:
    """Rows whose year, month and day all parsed; undated rows are dropped."""
    return refined.filter(
        F.col("txn_year").isNotNull() & F.col("txn_month").isNotNull() & F.col("txn_day").isNotNull()
    )


def transactions_undated(refined: DataFrame) -> DataFrame:
    """The rows that :func:`transactions_dated` leaves out."""
    return refined.filter(F.col("txn_year").isNull() | F.col("txn_month").isNull() | F.col("txn_day").isNull())


def flag_counts(refined: DataFrame) -> dict[str, Column]:
    """Aggregates for a quality report: all rows, undated ones (transactions), and each true flag."""
    counts = {"rows": F.count(F.lit(1))}
    if "txn_year" in refined.columns:
        counts["undated"] = F.count_if(F.col("txn_year").isNull() | F.col("txn_month").isNull() | F.col("txn_day").isNull())
    return counts | {c: F.count_if(F.col(c)) for c in refined.columns if c.endswith("_flag")}


def month_keys(refined: DataFrame) -> DataFrame:
    """Distinct (txn_year, txn_month) of dated rows, ascending."""
    return (
        transactions_dated(refined)
        .select("txn_year", "txn_month")
        .distinct()
        .orderBy("txn_year", "txn_month")
    )
