"""Declared table layouts.

One StructType per table drives three things: the final cast and column order
of a builder, the read schema of a written table (so partition values are not
re-inferred) and the catalog DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, order and types that must equal the reference's
# tables. Partition columns come last and are listed again in *_PARTITIONS.
# ---------------------------------------------------------------------------

USERS_REFINED_DDL = """
user_id BIGINT, user_id_raw STRING, user_id_null_flag BOOLEAN, user_id_unknown_flag BOOLEAN,
current_age INT, current_age_raw STRING, current_age_null_flag BOOLEAN, current_age_unknown_flag BOOLEAN, current_age_outlier_flag BOOLEAN,
retirement_age INT, retirement_age_raw STRING, retirement_age_null_flag BOOLEAN, retirement_age_unknown_flag BOOLEAN, retirement_age_outlier_flag BOOLEAN,
birth_year INT, birth_year_raw STRING, birth_year_null_flag BOOLEAN, birth_year_unknown_flag BOOLEAN, birth_year_outlier_flag BOOLEAN,
birth_month INT, birth_month_raw STRING, birth_month_null_flag BOOLEAN, birth_month_unknown_flag BOOLEAN,
gender STRING, address STRING,
latitude DOUBLE, latitude_raw STRING, latitude_null_flag BOOLEAN, latitude_unknown_flag BOOLEAN,
longitude DOUBLE, longitude_raw STRING, longitude_null_flag BOOLEAN, longitude_unknown_flag BOOLEAN,
per_capita_income_raw STRING, per_capita_income_amount DOUBLE, per_capita_income_amount_null_flag BOOLEAN, per_capita_income_amount_unknown_flag BOOLEAN, per_capita_income_currency STRING,
yearly_income_raw STRING, yearly_income_amount DOUBLE, yearly_income_amount_null_flag BOOLEAN, yearly_income_amount_unknown_flag BOOLEAN, yearly_income_currency STRING,
total_debt_raw STRING, total_debt_amount DOUBLE, total_debt_amount_null_flag BOOLEAN, total_debt_amount_unknown_flag BOOLEAN, total_debt_currency STRING,
credit_score INT, credit_score_raw STRING, credit_score_null_flag BOOLEAN, credit_score_unknown_flag BOOLEAN,
num_credit_cards INT, num_credit_cards_raw STRING, num_credit_cards_null_flag BOOLEAN, num_credit_cards_unknown_flag BOOLEAN,
age_group STRING, income_group STRING,
load_day DATE
"""
USERS_REFINED_PARTITIONS = ["load_day"]

CARDS_REFINED_DDL = """
card_id BIGINT, card_id_raw STRING, card_id_null_flag BOOLEAN, card_id_unknown_flag BOOLEAN,
client_id BIGINT, client_id_raw STRING, client_id_null_flag BOOLEAN, client_id_unknown_flag BOOLEAN,
card_brand STRING, card_type STRING, card_number STRING, expires STRING, cvv STRING, has_chip STRING,
num_cards_issued INT, num_cards_issued_raw STRING, num_cards_issued_null_flag BOOLEAN, num_cards_issued_unknown_flag BOOLEAN,
credit_limit_raw STRING, credit_limit_amount DOUBLE, credit_limit_amount_null_flag BOOLEAN, credit_limit_amount_unknown_flag BOOLEAN, credit_limit_currency STRING,
acct_open_date DATE, acct_open_date_raw STRING, acct_open_date_null_flag BOOLEAN, acct_open_date_unknown_flag BOOLEAN,
year_pin_last_changed INT, year_pin_last_changed_raw STRING, year_pin_last_changed_null_flag BOOLEAN, year_pin_last_changed_unknown_flag BOOLEAN, year_pin_last_changed_outlier_flag BOOLEAN,
card_on_dark_web STRING,
effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, batch_id STRING,
effective_year INT, effective_month INT
"""
CARDS_REFINED_PARTITIONS = ["effective_year", "effective_month"]

TRANSACTIONS_REFINED_DDL = """
transaction_id BIGINT, transaction_id_raw STRING, transaction_id_null_flag BOOLEAN, transaction_id_unknown_flag BOOLEAN,
txn_timestamp TIMESTAMP,
client_id BIGINT, client_id_raw STRING, client_id_null_flag BOOLEAN, client_id_unknown_flag BOOLEAN,
card_id BIGINT, card_id_raw STRING, card_id_null_flag BOOLEAN, card_id_unknown_flag BOOLEAN,
amount_raw STRING, amount DOUBLE, amount_null_flag BOOLEAN, amount_unknown_flag BOOLEAN, amount_currency STRING,
use_chip STRING, merchant_id STRING, merchant_city STRING, merchant_state STRING, zip STRING, mcc STRING, errors STRING,
txn_year INT, txn_month INT, txn_day INT
"""
TRANSACTIONS_REFINED_PARTITIONS = ["txn_year", "txn_month", "txn_day"]

# Business columns of the two change-tracked entities, key first.
USER_COLUMNS = [
    "user_id", "current_age", "retirement_age", "birth_year", "birth_month",
    "gender", "address", "latitude", "longitude", "per_capita_income",
    "yearly_income", "total_debt", "credit_score", "num_credit_cards",
]
CARD_COLUMNS = [
    "card_id", "client_id", "card_brand", "card_type", "card_number", "expires",
    "cvv", "has_chip", "num_cards_issued", "credit_limit", "acct_open_date",
    "year_pin_last_changed", "card_on_dark_web",
]

# Lineage stamped on every raw table.
INGEST_PARTITIONS = ["ingest_year", "ingest_month", "ingest_day"]
LINEAGE_COLUMNS = ["table_source", "ingest_time"] + INGEST_PARTITIONS

# Slim transaction index and the record columns a lookup returns.
INDEX_COLUMNS = ["transaction_id", "client_id", "card_id"] + LINEAGE_COLUMNS
LOOKUP_RECORD_COLUMNS = ["date", "amount", "merchant_id", "merchant_city", "merchant_state", "errors"]

# Metadata of the users change log and of the cards type 2 dimension.
HISTORY_META = ["change_type", "change_detected_at", "batch_id"]
SCD2_META = ["effective_from", "effective_to", "is_current", "batch_id"]

# ---------------------------------------------------------------------------


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct_of(ddl: str) -> T.StructType:
    """StructType of a ``name TYPE, ...`` column list (the types used above)."""
    fields = []
    for item in ddl.split(","):
        name, type_name = item.split()
        fields.append(T.StructField(name, _TYPES[type_name.upper()]))
    return T.StructType(fields)


USERS_REFINED = struct_of(USERS_REFINED_DDL)
CARDS_REFINED = struct_of(CARDS_REFINED_DDL)
TRANSACTIONS_REFINED = struct_of(TRANSACTIONS_REFINED_DDL)

REFINED_TABLES = {
    "users_refined": (USERS_REFINED, USERS_REFINED_PARTITIONS),
    "cards_refined_scd2": (CARDS_REFINED, CARDS_REFINED_PARTITIONS),
    "transactions_refined": (TRANSACTIONS_REFINED, TRANSACTIONS_REFINED_PARTITIONS),
}


def users_history_schema() -> T.StructType:
    """Change log: user business columns as normalised, then metadata."""
    fields = [T.StructField("user_id", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in USER_COLUMNS[1:]]
    fields += [
        T.StructField("change_type", T.StringType()),
        T.StructField("change_detected_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
    return T.StructType(fields)


def column_ddl(schema: T.StructType, exclude: list[str] | None = None) -> str:
    """``name TYPE, ...`` for CREATE TABLE, optionally without some columns."""
    skip = set(exclude or [])
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields if f.name not in skip
    )
