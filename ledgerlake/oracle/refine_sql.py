"""DuckDB SQL of the three refined-table builders (CTE bodies over a source)."""

from __future__ import annotations

from ledgerlake.oracle import rules_sql as R

USER_INTS = ["current_age", "retirement_age", "birth_year", "birth_month", "credit_score", "num_credit_cards"]
USER_MONEY = ["per_capita_income", "yearly_income", "total_debt"]


def users_layer1(src: str, signed: bool = False) -> str:
    items = R.integer_group("id", "user_id", "BIGINT")
    for c in USER_INTS:
        items += R.integer_group(c, c)
    items += R.decimal_group("latitude", "latitude") + R.decimal_group("longitude", "longitude")
    for c in USER_MONEY:
        items += R.currency_group(c, f"{c}_raw", f"{c}_amount", f"{c}_currency", signed=signed)
    items += ["CAST(gender AS VARCHAR) AS gender", "CAST(address AS VARCHAR) AS address"]
    items.append(f"{R.day_from_parts('ingest_year', 'ingest_month', 'ingest_day')} AS load_day")
    return f"SELECT {R.select_list(items)} FROM {src}"


def users_layer2(layer1: str, current_year: int) -> str:
    return f"""SELECT *,
  {R.above('birth_year', current_year)} AS birth_year_outlier_flag,
  {R.below('current_age', 0)} AS current_age_outlier_flag,
  {R.above('retirement_age', 100)} AS retirement_age_outlier_flag,
  {R.age_group('current_age')} AS age_group,
  {R.income_group('yearly_income_amount')} AS income_group
FROM {layer1}"""


def cards_layer1(src: str) -> str:
    items = R.integer_group("card_id", "card_id", "BIGINT")
    items += R.integer_group("client_id", "client_id", "BIGINT")
    items += R.integer_group("num_cards_issued", "num_cards_issued")
    items += R.currency_group("credit_limit", "credit_limit_raw", "credit_limit_amount", "credit_limit_currency")
    items += R.integer_group("year_pin_last_changed", "year_pin_last_changed")
    items += R.month_year_group("acct_open_date", "acct_open_date")
    items += [f"CAST({c} AS VARCHAR) AS {c}" for c in ["card_brand", "card_type", "card_number", "expires", "cvv", "has_chip", "card_on_dark_web"]]
    items += ["effective_from", "effective_to", "is_current", "batch_id"]
    items += [
        "CAST(year(effective_from) AS INTEGER) AS effective_year",
        "CAST(month(effective_from) AS INTEGER) AS effective_month",
    ]
    return f"SELECT {R.select_list(items)} FROM {src}"


def cards_layer2(layer1: str, current_year: int) -> str:
    return f"SELECT *, {R.above('year_pin_last_changed', current_year)} AS year_pin_last_changed_outlier_flag FROM {layer1}"


def transactions_refined(src: str, currency_from_raw: bool = False, signed: bool = False) -> str:
    items = R.integer_group("id", "transaction_id", "BIGINT")
    items += R.integer_group("client_id", "client_id", "BIGINT")
    items += R.integer_group("card_id", "card_id", "BIGINT")
    code = None if currency_from_raw else "'UNKNOWN'"
    items += R.currency_group("amount", "amount_raw", "amount", "amount_currency", code=code, signed=signed)
    items += R.timestamp_parts("date", "txn_timestamp", "txn_year", "txn_month", "txn_day")
    items += [f"CAST({c} AS VARCHAR) AS {c}" for c in ["use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors"]]
    return f"SELECT {R.select_list(items)} FROM {src}"
