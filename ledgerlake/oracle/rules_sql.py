"""DuckDB SQL text of the quality rules and derived columns.

All patterns, labels and limits are written out here, so that a wrong value in
:mod:`ledgerlake.functions` does not pass on both sides.
"""

from __future__ import annotations


def text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({text(c)}) = '')"


def matches(c: str, pattern: str) -> str:
    return f"regexp_matches({text(c)}, '{pattern}')"


def integer_group(src: str, out: str, dtype: str = "INTEGER", raw: str | None = None) -> list[str]:
    valid = matches(src, '^[0-9]+$')
    return [
        f"{text(src)} AS {raw or out + '_raw'}",
        f"{blank(src)} AS {out}_null_flag",
        f"(NOT {blank(src)} AND NOT {valid}) AS {out}_unknown_flag",
        f"CASE WHEN {valid} THEN TRY_CAST({src} AS {dtype}) END AS {out}",
    ]


def decimal_group(src: str, out: str) -> list[str]:
    valid = matches(src, r'^-?[0-9]+(\.[0-9]+)?$')
    return [
        f"{text(src)} AS {out}_raw",
        f"{blank(src)} AS {out}_null_flag",
        f"(NOT {blank(src)} AND NOT {valid}) AS {out}_unknown_flag",
        f"CASE WHEN {valid} THEN TRY_CAST({src} AS DOUBLE) END AS {out}",
    ]


def currency_code(src: str) -> str:
    return f"CASE WHEN {blank(src)} THEN NULL WHEN starts_with({text(src)}, '$') THEN 'USD' ELSE 'UNKNOWN' END"


def currency_group(
    src: str, raw: str, amount: str, currency: str, code: str | None = None, signed: bool = False
) -> list[str]:
    valid = matches(src, r'^(-\$?|\$-?)?[0-9,]+(\.[0-9]+)?$' if signed else r'^\$?[0-9,]+(\.[0-9]+)?$')
    code_sql = code if code is not None else f"CASE WHEN {valid} THEN {currency_code(src)} ELSE 'UNKNOWN' END"
    return [
        f"{text(src)} AS {raw}",
        f"{blank(src)} AS {amount}_null_flag",
        f"(NOT {blank(src)} AND NOT {valid}) AS {amount}_unknown_flag",
        f"CASE WHEN {valid} THEN TRY_CAST(regexp_replace({text(src)}, '[$,]', '', 'g') AS DOUBLE) END AS {amount}",
        f"{code_sql} AS {currency}",
    ]


def above(c: str, limit) -> str:
    return f"({c} IS NOT NULL AND {c} > {limit})"


def below(c: str, limit) -> str:
    return f"({c} IS NOT NULL AND {c} < {limit})"


def age_group(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} BETWEEN 0 AND 17 THEN 'under_18' "
        f"WHEN {c} BETWEEN 18 AND 25 THEN '18_25' WHEN {c} BETWEEN 26 AND 40 THEN '26_40' "
        f"WHEN {c} BETWEEN 41 AND 60 THEN '41_60' ELSE 'over_60' END"
    )


def income_group(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < 30000 THEN 'low_income' "
        f"WHEN {c} < 70000 THEN 'middle_income' ELSE 'high_income' END"
    )


def day_from_parts(y: str, m: str, d: str) -> str:
    return (
        f"TRY_CAST(concat_ws('-', {text(y)}, lpad({text(m)}, 2, '0'), lpad({text(d)}, 2, '0')) AS DATE)"
    )


def month_year_group(src: str, out: str) -> list[str]:
    parsed = f"CAST(try_strptime({text(src)}, '%m/%Y') AS DATE)"
    return [
        f"{parsed} AS {out}",
        f"{text(src)} AS {out}_raw",
        f"{blank(src)} AS {out}_null_flag",
        f"(NOT {blank(text(src))} AND {parsed} IS NULL) AS {out}_unknown_flag",
    ]


def timestamp_parts(src: str, ts: str, y: str, m: str, d: str) -> list[str]:
    parsed = f"TRY_CAST({text(src)} AS TIMESTAMP)"
    return [
        f"{parsed} AS {ts}",
        f"CAST(year({parsed}) AS INTEGER) AS {y}",
        f"CAST(month({parsed}) AS INTEGER) AS {m}",
        f"CAST(day({parsed}) AS INTEGER) AS {d}",
    ]


def any_differs(left: str, right: str, columns: list[str]) -> str:
    return "(" + " OR ".join(f"{left}.{c} IS DISTINCT FROM {right}.{c}" for c in columns) + ")"


def select_list(items: list[str]) -> str:
    return ",\n  ".join(items)
