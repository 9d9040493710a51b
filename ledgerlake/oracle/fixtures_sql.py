"""DuckDB SQL for the fixture tables of :mod:`ledgerlake.sources.tpch_fixtures`.

Each entry is the body of a common table expression over the driver's
pre-registered views (customer, part, orders, lineitem). Query oracles are
``WITH`` chains built from these bodies.
"""

from __future__ import annotations


def _money(x: str) -> str:
    return f"'$' || CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


def _mmyyyy(m: str, y: str) -> str:
    return f"lpad(CAST({m} AS VARCHAR), 2, '0') || '/' || CAST({y} AS VARCHAR)"


def _ingest(day: str, hour: int, source: str) -> str:
    return (
        f"'{source}' AS table_source, "
        f"make_timestamp(2026, 4, {day}, {hour}, 0, 0) AS ingest_time, "
        f"2026 AS ingest_year, 4 AS ingest_month, CAST({day} AS INTEGER) AS ingest_day"
    )


USERS = f"""
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN ''
       WHEN c_custkey % 23 = 0 THEN '-5' WHEN c_custkey % 29 = 0 THEN 'n/a'
       ELSE CAST(18 + (c_custkey * 7) % 70 AS VARCHAR) END AS current_age,
  CAST(50 + c_custkey % 60 AS VARCHAR) AS retirement_age,
  CAST(1940 + c_custkey % 90 AS VARCHAR) AS birth_year,
  CAST(1 + c_custkey % 12 AS VARCHAR) AS birth_month,
  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  c_name AS address,
  CASE WHEN c_custkey % 31 = 0 THEN 'abc'
       ELSE CAST(CAST((c_custkey % 180) - 90 AS DECIMAL(9,2)) AS VARCHAR) END AS latitude,
  CAST(CAST((c_custkey % 360) - 180 AS DECIMAL(9,2)) AS VARCHAR) AS longitude,
  {_money('c_acctbal * 5')} AS per_capita_income,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN ''
       WHEN c_custkey % 23 = 0 THEN CAST(CAST(abs(c_acctbal) * 10 AS DECIMAL(18,2)) AS VARCHAR)
       ELSE {_money('abs(c_acctbal) * 10')} END AS yearly_income,
  {_money('c_acctbal')} AS total_debt,
  CAST(300 + c_custkey % 551 AS VARCHAR) AS credit_score,
  CAST(c_custkey % 9 AS VARCHAR) AS num_credit_cards,
  {_ingest('23', 1, 'customer')}
FROM customer
"""

USERS_1 = "SELECT * FROM users WHERE id % 11 <> 0"

USERS_2 = """
SELECT * REPLACE (
  CASE WHEN id % 13 = 0 THEN address || ' UPDATED' ELSE address END AS address,
  CASE WHEN id % 13 = 0 THEN '$999999' ELSE yearly_income END AS yearly_income,
  CASE WHEN id % 26 = 0 THEN NULL WHEN id % 13 = 0 THEN '$12345' ELSE total_debt END AS total_debt)
FROM users WHERE id % 7 <> 0
"""

USERS_2_COPIES = """
SELECT * FROM users_2
UNION ALL
SELECT * REPLACE ('A_COPY' AS address, ingest_time + INTERVAL 1 HOUR AS ingest_time) FROM users_2 WHERE id % 17 = 0
"""

CARDS = f"""
SELECT p_partkey AS id,
  (p_partkey * 3) % 1500 AS client_id,
  p_brand AS card_brand,
  p_type AS card_type,
  lpad(CAST(p_partkey AS VARCHAR), 16, '4') AS card_number,
  {_mmyyyy('1 + p_partkey % 12', '2024 + p_partkey % 6')} AS expires,
  lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS cvv,
  CASE WHEN p_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip,
  CAST(p_size AS VARCHAR) AS num_cards_issued,
  {_money('p_retailprice')} AS credit_limit,
  CASE WHEN p_partkey % 37 = 0 THEN '13/2002' WHEN p_partkey % 41 = 0 THEN NULL
       ELSE {_mmyyyy('1 + p_partkey % 12', '1995 + p_partkey % 30')} END AS acct_open_date,
  CAST(2000 + p_partkey % 30 AS VARCHAR) AS year_pin_last_changed,
  'No' AS card_on_dark_web,
  {_ingest('23', 1, 'part')}
FROM part
"""

CARDS_1 = "SELECT * FROM cards WHERE id % 11 <> 0"

CARDS_2 = """
SELECT * REPLACE (
  CASE WHEN id % 13 = 0 THEN '$99999.00' ELSE credit_limit END AS credit_limit,
  CASE WHEN id % 13 = 0 THEN 'NO' ELSE has_chip END AS has_chip,
  CASE WHEN id % 13 = 0 THEN 'UPDATED_TYPE' ELSE card_type END AS card_type)
FROM cards WHERE id % 7 <> 0
"""

CARDS_2_COPIES = """
SELECT * FROM cards_2
UNION ALL
SELECT * REPLACE ('A_COPY' AS card_type, ingest_time + INTERVAL 1 HOUR AS ingest_time) FROM cards_2 WHERE id % 17 = 0
"""

CARD_CORRECTIONS = """
SELECT p_partkey AS id, '$99999.00' AS credit_limit, 'NO' AS has_chip, 'UPDATED_TYPE' AS card_type
FROM part WHERE p_partkey % 13 = 0
"""

TRANSACTIONS = f"""
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 101 = 0 THEN 'not a date' ELSE CAST(o_orderdate AS VARCHAR) END AS date,
  o_custkey AS client_id,
  o_orderkey % 2000 AS card_id,
  CASE WHEN o_orderkey % 9 = 0 THEN '$-' ELSE '$' END
    || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  o_orderpriority AS use_chip,
  CAST(o_orderkey % 100 AS VARCHAR) AS merchant_id,
  'city_' || CAST(o_custkey % 97 AS VARCHAR) AS merchant_city,
  o_orderstatus AS merchant_state,
  lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS zip,
  CAST(5000 + o_orderkey % 300 AS VARCHAR) AS mcc,
  CASE WHEN o_orderkey % 53 = 0 THEN 'Insufficient Balance' ELSE NULL END AS errors,
  {_ingest('21 + o_orderkey % 3', 2, 'orders')}
FROM orders
"""

TRANSACTIONS_DUP = f"""
SELECT l_orderkey * 10 + l_linenumber AS id,
  CAST(l_shipdate AS VARCHAR) AS date,
  l_partkey AS client_id,
  l_suppkey AS card_id,
  {_money('l_extendedprice')} AS amount,
  l_returnflag AS use_chip,
  CAST(l_suppkey % 100 AS VARCHAR) AS merchant_id,
  CAST(NULL AS VARCHAR) AS merchant_city,
  l_linestatus AS merchant_state,
  CAST(NULL AS VARCHAR) AS zip,
  CAST(NULL AS VARCHAR) AS mcc,
  CAST(NULL AS VARCHAR) AS errors,
  {_ingest('21 + l_partkey % 3', 3, 'lineitem')}
FROM lineitem
"""

TRANSACTIONS_ODD = """
SELECT * REPLACE (
  CASE WHEN id % 15 = 0 THEN NULL WHEN id % 10 = 0 THEN 'bad' || CAST(id AS VARCHAR) ELSE CAST(id AS VARCHAR) END AS id)
FROM (SELECT * FROM transactions UNION ALL SELECT * FROM transactions WHERE id % 4 = 0)
"""

TRANSACTIONS_AGAIN = """
SELECT * FROM transactions_dup
UNION ALL
SELECT * REPLACE (24 AS ingest_day, ingest_time + INTERVAL 3 DAY AS ingest_time)
FROM transactions_dup WHERE ingest_day = 21
"""

TRANSACTIONS_LEFT = "SELECT * FROM transactions_dup WHERE ingest_day <> 23 OR id % 3 <> 0"

# name -> (body, names it depends on)
FIXTURES = {
    "users": (USERS, []),
    "users_1": (USERS_1, ["users"]),
    "users_2": (USERS_2, ["users"]),
    "users_2_copies": (USERS_2_COPIES, ["users_2"]),
    "cards": (CARDS, []),
    "cards_1": (CARDS_1, ["cards"]),
    "cards_2": (CARDS_2, ["cards"]),
    "cards_2_copies": (CARDS_2_COPIES, ["cards_2"]),
    "card_corrections": (CARD_CORRECTIONS, []),
    "transactions": (TRANSACTIONS, []),
    "transactions_dup": (TRANSACTIONS_DUP, []),
    "transactions_odd": (TRANSACTIONS_ODD, ["transactions"]),
    "transactions_again": (TRANSACTIONS_AGAIN, ["transactions_dup"]),
    "transactions_left": (TRANSACTIONS_LEFT, ["transactions_dup"]),
}


def with_chain(steps: list[tuple[str, str]], final: str, fixtures: list[str]) -> str:
    """``WITH`` the named fixtures (and their dependencies), then ``steps``, then ``final``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        for dep in FIXTURES[name][1]:
            need(dep)
        ordered.append(name)

    for name in fixtures:
        need(name)
    ctes = [(n, FIXTURES[n][0]) for n in ordered] + list(steps)
    body = ",\n".join(f"{name} AS (\n{sql.strip()}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final.strip()}"
