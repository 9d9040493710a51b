"""DuckDB oracle SQL for the registered queries (same keys, same column names)."""

from __future__ import annotations

from ledgerlake.oracle import refine_sql as RS
from ledgerlake.oracle import rules_sql as R
from ledgerlake.oracle.fixtures_sql import with_chain

CURRENT_YEAR = 2026
USER_ATTRS = [
    "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address", "latitude", "longitude",
    "per_capita_income", "yearly_income", "total_debt", "credit_score", "num_credit_cards",
]
CARD_ATTRS = [
    "client_id", "card_brand", "card_type", "card_number", "expires", "cvv", "has_chip", "num_cards_issued",
    "credit_limit", "acct_open_date", "year_pin_last_changed", "card_on_dark_web",
]
CLOCK_1 = "TIMESTAMP '2026-04-23 04:22:19'"
CLOCK_2 = "TIMESTAMP '2026-04-24 04:22:19'"
BATCH_1 = "'20260423_042219'"
BATCH_2 = "'20260424_042219'"

ORACLE: dict[str, str] = {}

LATEST = (
    "latest",
    "SELECT * FROM transactions WHERE (ingest_year, ingest_month, ingest_day) = "
    "(SELECT (ingest_year, ingest_month, ingest_day) FROM transactions "
    "ORDER BY ingest_year DESC, ingest_month DESC, ingest_day DESC LIMIT 1)",
)
USERS_REFINED = [
    ("ur1", RS.users_layer1("users")),
    ("users_refined", RS.users_layer2("ur1", CURRENT_YEAR)),
]

# --- quality rules and column groups ----------------------------------------

ORACLE["quality_integer"] = with_chain(
    [], "SELECT id AS user_id, " + R.select_list(sum((R.integer_group(c, c) for c in RS.USER_INTS), [])) + " FROM users",
    ["users"],
)
ORACLE["quality_decimal"] = with_chain(
    [], "SELECT id AS user_id, " + R.select_list(R.decimal_group("latitude", "latitude") + R.decimal_group("longitude", "longitude")) + " FROM users",
    ["users"],
)
ORACLE["quality_currency"] = with_chain(
    [], "SELECT id AS user_id, " + R.select_list(sum((R.currency_group(c, f"{c}_raw", f"{c}_amount", f"{c}_currency") for c in RS.USER_MONEY), [])) + " FROM users",
    ["users"],
)
ORACLE["quality_currency_inplace"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))],
    "SELECT transaction_id, amount_raw, amount, amount_null_flag, amount_unknown_flag, amount_currency FROM tr",
    ["transactions"],
)

# --- derived columns -----------------------------------------------------------

ORACLE["outlier_flags"] = with_chain(
    USERS_REFINED,
    "SELECT user_id, birth_year_outlier_flag, current_age_outlier_flag, retirement_age_outlier_flag FROM users_refined",
    ["users"],
)
ORACLE["outlier_flags_cards"] = with_chain(
    [("c", "SELECT id AS card_id, " + R.select_list(R.integer_group("year_pin_last_changed", "year_pin_last_changed")) + " FROM cards")],
    f"SELECT card_id, year_pin_last_changed, {R.above('year_pin_last_changed', CURRENT_YEAR)} AS year_pin_last_changed_outlier_flag FROM c",
    ["cards"],
)
ORACLE["age_group"] = with_chain(USERS_REFINED, "SELECT user_id, current_age, age_group FROM users_refined", ["users"])
ORACLE["income_group"] = with_chain(USERS_REFINED, "SELECT user_id, yearly_income_amount, income_group FROM users_refined", ["users"])
ORACLE["load_day"] = with_chain(USERS_REFINED, "SELECT user_id, load_day FROM users_refined", ["users"])
ORACLE["month_year_date"] = with_chain(
    [], "SELECT id AS card_id, " + R.select_list(R.month_year_group("acct_open_date", "acct_open_date")) + " FROM cards",
    ["cards"],
)
ORACLE["date_parts"] = with_chain(
    [], "SELECT id AS transaction_id, " + R.select_list(R.timestamp_parts("date", "txn_timestamp", "txn_year", "txn_month", "txn_day")) + " FROM transactions",
    ["transactions"],
)

# --- refined tables ------------------------------------------------------------

ORACLE["users_refined"] = with_chain(USERS_REFINED, "SELECT * FROM users_refined", ["users"])
ORACLE["users_refined_signed"] = with_chain(
    [("ur1", RS.users_layer1("users", signed=True)), ("urs", RS.users_layer2("ur1", CURRENT_YEAR))],
    "SELECT * FROM urs",
    ["users"],
)
ORACLE["transactions_refined"] = with_chain(
    [LATEST, ("tr", RS.transactions_refined("latest"))], "SELECT * FROM tr", ["transactions"]
)
ORACLE["transactions_refined_all"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))], "SELECT * FROM tr", ["transactions"]
)
ORACLE["transactions_refined_options"] = with_chain(
    [("tr", RS.transactions_refined("transactions", currency_from_raw=True, signed=True))],
    "SELECT * FROM tr",
    ["transactions"],
)
ORACLE["transactions_dated"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))],
    "SELECT * FROM tr WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL",
    ["transactions"],
)
ORACLE["month_keys"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))],
    "SELECT DISTINCT txn_year, txn_month FROM tr WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL "
    "AND txn_day IS NOT NULL ORDER BY txn_year, txn_month",
    ["transactions"],
)

# --- batches -------------------------------------------------------------------

ORACLE["latest_batch"] = with_chain([LATEST], "SELECT * FROM latest", ["transactions"])
ORACLE["latest_batch_catalog"] = ORACLE["latest_batch"]
ORACLE["batch_days"] = with_chain(
    [], "SELECT DISTINCT ingest_year, ingest_month, ingest_day FROM transactions", ["transactions"]
)


# --- lineage, index and lookup ------------------------------------------------------

ORACLE["raw_lineage"] = (
    f"SELECT *, 'users_data.csv' AS table_source, {CLOCK_1} AS ingest_time, "
    "2026 AS ingest_year, 4 AS ingest_month, 23 AS ingest_day FROM customer"
)


def _index_of(src: str) -> list[tuple[str, str]]:
    order = ", ".join(
        f"{c} DESC NULLS LAST"
        for c in ["ingest_time", "ingest_year", "ingest_month", "ingest_day", "client_id", "card_id", "table_source"]
    )
    return [
        (f"{src}_slim", f"SELECT id AS transaction_id, client_id, card_id, table_source, ingest_time, "
                        f"ingest_year, ingest_month, ingest_day FROM {src}"),
        (f"{src}_idx", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
                       f"(PARTITION BY transaction_id ORDER BY {order}) AS rn FROM {src}_slim) WHERE rn = 1"),
    ]


ORACLE["txn_index"] = with_chain(_index_of("transactions_dup"), "SELECT * FROM transactions_dup_idx", ["transactions_dup"])

_REQ = ("req", "SELECT DISTINCT id AS transaction_id FROM transactions_dup")
ORACLE["txn_lookup"] = with_chain(
    _index_of("transactions") + [_REQ],
    "SELECT i.transaction_id, i.client_id, i.card_id, i.table_source, i.ingest_time, i.ingest_year, i.ingest_month, "
    "i.ingest_day, t.date, t.amount, t.merchant_id, t.merchant_city, t.merchant_state, t.errors FROM transactions_idx i JOIN transactions t ON i.transaction_id = t.id "
    "WHERE i.transaction_id IN (SELECT transaction_id FROM req)",
    ["transactions", "transactions_dup"],
)
ORACLE["txn_point_lookup"] = with_chain(
    _index_of("transactions_dup"),
    "SELECT i.transaction_id, i.client_id, i.card_id, i.table_source, i.ingest_time, i.ingest_year, i.ingest_month, "
    "i.ingest_day, t.date, t.amount, t.merchant_id, t.merchant_city, t.merchant_state, t.errors "
    "FROM transactions_dup_idx i JOIN transactions_dup t ON i.transaction_id = t.id "
    "WHERE i.transaction_id IN (11, 13, 21, 6001, 4003, -1)",
    ["transactions_dup"],
)
ORACLE["txn_lookup_pruned"] = ORACLE["txn_lookup"]
ORACLE["txn_lookup_missing"] = with_chain(
    _index_of("transactions") + [_REQ],
    "SELECT r.transaction_id FROM req r WHERE NOT EXISTS "
    "(SELECT 1 FROM transactions_idx i WHERE i.transaction_id = r.transaction_id)",
    ["transactions", "transactions_dup"],
)

# --- users change history --------------------------------------------------------------

_UN = [
    ("u1n", "SELECT CAST(id AS BIGINT) AS user_id, " + ", ".join(USER_ATTRS) + " FROM users_1"),
    ("u2n", "SELECT CAST(id AS BIGINT) AS user_id, " + ", ".join(USER_ATTRS) + " FROM users_2"),
]
_DELTA = _UN + [(
    "delta",
    "SELECT cur.*, CASE WHEN inc.user_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change_type, "
    f"{CLOCK_2} AS change_detected_at, {BATCH_2} AS batch_id "
    "FROM u1n cur LEFT JOIN u2n inc ON cur.user_id = inc.user_id "
    f"WHERE cur.user_id IS NOT NULL AND (inc.user_id IS NULL OR {R.any_differs('cur', 'inc', USER_ATTRS)})",
)]
_DELTA_COPIES = [
    _UN[0],
    ("u2all", "SELECT CAST(id AS BIGINT) AS user_id, " + ", ".join(USER_ATTRS) + ", ingest_time FROM users_2_copies"),
    ("u2r", "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ingest_time DESC) AS rn FROM u2all"),
    ("u2n", "SELECT * EXCLUDE (rn, ingest_time) FROM u2r WHERE rn = 1"),
] + _DELTA[2:]
ORACLE["users_history_repeated_keys"] = with_chain(
    _DELTA_COPIES, "SELECT * FROM delta", ["users_1", "users_2_copies"]
)
ORACLE["users_superseded"] = with_chain(
    _DELTA_COPIES[1:3], "SELECT * EXCLUDE (rn) FROM u2r WHERE rn > 1", ["users_2_copies"]
)
ORACLE["users_normalize"] = with_chain(
    [], "SELECT CAST(id AS BIGINT) AS user_id, " + ", ".join(USER_ATTRS) + " FROM users", ["users"]
)
ORACLE["row_changed"] = with_chain(
    _UN,
    f"SELECT cur.user_id, {R.any_differs('cur', 'inc', USER_ATTRS)} AS row_changed "
    "FROM u1n cur JOIN u2n inc ON cur.user_id = inc.user_id",
    ["users_1", "users_2"],
)
ORACLE["users_history_delta"] = with_chain(_DELTA, "SELECT * FROM delta", ["users_1", "users_2"])
ORACLE["change_count"] = with_chain(_DELTA, "SELECT count(*) AS change_count FROM delta", ["users_1", "users_2"])

# --- cards SCD2 (written in the six-join shape, as an independent check) ---------------

_CARD_REST = [c for c in CARD_ATTRS if c != "client_id"]


def _cards_norm(src: str) -> str:
    return (f"SELECT CAST(id AS BIGINT) AS card_id, CAST(client_id AS BIGINT) AS client_id, "
            f"{', '.join(_CARD_REST)} FROM {src}")


def _versions(src: str, clock: str, batch: str) -> str:
    return (f"SELECT {', '.join(['card_id', *CARD_ATTRS])}, {clock} AS effective_from, "
            f"CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current, {batch} AS batch_id FROM {src}")


_DIFFERS = R.any_differs("cur", "inc", CARD_ATTRS)
_SCD2 = [
    ("c1n", _cards_norm("cards_1")),
    ("c2n", _cards_norm("cards_2")),
    ("init", _versions("c1n", CLOCK_1, BATCH_1)),
    ("curv", "SELECT * FROM init WHERE is_current = TRUE"),
    ("ins", _versions("(SELECT inc.* FROM c2n inc LEFT JOIN curv cur ON cur.card_id = inc.card_id "
                      "WHERE cur.card_id IS NULL AND inc.card_id IS NOT NULL)", CLOCK_2, BATCH_2)),
    ("upd", f"SELECT DISTINCT cur.card_id FROM curv cur JOIN c2n inc ON cur.card_id = inc.card_id WHERE {_DIFFERS}"),
    ("closed", f"SELECT s.* REPLACE ({CLOCK_2} AS effective_to, FALSE AS is_current) FROM init s "
               "WHERE s.is_current = TRUE AND s.card_id IN (SELECT card_id FROM upd)"),
    ("kept", "SELECT s.* FROM init s WHERE NOT EXISTS "
             "(SELECT 1 FROM upd u WHERE u.card_id = s.card_id AND s.is_current = TRUE)"),
    ("newv", _versions(f"(SELECT inc.* FROM curv cur JOIN c2n inc ON cur.card_id = inc.card_id WHERE {_DIFFERS})",
                       CLOCK_2, BATCH_2)),
    ("merged", "SELECT * FROM kept UNION ALL BY NAME SELECT * FROM closed "
               "UNION ALL BY NAME SELECT * FROM newv UNION ALL BY NAME SELECT * FROM ins"),
]
_CARDS_PAIR = ["cards_1", "cards_2"]

# D8 option: current cards absent from the snapshot are closed as well
_SCD2_CLOSE_MISSING = _SCD2[:-1] + [
    ("gone", "SELECT cur.card_id FROM curv cur WHERE cur.card_id IS NOT NULL AND NOT EXISTS "
             "(SELECT 1 FROM c2n inc WHERE inc.card_id = cur.card_id)"),
    ("closing", "SELECT card_id FROM upd UNION SELECT card_id FROM gone"),
    ("closed_all", f"SELECT s.* REPLACE ({CLOCK_2} AS effective_to, FALSE AS is_current) FROM init s "
                   "WHERE s.is_current = TRUE AND s.card_id IN (SELECT card_id FROM closing)"),
    ("kept_rest", "SELECT s.* FROM init s WHERE NOT EXISTS "
                  "(SELECT 1 FROM closing u WHERE u.card_id = s.card_id AND s.is_current = TRUE)"),
    ("merged_close", "SELECT * FROM kept_rest UNION ALL BY NAME SELECT * FROM closed_all "
                     "UNION ALL BY NAME SELECT * FROM newv UNION ALL BY NAME SELECT * FROM ins"),
]

_ALL_CARDS = [("cn", _cards_norm("cards")), ("first", _versions("cn", CLOCK_1, BATCH_1))]
ORACLE["cards_normalize"] = with_chain(_ALL_CARDS[:1], "SELECT * FROM cn", ["cards"])
ORACLE["scd2_initial"] = with_chain(_ALL_CARDS, "SELECT * FROM first", ["cards"])
ORACLE["scd2_diff"] = with_chain(
    _SCD2[:4],
    "SELECT coalesce(cur.card_id, inc.card_id) AS card_id, CASE WHEN cur.card_id IS NULL THEN 'INSERT' "
    f"WHEN inc.card_id IS NULL THEN 'ABSENT' WHEN {_DIFFERS} THEN 'UPDATE' ELSE 'UNCHANGED' END AS action "
    "FROM curv cur FULL OUTER JOIN c2n inc ON cur.card_id = inc.card_id",
    _CARDS_PAIR,
)
ORACLE["scd2_insert_rows"] = with_chain(_SCD2, "SELECT * FROM ins", _CARDS_PAIR)
ORACLE["scd2_updated_keys"] = with_chain(_SCD2, "SELECT * FROM upd", _CARDS_PAIR)
ORACLE["scd2_closed"] = with_chain(_SCD2, "SELECT * FROM closed", _CARDS_PAIR)
ORACLE["scd2_kept"] = with_chain(_SCD2, "SELECT * FROM kept", _CARDS_PAIR)
ORACLE["scd2_merge"] = with_chain(_SCD2, "SELECT * FROM merged", _CARDS_PAIR)
# D5: of repeated incoming keys the row ingested last counts, then the same merge
_SCD2_COPIES = [
    ("c1n", _cards_norm("cards_1")),
    ("c2last", "SELECT * FROM cards_2_copies QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingest_time DESC) = 1"),
    ("c2n", _cards_norm("c2last")),
] + _SCD2[2:]
ORACLE["scd2_merge_repeated_keys"] = with_chain(_SCD2_COPIES, "SELECT * FROM merged", ["cards_1", "cards_2_copies"])
ORACLE["scd2_merge_close_missing"] = with_chain(_SCD2_CLOSE_MISSING, "SELECT * FROM merged_close", _CARDS_PAIR)
ORACLE["scd2_current"] = with_chain(_SCD2, "SELECT * FROM merged WHERE is_current = TRUE", _CARDS_PAIR)
ORACLE["cards_refined"] = with_chain(
    _SCD2 + [("cr1", RS.cards_layer1("merged")), ("cr", RS.cards_layer2("cr1", CURRENT_YEAR))],
    "SELECT * FROM cr",
    _CARDS_PAIR,
)

# --- keyed patch ------------------------------------------------------------------------

ORACLE["keyed_patch"] = with_chain(
    [],
    "SELECT c.* REPLACE ("
    + ", ".join(f"CASE WHEN k.id IS NOT NULL THEN k.{x} ELSE c.{x} END AS {x}" for x in ["credit_limit", "has_chip", "card_type"])
    + ") FROM cards c LEFT JOIN card_corrections k ON c.id = k.id",
    ["cards", "card_corrections"],
)


# --- sinks (the written tables must read back as the plain query) ----------------------

ORACLE["raw_ingest_roundtrip"] = (
    f"SELECT *, 'transactions_data.csv' AS table_source, {CLOCK_1} AS ingest_time, "
    "2026 AS ingest_year, 4 AS ingest_month, 23 AS ingest_day FROM orders"
)
ORACLE["txn_index_roundtrip"] = ORACLE["txn_index"]
ORACLE["txn_index_incremental"] = ORACLE["txn_index"]
ORACLE["txn_index_emptied_day"] = with_chain(
    _index_of("transactions_again"), "SELECT * FROM transactions_again_idx", ["transactions_again"]
)
ORACLE["txn_index_reingested_day"] = with_chain(
    _index_of("transactions_left"), "SELECT * FROM transactions_left_idx", ["transactions_left"]
)
ORACLE["txn_index_occurrences"] = ORACLE["txn_index"]
ORACLE["txn_index_occurrences_emptied"] = ORACLE["txn_index_emptied_day"]
ORACLE["txn_index_occurrences_reingested"] = ORACLE["txn_index_reingested_day"]
ORACLE["txn_point_lookup_clustered"] = ORACLE["txn_point_lookup"]
ORACLE["users_refined_roundtrip"] = ORACLE["users_refined"]
ORACLE["cards_refined_roundtrip"] = ORACLE["cards_refined"]
ORACLE["transactions_append_roundtrip"] = ORACLE["transactions_dated"]
ORACLE["transactions_append_rerun"] = with_chain(
    [("tr", RS.transactions_refined("transactions_odd"))],
    "SELECT DISTINCT * FROM tr WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL",
    ["transactions_odd"],
)
ORACLE["cards_refined_rewrite"] = with_chain(
    _ALL_CARDS + [("cr1", RS.cards_layer1("first")), ("cr", RS.cards_layer2("cr1", CURRENT_YEAR))],
    "SELECT * FROM cr",
    ["cards"],
)
ORACLE["users_history_numeric"] = ORACLE["users_history_delta"]
ORACLE["corrections_roundtrip"] = ORACLE["keyed_patch"]


def _ingested(table: str, label: str, day: int) -> str:
    return (f"SELECT *, '{label}' AS table_source, TIMESTAMP '2026-04-{day} 04:22:19' AS ingest_time, "
            f"2026 AS ingest_year, 4 AS ingest_month, {day} AS ingest_day FROM {table}")


ORACLE["ingest_tables"] = " UNION ALL ".join(
    f"SELECT table_source, ingest_year, ingest_month, ingest_day, count(*) AS row_count FROM ({_ingested(t, label, day)}) GROUP BY ALL"
    for t, label in (("customer", "users_data.csv"), ("part", "cards_data.csv"), ("orders", "transactions_data.csv"))
    for day in (23, 24)
)
for _name, _table, _label in (("users", "customer", "users_data.csv"), ("cards", "part", "cards_data.csv"), ("transactions", "orders", "transactions_data.csv")):
    ORACLE[f"ingest_{_name}"] = " UNION ALL ".join(_ingested(_table, _label, day) for day in (23, 24))

_DRIFT = (
    "drifting",
    "SELECT * REPLACE (CASE WHEN ingest_day = 22 THEN CAST(CAST(replace(amount, '$', '') AS DOUBLE) AS VARCHAR) ELSE amount END AS amount, "
    "CASE WHEN ingest_day = 22 THEN NULL ELSE errors END AS errors), CASE WHEN ingest_day = 23 THEN use_chip END AS channel FROM transactions",
)
ORACLE["raw_reconciled_days"] = with_chain([_DRIFT], "SELECT * FROM drifting", ["transactions"])
ORACLE["transactions_refined_drifting"] = with_chain([_DRIFT, ("tr", RS.transactions_refined("drifting"))], "SELECT * FROM tr", ["transactions"])
ORACLE["ingest_latest_batch_catalog"] = _ingested("customer", "users_data.csv", 24)

_CLOCK_3, _BATCH_3 = "TIMESTAMP '2026-04-25 04:22:19'", "'20260425_042219'"
_BACK = (
    "delta_back",
    "SELECT cur.*, CASE WHEN inc.user_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change_type, "
    f"{_CLOCK_3} AS change_detected_at, {_BATCH_3} AS batch_id "
    "FROM u2n cur LEFT JOIN u1n inc ON cur.user_id = inc.user_id "
    f"WHERE cur.user_id IS NOT NULL AND (inc.user_id IS NULL OR {R.any_differs('cur', 'inc', USER_ATTRS)})",
)
ORACLE["users_history_append"] = with_chain(
    _DELTA + [_BACK], "SELECT * FROM delta UNION ALL SELECT * FROM delta_back", ["users_1", "users_2"]
)
ORACLE["users_history_narrow"] = ORACLE["users_history_append"]
ORACLE["users_history_unchanged_rerun"] = ORACLE["users_history_delta"]
ORACLE["users_current_refresh"] = with_chain(_UN, "SELECT * FROM u2n", ["users_1", "users_2"])
ORACLE["scd2_roundtrip"] = ORACLE["scd2_merge"]
ORACLE["scd2_split_roundtrip"] = ORACLE["scd2_merge"]
ORACLE["scd2_buckets_roundtrip"] = ORACLE["scd2_merge"]
ORACLE["scd2_bucketed_roundtrip"] = ORACLE["scd2_merge"]
ORACLE["catalog_register"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))],
    "SELECT txn_year, txn_month, txn_day, count(*) AS row_count FROM tr "
    "WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL "
    "GROUP BY txn_year, txn_month, txn_day",
    ["transactions"],
)
ORACLE["warehouse_counts"] = with_chain(
    _SCD2 + [LATEST, ("tr", RS.transactions_refined("latest"))],
    "SELECT 'users_refined' AS table_name, count(*) AS row_count FROM users "
    "UNION ALL SELECT 'cards_refined_scd2', count(*) FROM merged "
    "UNION ALL SELECT 'transactions_refined', count(*) FROM tr "
    "WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL",
    _CARDS_PAIR + ["users", "transactions"],
)
ORACLE["warehouse_users"] = ORACLE["users_refined"]
ORACLE["warehouse_cards"] = ORACLE["cards_refined"]
ORACLE["warehouse_transactions"] = with_chain(
    [LATEST, ("tr", RS.transactions_refined("latest"))],
    "SELECT * FROM tr WHERE txn_year IS NOT NULL AND txn_month IS NOT NULL AND txn_day IS NOT NULL",
    ["transactions"],
)
ORACLE["transactions_stream_roundtrip"] = ORACLE["transactions_dated"]
ORACLE["transactions_stream_reingested"] = ORACLE["transactions_dated"]


def _report(table: str, flags: list[str], more: str = "") -> str:
    """One row per count: all rows, the counts ``more`` and the true values of each flag."""
    counts = ["SELECT 'rows' AS metric, count(*) AS value FROM " + table, *([more] if more else [])]
    counts += [f"SELECT '{f}', count(*) FROM {table} WHERE {f}" for f in flags]
    return " UNION ALL ".join(counts)


_UNDATED = "txn_year IS NULL OR txn_month IS NULL OR txn_day IS NULL"
_TXN_FLAGS = [f"{c}_{kind}_flag" for c in ("transaction_id", "client_id", "card_id", "amount") for kind in ("null", "unknown")]
ORACLE["transactions_rejects"] = with_chain([("tr", RS.transactions_refined("transactions"))], f"SELECT * FROM tr WHERE {_UNDATED}", ["transactions"])
ORACLE["transactions_quality_report"] = with_chain(
    [("tr", RS.transactions_refined("transactions"))],
    f"SELECT metric, value, {BATCH_1} AS batch_id FROM ({_report('tr', _TXN_FLAGS, f"SELECT 'undated', count(*) FROM tr WHERE {_UNDATED}")})",
    ["transactions"],
)
_NULLS = ["user_id", "current_age", "retirement_age", "birth_year", "birth_month", "latitude", "longitude", "credit_score", "num_credit_cards"]
_NULLS += [f"{c}_amount" for c in ("per_capita_income", "yearly_income", "total_debt")]
_USER_FLAGS = [f"{c}_{kind}_flag" for c in _NULLS for kind in ("null", "unknown")] + [f"{c}_outlier_flag" for c in ("birth_year", "current_age", "retirement_age")]
ORACLE["users_quality_report"] = with_chain(USERS_REFINED, _report("users_refined", _USER_FLAGS), ["users"])
