"""Operators against brute-force models on random inputs.

History delta and SCD2 merge: keys and values come from tiny domains (NULL
included) so that duplicates, NULL keys, NULL attributes, inserts, updates
and deletes all occur. Quality groups: short random texts over digits, signs,
separators and letters, checked against the fixed rules written in Python
(no newlines, where Java's ``$`` and Python's differ).
"""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake import schemas
from ledgerlake.functions import quality as Q
from ledgerlake.operators import history as H
from ledgerlake.operators import scd2 as S

KEYS = st.one_of(st.none(), st.integers(0, 5))
VALS = st.sampled_from([None, "a", "b"])
ROW = st.tuples(KEYS, VALS, VALS)
T1, T2 = dt.datetime(2026, 4, 23), dt.datetime(2026, 4, 24)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _order(v):
    return (v is not None, v)


def one_per_key(rows):
    """Model of the deterministic survivor: greatest attribute tuple, NULL lowest."""
    best = {}
    for r in rows:
        if r[0] is None:
            continue
        if r[0] not in best or tuple(map(_order, r[1:])) > tuple(map(_order, best[r[0]][1:])):
            best[r[0]] = r
    return best


# --- users history --------------------------------------------------------------------

U_ATTRS = schemas.USER_COLUMNS[1:]
U_DDL = "id long, " + ", ".join(f"{c} string" for c in U_ATTRS)


def users_df(spark, rows):
    full = [(k, a, b, *(["x"] * (len(U_ATTRS) - 2))) for k, a, b in rows]
    return H.normalize_users(spark.createDataFrame(full, U_DDL))


def model_history(cur, inc):
    best = one_per_key(inc)
    out = []
    for c in cur:
        if c[0] is None:
            continue
        i = best.get(c[0])
        if i is None:
            out.append((c[0], c[1], c[2], "DELETE"))
        elif c[1:] != i[1:]:  # Python equality treats None == None, as <=> does
            out.append((c[0], c[1], c[2], "UPDATE"))
    return sorted(out, key=repr)


@SETTINGS
@given(cur=st.lists(ROW, max_size=8), inc=st.lists(ROW, max_size=8))
def test_history_matches_model(spark, cur, inc):
    got = H.history_delta(users_df(spark, cur), users_df(spark, inc), T2, "b", order=U_ATTRS)
    got = sorted(((r["user_id"], r["current_age"], r["retirement_age"], r["change_type"]) for r in got.collect()), key=repr)
    assert got == model_history(cur, inc)


# --- cards SCD2 -----------------------------------------------------------------------------

C_REST = ["x"] * (len(schemas.CARD_COLUMNS) - 4)
C_DDL = "card_id long, client_id long, " + ", ".join(f"{c} string" for c in schemas.CARD_COLUMNS[2:])
V_DDL = C_DDL + ", effective_from timestamp, effective_to timestamp, is_current boolean, batch_id string"
FLAGS = st.sampled_from([True, True, False, None])


def versions_df(spark, rows):
    return spark.createDataFrame(
        [(k, 1, a, b, *C_REST, T1, None if cur else T1, cur, "b1") for (k, a, b), cur in rows], V_DDL
    )


def cards_df(spark, rows):
    return S.normalize_cards(spark.createDataFrame([(k, 1, a, b, *C_REST) for k, a, b in rows], C_DDL))


def model_merge(existing, inc):
    best = one_per_key(inc)
    out, current_keys = [], set()
    for (k, a, b), cur in existing:
        row = (k, a, b, T1, None if cur else T1, cur, "b1")
        if cur is not True or k is None:
            out.append(row)
            continue
        current_keys.add(k)
        i = best.get(k)
        if i is not None and (a, b) != i[1:]:
            out.append((k, a, b, T1, T2, False, "b1"))
            out.append((k, i[1], i[2], T2, None, True, "b2"))
        else:
            out.append(row)
    for k, i in best.items():
        if k not in current_keys:
            out.append((k, i[1], i[2], T2, None, True, "b2"))
    return sorted(out, key=repr)


@SETTINGS
@given(
    existing=st.lists(st.tuples(ROW, FLAGS), max_size=8).filter(
        # the dimension's own invariant: at most one current version per key
        lambda rows: len([r for r, c in rows if c is True and r[0] is not None])
        == len({r[0] for r, c in rows if c is True and r[0] is not None})
    ),
    inc=st.lists(ROW, max_size=8),
)
def test_scd2_merge_matches_model(spark, existing, inc):
    got = S.merge(versions_df(spark, existing), cards_df(spark, inc), T2, "b2", order=schemas.CARD_COLUMNS[1:])
    got = sorted(
        ((r["card_id"], r["card_brand"], r["card_type"], r["effective_from"], r["effective_to"], r["is_current"], r["batch_id"])
         for r in got.collect()),
        key=repr,
    )
    assert got == model_merge(existing, inc)


# --- quality rules --------------------------------------------------------------------------

TEXT = st.one_of(st.none(), st.text(alphabet="0123456789-$,. a", max_size=8))


def _blank(s):
    return s is None or s.strip(" ") == ""


def _int_or_none(s):
    v = int(s)
    return v if -(2**31) <= v < 2**31 else None


def model_integer(s):
    valid = s is not None and re.fullmatch(r"[0-9]+", s) is not None
    return (_blank(s), not _blank(s) and not valid, _int_or_none(s) if valid else None)


def model_decimal(s):
    valid = s is not None and re.fullmatch(r"-?[0-9]+(\.[0-9]+)?", s) is not None
    return (_blank(s), not _blank(s) and not valid, float(s) if valid else None)


def model_currency(s):
    valid = s is not None and re.fullmatch(r"\$?[0-9,]+(\.[0-9]+)?", s) is not None
    amount = None
    if valid:
        digits = s.replace("$", "").replace(",", "")
        amount = float(digits) if digits else None
    code = ("USD" if s.startswith("$") else "UNKNOWN") if valid else "UNKNOWN"
    return (_blank(s), not _blank(s) and not valid, amount, code)


@SETTINGS
@given(values=st.lists(TEXT, min_size=1, max_size=30))
def test_quality_groups_match_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select(
        "i",
        *Q.integer_group("v", "n", "int"),
        *Q.decimal_group("v", "d", raw="d_raw"),
        *Q.currency_group("v", "c_raw", "c", "c_code"),
    ).collect()
    for r in sorted(out, key=lambda r: r["i"]):
        s = values[r["i"]]
        assert (r["n_null_flag"], r["n_unknown_flag"], r["n"]) == model_integer(s), s
        assert (r["d_null_flag"], r["d_unknown_flag"], r["d"]) == model_decimal(s), s
        assert (r["c_null_flag"], r["c_unknown_flag"], r["c"], r["c_code"]) == model_currency(s), s
        assert r["n_raw"] == s and r["c_raw"] == s
