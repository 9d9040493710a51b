"""Text quality rules and the column groups built from them.

Every rule works on the text form of a column, so the same rule serves
string sources and numeric ones. Parsing uses ``try_cast`` so that a value
that passes a pattern but does not fit the type (``99999999999`` as INT, a
lone ``,`` as money) gives NULL instead of failing the job under ANSI mode.

A column group is a list of aliased Columns meant to be spread into one
``select``; no group reads a column that another group of the same select
writes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The patterns that decide "unknown" and how money text is read.
# They must equal the reference's rules for the flags to agree.
# ---------------------------------------------------------------------------
INTEGER_TEXT = r"^[0-9]+$"
DECIMAL_TEXT = r"^-?[0-9]+(\.[0-9]+)?$"
CURRENCY_TEXT = r"^\$?[0-9,]+(\.[0-9]+)?$"
CURRENCY_NOISE = r"[\$,]"
CURRENCY_PREFIX = "$"
CURRENCY_CODE_PREFIXED = "USD"
CURRENCY_CODE_OTHER = "UNKNOWN"
# ---------------------------------------------------------------------------

# Our own option (not a reference rule): money text with a minus before or
# after the dollar sign, for ``signed=True``.
SIGNED_CURRENCY_TEXT = r"^(-\$?|\$-?)?[0-9,]+(\.[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def is_blank(c: Column | str) -> Column:
    """NULL, or text that is empty after trimming spaces. Never NULL itself."""
    return _col(c).isNull() | (F.trim(as_text(c)) == "")


def is_integer_text(c: Column | str) -> Column:
    """Unsigned digits only; a sign makes the value unknown."""
    return as_text(c).rlike(INTEGER_TEXT)


def is_decimal_text(c: Column | str) -> Column:
    """Optional minus, digits, optional fraction; no exponent."""
    return as_text(c).rlike(DECIMAL_TEXT)


def is_currency_text(c: Column | str, signed: bool = False) -> Column:
    """Optional ``$``, digits and commas, optional fraction; no minus unless ``signed``."""
    return as_text(c).rlike(SIGNED_CURRENCY_TEXT if signed else CURRENCY_TEXT)


def currency_amount_text(c: Column | str) -> Column:
    """Money text without ``$`` and thousands separators."""
    return F.regexp_replace(as_text(c), CURRENCY_NOISE, "")


def currency_code(c: Column | str) -> Column:
    """NULL for blank text, ``USD`` for text starting with ``$``, else ``UNKNOWN``."""
    return (
        F.when(is_blank(c), F.lit(None).cast("string"))
        .when(as_text(c).startswith(CURRENCY_PREFIX), F.lit(CURRENCY_CODE_PREFIXED))
        .otherwise(F.lit(CURRENCY_CODE_OTHER))
    )


def unknown_flag(c: Column | str, valid: Column) -> Column:
    """Present (not blank) but failing its rule."""
    return ~is_blank(c) & ~valid


def integer_group(source: Column | str, out: str, dtype: str = "int", raw: str | None = None) -> list[Column]:
    """``<raw>``, ``<out>_null_flag``, ``<out>_unknown_flag`` and typed ``<out>``."""
    src = _col(source)
    valid = is_integer_text(src)
    return [
        as_text(src).alias(raw or f"{out}_raw"),
        is_blank(src).alias(f"{out}_null_flag"),
        unknown_flag(src, valid).alias(f"{out}_unknown_flag"),
        F.when(valid, src.try_cast(dtype)).alias(out),
    ]


def decimal_group(source: Column | str, out: str, raw: str | None = None) -> list[Column]:
    """Same as :func:`integer_group` for signed decimals, typed DOUBLE."""
    src = _col(source)
    valid = is_decimal_text(src)
    return [
        as_text(src).alias(raw or f"{out}_raw"),
        is_blank(src).alias(f"{out}_null_flag"),
        unknown_flag(src, valid).alias(f"{out}_unknown_flag"),
        F.when(valid, src.try_cast("double")).alias(out),
    ]


def currency_group(source: Column | str, raw: str, amount: str, currency: str, signed: bool = False) -> list[Column]:
    """Raw text, two flags, DOUBLE amount and a currency code.

    A value failing the money pattern - blank included - gets ``UNKNOWN`` as
    its code, so the NULL branch of :func:`currency_code` is not reached here.
    ``signed=True`` accepts a minus before or after the ``$`` (``$-77.00``
    reads as -77.0) where the reference's rule makes it unknown.
    """
    src = _col(source)
    valid = is_currency_text(src, signed)
    return [
        as_text(src).alias(raw),
        is_blank(src).alias(f"{amount}_null_flag"),
        unknown_flag(src, valid).alias(f"{amount}_unknown_flag"),
        F.when(valid, currency_amount_text(src).try_cast("double")).alias(amount),
        F.when(valid, currency_code(src)).otherwise(F.lit(CURRENCY_CODE_OTHER)).alias(currency),
    ]


def has_columns(columns: list[str], required: set[str] | list[str]) -> bool:
    """All required names are present."""
    return set(required).issubset(set(columns))


def first_present(columns: list[str], *candidates: str) -> str:
    """First candidate name that exists; the last candidate otherwise."""
    for name in candidates:
        if name in columns:
            return name
    return candidates[-1]
