"""Cards type 2 slowly changing dimension.

A version row carries the 13 business columns plus ``effective_from``,
``effective_to`` (NULL while current), ``is_current`` and ``batch_id``.

The merge of an incoming snapshot is one full outer join of the current
versions with the incoming rows on ``card_id``; each joined pair becomes an
array of output rows chosen by CASE and is flattened with ``inline``:

* incoming only           -> [new version]
* both, attributes differ -> [closed old version, new version]
* current only / same     -> [current version unchanged]

Versions that are not current (``NOT (is_current <=> true)``, so NULL
survives) and current rows with a NULL key bypass the join untouched. The
old version's ``effective_to`` and the new version's ``effective_from`` are
the same clock value, so intervals are half-open without gaps.

A key that repeats among the incoming rows fails when the result is computed,
unless ``order`` columns are named: then the row greatest by them is merged
(:func:`ledgerlake.operators.dedupe.superseded_rows` gives the others). Two
current versions of one key fail in any case. So the join is one-to-one, and
no key can skew it or multiply rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.derived import row_digest, same_values
from ledgerlake.functions.quality import first_present, has_columns
from ledgerlake.operators.dedupe import latest_per_key, refuse_repeats
from ledgerlake.operators.lineage import clock_column

KEY = "card_id"
ATTRIBUTES = schemas.CARD_COLUMNS[1:]
COLUMNS = schemas.CARD_COLUMNS + schemas.SCD2_META
TEXT_COLUMNS = schemas.CARD_COLUMNS[2:]


def normalize_cards(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Both ids as long, the other 11 business columns as text.

    The key may be called ``id`` or ``card_id``. ``keep``: further columns to
    carry along, such as an order column.
    """
    key = first_present(df.columns, "id", "card_id")
    needed = [key, "client_id", *TEXT_COLUMNS]
    if not has_columns(df.columns, needed):
        absent = ", ".join(c for c in needed if c not in df.columns)
        raise ValueError(f"a cards table lacks {absent}; it has {', '.join(df.columns)}")
    ids = [F.col(source).try_cast("long").alias(name) for source, name in ((key, KEY), ("client_id", "client_id"))]
    return df.select(*ids, *[F.col(c).cast("string").alias(c) for c in TEXT_COLUMNS], *[c for c in keep or [] if c not in schemas.CARD_COLUMNS])


def one_batch(incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows with a key; one per key, greatest by ``order``, if that is given."""
    keyed = incoming.filter(F.col(KEY).isNotNull())
    return (latest_per_key(keyed, KEY, order) if order else keyed).select(*schemas.CARD_COLUMNS)


def _checked(result: DataFrame, incoming: DataFrame, order: list[str] | None) -> DataFrame:
    return result if order else refuse_repeats(result, incoming.filter(F.col(KEY).isNotNull()), KEY, "incoming cards")


def initial_versions(
    incoming: DataFrame,
    effective_at: _dt.datetime | str | None = None,
    batch_id: str = "",
    order: list[str] | None = None,
) -> DataFrame:
    """First load: every incoming row becomes a current version.

    Repeated keys are handled as in the merge, so the dimension starts with at
    most one current version per key; rows with a NULL key are loaded as they
    are, as in the reference.
    """
    unkeyed = incoming.select(*schemas.CARD_COLUMNS).filter(F.col(KEY).isNull())
    versions = one_batch(incoming, order).unionByName(unkeyed).select(
        *schemas.CARD_COLUMNS,
        clock_column(effective_at).alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(batch_id).alias("batch_id"),
    )
    return _checked(versions, incoming, order)


def _is_current() -> Column:
    return F.col("is_current").eqNullSafe(F.lit(True))


def diff(existing: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Current versions FULL OUTER incoming rows, with an ``action`` per pair.

    Columns: ``card_id``, ``cur`` (struct of the version, NULL if absent),
    ``inc`` (struct of the incoming row, NULL if absent) and ``action`` one
    of INSERT, UPDATE, UNCHANGED, ABSENT.
    """
    cur = existing.select(*COLUMNS).filter(_is_current() & F.col(KEY).isNotNull()).select(KEY, F.struct(*COLUMNS).alias("cur"))
    inc = one_batch(incoming, order).select(KEY, F.struct(*schemas.CARD_COLUMNS).alias("inc"))
    action = (
        F.when(F.col("cur").isNull(), F.lit("INSERT"))
        .when(F.col("inc").isNull(), F.lit("ABSENT"))
        .when(same_values("cur", "inc", ATTRIBUTES), F.lit("UNCHANGED"))
        .otherwise(F.lit("UPDATE"))
    )
    pairs = cur.join(inc, KEY, "full_outer").select(KEY, "cur", "inc", action.alias("action"))
    return _checked(refuse_repeats(pairs, cur, KEY, "current versions"), incoming, order)


def changed_keys(existing: DataFrame, incoming: DataFrame, close_missing: bool = False, order: list[str] | None = None) -> DataFrame:
    """(card_id, action) of the pairs a merge changes, found from keys and digests alone.

    INSERT and UPDATE, and ABSENT with ``close_missing``. Only the key and 32
    bytes of each row are shuffled; the rows themselves are not.
    """
    digest = row_digest(ATTRIBUTES).alias("digest")
    cur = existing.filter(_is_current() & F.col(KEY).isNotNull()).select(KEY, digest)
    inc = one_batch(incoming, order).select(KEY, digest)
    pairs = cur.withColumnRenamed("digest", "cur").join(inc.withColumnRenamed("digest", "inc"), KEY, "full_outer")
    action = F.when(F.col("cur").isNull(), F.lit("INSERT")).when(F.col("inc").isNull(), F.lit("ABSENT")).when(F.col("cur") != F.col("inc"), F.lit("UPDATE"))
    wanted = ["INSERT", "UPDATE", *(["ABSENT"] if close_missing else [])]
    found = pairs.select(KEY, action.alias("action")).filter(F.col("action").isin(wanted))
    return _checked(refuse_repeats(found, cur, KEY, "current versions"), incoming, order)


def _new_version(effective_at, batch_id: str) -> Column:
    return F.struct(
        *[F.col(f"inc.{c}").alias(c) for c in schemas.CARD_COLUMNS],
        clock_column(effective_at).alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(batch_id).alias("batch_id"),
    )


def _closed_version(effective_at) -> Column:
    return F.struct(
        *[F.col(f"cur.{c}").alias(c) for c in schemas.CARD_COLUMNS],
        F.col("cur.effective_from").alias("effective_from"),
        clock_column(effective_at).alias("effective_to"),
        F.lit(False).alias("is_current"),
        F.col("cur.batch_id").alias("batch_id"),
    )


def _as_is() -> Column:
    return F.struct(*[F.col(f"cur.{c}").alias(c) for c in COLUMNS])


def _bypass(existing: DataFrame) -> DataFrame:
    """Rows the merge never touches: history, NULL ``is_current``, NULL keys."""
    existing = existing.select(*COLUMNS)
    return existing.filter(~_is_current() | F.col(KEY).isNull())


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    effective_at: _dt.datetime | str | None = None,
    batch_id: str = "",
    close_missing: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """New state of the dimension after one incoming snapshot.

    Cards absent from the snapshot stay current, as in the reference;
    ``close_missing=True`` closes them instead.
    """
    d = diff(existing, incoming, order)
    new, closed, same = _new_version(effective_at, batch_id), _closed_version(effective_at), _as_is()
    absent = F.array(closed) if close_missing else F.array(same)
    rows = (
        F.when(F.col("action") == "INSERT", F.array(new))
        .when(F.col("action") == "UPDATE", F.array(closed, new))
        .when(F.col("action") == "ABSENT", absent)
        .otherwise(F.array(same))
    )
    merged = d.select(F.inline(rows))
    return merged.unionByName(_bypass(existing))


# Parts of the merge, each a view of the same single join ------------------------

def current_versions(scd2: DataFrame) -> DataFrame:
    """Rows with ``is_current = true`` (NULL excluded)."""
    return scd2.filter(F.col("is_current") == F.lit(True))


def insert_rows(existing: DataFrame, incoming: DataFrame, effective_at=None, batch_id: str = "") -> DataFrame:
    """New versions for keys with no current version."""
    d = diff(existing, incoming).filter(F.col("action") == "INSERT")
    return d.select(_new_version(effective_at, batch_id).alias("v")).select("v.*")


def updated_keys(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Distinct keys whose current version differs from the incoming row."""
    return diff(existing, incoming).filter(F.col("action") == "UPDATE").select(KEY).distinct()


def closed_versions(existing: DataFrame, incoming: DataFrame, effective_at=None) -> DataFrame:
    """Old versions of updated keys, closed at ``effective_at``."""
    d = diff(existing, incoming).filter(F.col("action") == "UPDATE")
    return d.select(_closed_version(effective_at).alias("v")).select("v.*")


def kept_versions(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows the merge leaves as they are."""
    d = diff(existing, incoming).filter(F.col("cur").isNotNull() & (F.col("action") != "UPDATE"))
    return d.select("cur.*").unionByName(_bypass(existing))
