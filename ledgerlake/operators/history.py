"""Users change history: before images of updated and deleted rows.

Two full snapshots are compared on ``user_id``. Inserts are not logged, so
the comparison is ``current LEFT OUTER JOIN incoming``: a current row without
a partner is a DELETE, one whose partner differs in any attribute (NULL-safe)
is an UPDATE. Left outer keeps the current side splittable by AQE's skew-join
handling should one key hold many current rows.

An incoming snapshot that repeats a key fails when the result is computed. If
repeats are expected, name ``order`` columns: the row that is greatest by them
is compared, and :func:`ledgerlake.operators.dedupe.superseded_rows` gives the
others. Without ``order`` the join reads the incoming rows as they are, so AQE
can split a hot key on the current side. Rows with a NULL key take no part, as
they could match nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.derived import row_digest, same_values
from ledgerlake.functions.quality import first_present
from ledgerlake.operators.dedupe import latest_per_key, refuse_repeats
from ledgerlake.operators.lineage import clock_column

KEY = "user_id"
ATTRIBUTES = schemas.USER_COLUMNS[1:]


def normalize_users(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``id`` (or ``user_id`` after a refresh) as a long ``user_id`` + 13 attributes as text.

    ``keep``: further columns to carry along, such as an order column.
    """
    key = first_present(df.columns, "id", "user_id")
    return df.select(F.col(key).try_cast("long").alias(KEY), *[F.col(c).cast("string").alias(c) for c in ATTRIBUTES], *[c for c in keep or [] if c not in schemas.USER_COLUMNS])


def one_snapshot(incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows with a key; one per key, greatest by ``order``, if that is given."""
    keyed = incoming.filter(F.col(KEY).isNotNull())
    return latest_per_key(keyed, KEY, order) if order else keyed


def _checked(result: DataFrame, incoming: DataFrame, order: list[str] | None) -> DataFrame:
    return result if order else refuse_repeats(result, incoming.filter(F.col(KEY).isNotNull()), KEY, "incoming snapshot")


def classify_changes(current: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Current rows with ``change_type`` UPDATE, DELETE or NULL (unchanged)."""
    inc = one_snapshot(incoming, order).select(F.col(KEY).alias("_k"), F.struct(*ATTRIBUTES).alias("inc"))
    cur = current.filter(F.col(KEY).isNotNull()).alias("cur")
    joined = cur.join(inc, F.col(f"cur.{KEY}") == F.col("_k"), "left_outer")
    change_type = (
        F.when(F.col("inc").isNull(), F.lit("DELETE"))
        .when(~same_values("cur", "inc", ATTRIBUTES), F.lit("UPDATE"))
    )
    return joined.select(*[F.col(f"cur.{c}").alias(c) for c in schemas.USER_COLUMNS], change_type.alias("change_type"))


def row_changed(current: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Keys present in both snapshots with a NULL-safe "any attribute differs" flag."""
    inc = one_snapshot(incoming, order).alias("inc")
    cur = current.filter(F.col(KEY).isNotNull()).alias("cur")
    joined = cur.join(inc, F.col(f"cur.{KEY}") == F.col(f"inc.{KEY}"), "inner")
    flags = joined.select(F.col(f"cur.{KEY}").alias(KEY), (~same_values("cur", "inc", ATTRIBUTES)).alias("row_changed"))
    return _checked(flags, incoming, order)


def history_delta(
    current: DataFrame,
    incoming: DataFrame,
    detected_at: _dt.datetime | str | None = None,
    batch_id: str = "",
    order: list[str] | None = None,
) -> DataFrame:
    """Before images of updated and deleted users with change metadata.

    Columns: the 14 business columns, ``change_type``, ``change_detected_at``
    and ``batch_id``. ``order``: what decides between rows that repeat an
    incoming key; without it a repeated key is an error.
    """
    classified = classify_changes(current, incoming, order)
    delta = classified.filter(F.col("change_type").isNotNull()).select(
        *schemas.USER_COLUMNS,
        "change_type",
        clock_column(detected_at).alias("change_detected_at"),
        F.lit(batch_id).alias("batch_id"),
    )
    return _checked(delta, incoming, order)


def changed_rows(current: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(user_id, digest, change_type) of the current rows that a delta logs, each once.

    Found from keys and digests alone, so the attributes of unchanged rows,
    which are most of a snapshot, are never shuffled. Rows are equal where
    their SHA-256 digests are.
    """
    digest = row_digest(ATTRIBUTES)
    inc = one_snapshot(incoming, order).select(F.col(KEY).alias("_k"), digest.alias("_inc"))
    cur = current.filter(F.col(KEY).isNotNull()).select(KEY, digest.alias("digest"))
    change_type = F.when(F.col("_inc").isNull(), F.lit("DELETE")).when(F.col("_inc") != F.col("digest"), F.lit("UPDATE"))
    found = cur.join(inc, F.col(KEY) == F.col("_k"), "left_outer").select(KEY, "digest", change_type.alias("change_type"))
    return _checked(found.filter(F.col("change_type").isNotNull()).distinct(), incoming, order)


def before_images(current: DataFrame, changed: DataFrame, detected_at: _dt.datetime | str | None = None, batch_id: str = "") -> DataFrame:
    """The delta of :func:`history_delta` from the rows that :func:`changed_rows` found.

    ``changed`` is best a written table: where it is small, Spark knows so and
    broadcasts it, and the current rows are not shuffled at all.
    """
    rows = current.filter(F.col(KEY).isNotNull()).withColumn("digest", row_digest(ATTRIBUTES))
    return rows.join(changed, [KEY, "digest"]).select(
        *schemas.USER_COLUMNS,
        "change_type",
        clock_column(detected_at).alias("change_detected_at"),
        F.lit(batch_id).alias("batch_id"),
    )


def change_count(delta: DataFrame) -> DataFrame:
    """Number of logged changes as a one-row DataFrame (lazy; no driver action)."""
    return delta.agg(F.count(F.lit(1)).alias("change_count"))
