"""Keyed corrections: replace some columns of the rows whose key is listed.

The reference's batch-2 scripts replace three columns for one hard-coded id
with ``when(id = k, v).otherwise(col)``. Generalised: a corrections
DataFrame (key + new values) is joined on the key and each corrected column
becomes ``CASE WHEN matched THEN new ELSE old``. The match marker is the
presence of the correction row, so a correction may set a value to NULL.
Corrections that repeat a key fail when the result is computed, unless
``order`` columns are named, by which the greatest correction wins. The left
outer join keeps every input row, streams the table side (a hot key there
stays splittable by AQE) and AQE broadcasts the corrections when they are
small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedupe import latest_per_key, refuse_repeats


def keyed_patch(df: DataFrame, corrections: DataFrame, key: str = "id", order: list[str] | None = None) -> DataFrame:
    """``df`` with the columns named in ``corrections`` replaced where the key matches.

    New values are cast to the type of the column they replace. ``order``
    columns are no new values.
    """
    fixed = [c for c in corrections.columns if c != key and c not in (order or [])]
    unknown = [c for c in fixed if c not in df.columns]
    if unknown:
        raise ValueError(f"corrections name columns the table lacks: {unknown}")
    keyed = corrections.filter(F.col(key).isNotNull())
    one = latest_per_key(keyed, key, order) if order else keyed
    fix = one.select(F.col(key).alias("_fix_key"), F.struct(*fixed).alias("_fix"))
    joined = df.join(fix, df[key] == fix["_fix_key"], "left_outer")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = []
    for c in df.columns:
        if c in fixed:
            out.append(
                F.when(F.col("_fix").isNotNull(), F.col(f"_fix.{c}").cast(types[c])).otherwise(df[c]).alias(c)
            )
        else:
            out.append(df[c])
    patched = joined.select(*out)
    return patched if order else refuse_repeats(patched, keyed, key, "corrections")
