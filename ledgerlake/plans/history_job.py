"""Users change history job: log before images, then refresh the snapshot."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.history import before_images, changed_rows, history_delta, normalize_users, one_snapshot
from ledgerlake.session import batch_id_for, fresh_dir
from ledgerlake.sinks.publish import publish_version
from ledgerlake.sinks.writers import append_batch


def run_users_history(
    current: DataFrame,
    incoming: DataFrame,
    history_path: str,
    current_base: str,
    clock: _dt.datetime | str,
    batch_id: str | None = None,
    current_table: str | None = None,
    bucket_count: int | None = None,
    order: list[str] | None = None,
    narrow: bool = False,
) -> DataFrame:
    """Append this batch's UPDATE/DELETE before images and publish the new snapshot.

    The log is append-only, partitioned by ``batch_id``: a rerun of a batch
    replaces that batch only, also if it has no change any more. The snapshot refresh happens in every
    run, as in the reference, as a new version (see :mod:`ledgerlake.sinks.publish`).
    ``bucket_count`` (with ``current_table``) publishes the snapshot bucketed
    by ``user_id``, so the next diff shuffles only the incoming snapshot; off
    by default, because a snapshot can repeat a key and a bucketed hot key
    cannot be split by AQE the way a shuffled one can.
    ``order``: columns of ``incoming`` that decide between rows with the same
    key, in the log and in the published snapshot alike; without it a repeated
    key is an error. ``narrow`` compares keys and digests first and fetches the
    changed rows afterwards: less to shuffle where few rows change.
    Returns this batch's part of the log, read from its files.
    """
    batch_id = batch_id or batch_id_for(clock)
    cur, inc = normalize_users(current), normalize_users(incoming, keep=order)
    if narrow:
        found = changed_rows(cur, inc, order)
        path = fresh_dir(current.sparkSession, "changed_rows")
        found.write.parquet(path)
        delta = before_images(cur, current.sparkSession.read.schema(found.schema).parquet(path), clock, batch_id)
    else:
        delta = history_delta(cur, inc, detected_at=clock, batch_id=batch_id, order=order)
    append_batch(delta, history_path, batch_id)
    bucket_by = (bucket_count, "user_id") if bucket_count and current_table else None
    kept = inc.filter("user_id is null").unionByName(one_snapshot(inc, order)).select(*schemas.USER_COLUMNS)
    publish_version(kept, current_base, batch_id, table=current_table, bucket_by=bucket_by)
    logged = current.sparkSession.read.schema(delta.drop("batch_id").schema).parquet(f"{history_path.rstrip('/')}/batch_id={batch_id}")
    return logged.withColumn("batch_id", F.lit(batch_id))
