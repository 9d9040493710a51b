"""Session helpers.

Configuration belongs to the caller: the library reads settings from the
session it is given and never changes them, with one exception - when a local
session (as in tests) names no shared folder for lineage cuts, a fresh one is
created and registered as the checkpoint directory.
"""

from __future__ import annotations

import datetime as _dt
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Shared folder the cluster names in ``spark.checkpoint.dir``.

    Written tables that cut lineage go below this folder. Without it only a
    local session gets a folder of its own; on a cluster, where other machines
    would not see that folder, this raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    own = tempfile.mkdtemp(prefix="ledgerlake-shared-")
    context.setCheckpointDir(own)
    return own


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never used directory below the shared folder."""
    return f"{shared_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


def as_timestamp_text(clock: _dt.datetime | str) -> str:
    """Clock argument as ``yyyy-MM-dd HH:mm:ss`` text, read in the session zone."""
    if isinstance(clock, _dt.datetime):
        return clock.strftime("%Y-%m-%d %H:%M:%S")
    return str(clock)


def batch_id_for(clock: _dt.datetime | str) -> str:
    """Batch id in the form ``yyyyMMdd_HHmmss`` derived from a clock value."""
    if not isinstance(clock, _dt.datetime):
        clock = _dt.datetime.strptime(str(clock), "%Y-%m-%d %H:%M:%S")
    return clock.strftime("%Y%m%d_%H%M%S")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake"):
    """A local session for tests and the benchmark (never used by the library)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
