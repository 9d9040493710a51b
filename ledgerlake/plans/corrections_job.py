"""Apply keyed corrections to a snapshot and write it as a new snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.patch import keyed_patch
from ledgerlake.sinks.writers import write_partitioned


def apply_corrections(spark: SparkSession, source_path: str, corrections: DataFrame, output_path: str, key: str = "id") -> DataFrame:
    """Read a snapshot, replace the corrected columns by key, overwrite ``output_path``.

    ``output_path`` must differ from ``source_path`` (the job reads the source
    while it writes). Returns the corrected snapshot (lazy).
    """
    if output_path.rstrip("/") == source_path.rstrip("/"):
        raise ValueError("output_path must differ from source_path")
    patched = keyed_patch(spark.read.parquet(source_path), corrections, key=key)
    write_partitioned(patched, output_path, partition_by=None, mode="overwrite")
    return patched
