"""Stage-then-publish for tables a job reads and replaces.

The reference writes to a temporary path, deletes the live path and renames
the temporary one into place - a crash between the delete and the rename
leaves no table. Here every run writes a new version directory and then
points a catalog table at it (``ALTER TABLE ... SET LOCATION``): readers see
either the old or the new version, the job never overwrites what it reads,
and the written version cuts the lineage for the next run. Old versions are
left for the caller's retention policy.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def version_path(base_path: str, version: str) -> str:
    safe = re.sub(r"[^0-9A-Za-z_.-]", "_", str(version))
    return f"{base_path.rstrip('/')}/version_{safe}"


def table_location(spark: SparkSession, table: str) -> str | None:
    """Location of a catalog table, from its metadata (no file is listed)."""
    if not spark.catalog.tableExists(table):
        return None
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row[0] == "Location":
            return row[1]
    return None


def _bare(path: str) -> str:
    """A path without its scheme, for comparing a catalog location with a path."""
    return path.split("://", 1)[-1].replace("file:", "").rstrip("/")


def same_path(a: str | None, b: str) -> bool:
    return a is not None and _bare(a) == _bare(b)


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Create the external parquet table, or move it to ``path``."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")


def _staging_name(table: str, version: str) -> str:
    suffix = "__staging_" + re.sub(r"[^0-9A-Za-z_]", "_", str(version))
    return table[:-1] + suffix + "`" if table.endswith("`") else table + suffix


def publish_version(
    df: DataFrame,
    base_path: str,
    version: str,
    table: str | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> str:
    """Write ``df`` as a new version below ``base_path`` and publish it.

    Rewriting the same version (a retried job) replaces that version only.
    ``bucket_by=(n, column)`` writes the version bucketed (it needs ``table``):
    a later join on that column reads the table without shuffling it, and
    only the other side is shuffled to the n buckets. The version is written
    through a staging table (external, dropped afterwards; files stay) and
    the live table, created bucketed on the first run, is moved to it.
    Returns the version path.
    """
    path = version_path(base_path, version)
    spark = df.sparkSession
    if table and same_path(table_location(spark, table), path):
        raise ValueError(
            f"version {version} is already published as {table}; a rerun must use a new batch id"
        )
    if bucket_by is None:
        df.write.mode("overwrite").parquet(path)
        if table:
            point_table(spark, table, path)
        return path
    if table is None:
        raise ValueError("a bucketed version needs a catalog table")
    buckets, column = bucket_by
    exists = spark.catalog.tableExists(table)
    target = _staging_name(table, version) if exists else table
    (
        # one task, and so one sorted file, per bucket
        df.repartition(int(buckets), column)
        .write.mode("overwrite")
        .bucketBy(int(buckets), column)
        .sortBy(column)
        .option("path", path)
        .saveAsTable(target)
    )
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        spark.sql(f"DROP TABLE {target}")  # external: the version's files stay
    return path
