"""Copy-on-write publication of partitioned tables.

A version of a table names, for each partition, the directory that holds it.
A batch writes only the partitions it changes, below its own version
directory; all others stay where an earlier batch wrote them. Nothing that a
reader or the job itself reads is overwritten.

Two things are kept for a version: a manifest (one small row per partition,
parquet below ``<base>/manifests``) and a catalog table whose partitions point
at the directories. The published name is a view over that table, and
replacing the view is the only step readers see, so they find either the old
or the new version of all partitions. Rows per manifest: one a partition,
which is what the driver handles.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.sinks.catalog import table_ddl

VERSION, PARTS = "ledgerlake.version", "ledgerlake.parts"
_MANIFEST = "partition string, version string"


def _safe(version: str) -> str:
    if not re.fullmatch(r"[0-9A-Za-z_.-]+", version):
        raise ValueError(f"version {version!r} may hold letters, digits, '.', '_' and '-' only")
    return version


def version_dir(base_path: str, version: str) -> str:
    return f"{base_path.rstrip('/')}/version_{_safe(version)}"


def _manifest_path(base_path: str, version: str) -> str:
    return f"{base_path.rstrip('/')}/manifests/{_safe(version)}"


def partition_name(columns: list[str], values) -> str:
    """``a=1/b=2``, the directory of a partition below its version."""
    return "/".join(f"{c}={v}" for c, v in zip(columns, values))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def published(spark: SparkSession, table: str, base_path: str) -> tuple[str | None, dict[str, str]]:
    """(version, version of each partition) of the published table; (None, {}) without one."""
    if not spark.catalog.tableExists(table):
        return None, {}
    version = _properties(spark, table)[VERSION]
    rows = spark.read.schema(_MANIFEST).parquet(_manifest_path(base_path, version)).collect()
    return version, {r["partition"]: r["version"] for r in rows}


def _parts_name(table: str, version: str) -> str:
    suffix = "__" + re.sub(r"[^0-9A-Za-z_]", "_", version)
    return table[:-1] + suffix + "`" if table.endswith("`") else table + suffix


def publish_partitions(
    rows: DataFrame,
    table: str,
    base_path: str,
    version: str,
    schema: T.StructType,
    columns: list[str],
    replaced: list[tuple],
    properties: dict[str, str] | None = None,
    options: dict[str, str] | None = None,
) -> dict[str, str]:
    """Write ``rows`` as the new content of the partitions ``replaced`` and publish the table.

    ``schema`` ends with the integer partition ``columns``; ``rows`` lie in
    partitions of ``replaced`` (others raise), and one without rows leaves the
    table. A version that failed before it was published is written anew.
    ``properties`` are kept with the published name; ``options`` go to the
    parquet writer. Returns the version of each partition.
    """
    spark = rows.sparkSession
    before, places = published(spark, table, base_path)
    if before == version:
        raise ValueError(f"version {version} is already published as {table}; a rerun must use a new batch id")
    path = version_dir(base_path, version)
    names = {partition_name(columns, v) for v in replaced}
    rows.select(*[f.name for f in schema.fields]).write.mode("overwrite").options(**(options or {})).partitionBy(*columns).parquet(path)
    files = spark.read.schema(schema).parquet(path).inputFiles()  # listed, not read
    written = {"/".join(f.split("/")[-len(columns) - 1 : -1]) for f in files}
    if written - names:
        raise ValueError(f"rows lie outside of the replaced partitions: {', '.join(sorted(written - names)[:5])}")
    places = {p: v for p, v in places.items() if p not in names} | dict.fromkeys(written, version)
    _point(spark, table, base_path, version, schema, columns, places, properties or {})
    return places


def _point(spark, table: str, base_path: str, version: str, schema: T.StructType, columns: list[str], places: dict[str, str], properties: dict[str, str]) -> None:
    """Write the manifest, register the partitions and replace the view."""
    manifest = spark.createDataFrame(sorted(places.items()), _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(_manifest_path(base_path, version))
    before = _properties(spark, table).get(PARTS) if spark.catalog.tableExists(table) else None
    parts = _parts_name(table, version)
    spark.sql(f"DROP TABLE IF EXISTS {parts}")  # of an attempt that failed; files stay
    spark.sql(table_ddl(parts, schema, columns, f"{base_path.rstrip('/')}/version_{_safe(version)}"))
    if places:
        spec = lambda p: ", ".join(f"`{k}`={v}" for k, v in (x.split("=") for x in p.split("/")))
        each = [f"PARTITION ({spec(p)}) LOCATION '{version_dir(base_path, v)}/{p}'" for p, v in sorted(places.items())]
        spark.sql(f"ALTER TABLE {parts} ADD IF NOT EXISTS {' '.join(each)}")
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    kept = ", ".join(f"'{k}' = '{v}'" for k, v in (properties | {VERSION: version, PARTS: parts}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({kept}) AS SELECT {names} FROM {parts}")
    if before and before != parts:
        spark.sql(f"DROP TABLE IF EXISTS {before}")
