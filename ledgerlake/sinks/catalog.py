"""Database and external-table registration for the refined tables.

DDL is generated from the declared StructTypes, so a table's columns, types
and order are the builder's by construction. ``USING parquet`` works on
Spark's built-in catalog as well as on a Hive metastore.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.sinks.publish import same_path, table_location
from ledgerlake.sinks.writers import table_exists_at

def ensure_database(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a location), optionally ``USE``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    if use:
        spark.sql(f"USE `{name}`")


def table_ddl(qualified_name: str, schema: T.StructType, partitions: list[str], location: str) -> str:
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {qualified_name} ({schemas.column_ddl(schema)}) "
        f"USING parquet{parts} LOCATION '{location}'"
    )


def register_table(
    spark: SparkSession,
    qualified_name: str,
    schema: T.StructType,
    partitions: list[str],
    location: str,
    recover: bool = True,
) -> bool:
    """Create the external table; register the partitions found on disk.

    Recovery lists every partition directory, so with ``recover=False`` it
    runs only when the table is new. Returns whether the table was created.
    """
    existed = spark.catalog.tableExists(qualified_name)
    if existed:
        _require_same(spark, qualified_name, schema, location)
    spark.sql(table_ddl(qualified_name, schema, partitions, location))
    if partitions and (recover or not existed) and table_exists_at(spark, location, schema):
        spark.catalog.recoverPartitions(qualified_name)
    return not existed


def _require_same(spark: SparkSession, qualified_name: str, schema: T.StructType, location: str) -> None:
    """Raise unless the table has this schema and location (``IF NOT EXISTS`` would keep the old ones)."""
    found = table_location(spark, qualified_name)
    if not same_path(found, location):
        raise ValueError(f"{qualified_name} is at {found}, not at {location}")
    kinds = [{f.name: f.dataType for f in s.fields} for s in (spark.table(qualified_name).schema, schema)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"{qualified_name} has another schema than declared")


def sync_partitions(spark: SparkSession, qualified_name: str) -> None:
    """Add partitions found on disk and drop those whose directory is gone.

    For tables rewritten through their path (a few partitions each); appends
    through ``insertInto`` register their partitions themselves.
    """
    spark.sql(f"MSCK REPAIR TABLE {qualified_name} SYNC PARTITIONS")


def register_refined_tables(
    spark: SparkSession,
    database: str,
    locations: dict[str, str],
    recover: bool = True,
    database_location: str | None = None,
) -> list[str]:
    """Create the database (if new, at ``database_location``) and the refined tables."""
    ensure_database(spark, database, database_location)
    names = []
    for name, (schema, parts) in schemas.REFINED_TABLES.items():
        if name in locations:
            qualified = f"`{database}`.`{name}`"
            register_table(spark, qualified, schema, parts, locations[name], recover=recover)
            names.append(qualified)
    return names
