"""Raw tables: the latest ingest batch, batch keys, ingest days whose columns differ."""

from __future__ import annotations

import logging
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas

LOG = logging.getLogger(__name__)


def batch_days(df: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """Distinct ingest (year, month, day) triples.

    Only partition columns are read; on a partitioned directory that is file
    metadata, not row data.
    """
    parts = parts or schemas.INGEST_PARTITIONS
    return df.select(*parts).distinct()


def latest_batch_key(df: DataFrame, parts: list[str] | None = None) -> tuple | None:
    """Greatest (year, month, day) in lexicographic order, or None if empty.

    One ``max(struct)`` aggregate: partial maxima per task, one row to the
    driver. The triple is compared as a whole, not as three maxima.
    """
    parts = parts or schemas.INGEST_PARTITIONS
    row = df.select(F.max(F.struct(*parts)).alias("k")).first()
    if row is None or row["k"] is None:
        return None
    return tuple(row["k"][p] for p in parts)


def _partition_value(text: str):
    """A partition value as SHOW PARTITIONS prints it (path-escaped) -> int, text or None."""
    if text == "__HIVE_DEFAULT_PARTITION__":
        return None
    text = unquote(text)
    try:
        return int(text)
    except ValueError:
        return text


def latest_batch_key_from_catalog(spark: SparkSession, table: str, parts: list[str] | None = None) -> tuple | None:
    """Greatest (year, month, day) among a catalog table's registered partitions.

    ``SHOW PARTITIONS`` answers from the catalog: no data file is opened,
    where the aggregate form reads every file footer. One row per partition
    comes back (days, not rows).
    """
    parts = parts or schemas.INGEST_PARTITIONS
    best = None
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = dict(item.split("=", 1) for item in row[0].split("/"))
        key = tuple(_partition_value(spec[p]) for p in parts)
        if best is None or tuple((v is not None, v) for v in key) > tuple((v is not None, v) for v in best):
            best = key
    return best


def latest_batch_of_table(spark: SparkSession, table: str, parts: list[str] | None = None) -> DataFrame:
    """Latest ingest batch of a partitioned catalog table (metadata lookup + pruned scan)."""
    parts = parts or schemas.INGEST_PARTITIONS
    df = spark.table(table)
    key = latest_batch_key_from_catalog(spark, table, parts)
    return df if key is None else _filter_key(df, parts, key)


def _filter_key(df: DataFrame, parts: list[str], key: tuple) -> DataFrame:
    cond = None
    for name, value in zip(parts, key):
        c = F.col(name).isNull() if value is None else (F.col(name) == F.lit(value))
        cond = c if cond is None else cond & c
    return df.filter(cond)


def latest_batch(df: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """Rows of the latest ingest batch; all rows when the columns are missing.

    The batch key is found first and the filter uses literals, so on a
    partitioned table the scan is pruned to one directory
    (``PartitionFilters``). An empty table gives the empty input.
    """
    parts = parts or schemas.INGEST_PARTITIONS
    if not set(parts).issubset(df.columns):
        LOG.warning("source has no ingest partition columns; reading all rows")
        return df
    key = latest_batch_key(df, parts)
    if key is None:
        return df
    LOG.info("latest batch: %s", "-".join(str(v) for v in key))
    return _filter_key(df, parts, key)


# --- ingest days whose columns differ ------------------------------------------

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, else text.

    Whole numbers widen among each other; with a DOUBLE the result is DOUBLE up
    to INT and text for BIGINT, whose values a DOUBLE does not all hold; FLOAT
    with DOUBLE is DOUBLE; two decimals give one with the digits of both, if 38
    suffice. DATE with TIMESTAMP is TIMESTAMP. Anything else is read as text.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    kinds = {type(a), type(b)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in kinds and kinds & {T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds == {T.DecimalType}:
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def reconciled_schema(schemas_: list[T.StructType]) -> T.StructType:
    """All columns of the schemas in order of appearance, each with a type that holds all its values."""
    types: dict[str, T.DataType] = {}
    for schema in schemas_:
        for f in schema.fields:
            types[f.name] = wider_type(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def read_reconciled(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame:
    """A table partitioned by ingest day, whose days may differ in their columns.

    A column that a day lacks is NULL there; one whose type differs is read
    with each day's own type and cast to :func:`wider_type`. Days with the same
    schema are read by one scan, so the plan has as many scans as there are
    schemas, and filters on the ingest columns prune days in each. Schemas come
    from one footer a day.
    """
    parts = parts or schemas.INGEST_PARTITIONS
    root = path.rstrip("/")
    days = sorted(tuple(r) for r in spark.read.parquet(root).select(*parts).distinct().collect())
    if not days:
        return spark.read.parquet(root)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for day in days:
        place = f"{root}/" + "/".join(f"{p}={v}" for p, v in zip(parts, day))
        schema = spark.read.parquet(place).schema
        groups.setdefault(schema.simpleString(), (schema, []))[1].append(place)
    whole = reconciled_schema([schema for schema, _ in groups.values()])
    out = None
    for schema, places in groups.values():
        read = T.StructType([*schema.fields, *[T.StructField(p, T.IntegerType()) for p in parts]])
        day_rows = spark.read.schema(read).option("basePath", root).parquet(*places)
        columns = [(F.col(f.name).cast(f.dataType) if f.name in schema.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in whole.fields]
        part = day_rows.select(*columns, *parts)
        out = part if out is None else out.unionByName(part)
    return out
