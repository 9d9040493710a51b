"""Lineage stamp for raw tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import as_timestamp_text


def clock_column(clock: _dt.datetime | str | None):
    """The clock argument as a TIMESTAMP column; ``None`` means the query's now."""
    if clock is None:
        return F.current_timestamp()
    return F.lit(as_timestamp_text(clock)).cast("timestamp")


def stamp_lineage(df: DataFrame, table_source: str, ingest_time: _dt.datetime | str | None = None) -> DataFrame:
    """Add ``table_source``, ``ingest_time`` and its year, month and day.

    One projection; the clock is an argument so that reruns give the same
    partition values (``None`` uses the query's current timestamp, a single
    value for the whole query).
    """
    ts = clock_column(ingest_time)
    return df.select(
        "*",
        F.lit(table_source).alias("table_source"),
        ts.alias("ingest_time"),
        F.year(ts).alias("ingest_year"),
        F.month(ts).alias("ingest_month"),
        F.dayofmonth(ts).alias("ingest_day"),
    )
