"""Raw ingest: source tables stamped with lineage, partitioned by ingest day."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import schemas
from ledgerlake.operators.lineage import stamp_lineage
from ledgerlake.sinks import catalog
from ledgerlake.sinks.writers import write_partitioned
from ledgerlake.sources.jdbc import read_jdbc


@dataclass(frozen=True)
class IngestSpec:
    name: str
    dbtable: str
    output_path: str
    table_source: str
    fetchsize: int | None = None
    partition_column: str | None = None
    num_partitions: int | None = None


# The source tables and the labels stamped on their rows.
SOURCES = [("users", "raw_users", "users_data.csv"), ("cards", "raw_cards", "cards_data.csv"), ("transactions", "raw_transactions", "transactions_data.csv")]


def source_specs(base: str, partition_column: str | None = None, num_partitions: int | None = None, fetchsize: int | None = None) -> list[IngestSpec]:
    """The three source tables, written below ``base``; all are split on ``partition_column``."""
    return [IngestSpec(name, dbtable, f"{base}/{name}", label, fetchsize, partition_column, num_partitions) for name, dbtable, label in SOURCES]


def jdbc_reader(spark: SparkSession, url: str, **conn) -> Callable[[IngestSpec], DataFrame]:
    """Reader for :func:`run_raw_ingest` backed by partitioned JDBC reads."""

    def read(spec: IngestSpec) -> DataFrame:
        return read_jdbc(
            spark,
            url,
            spec.dbtable,
            partition_column=spec.partition_column,
            num_partitions=spec.num_partitions,
            fetchsize=spec.fetchsize,
            **conn,
        )

    return read


def run_raw_ingest(
    specs: list[IngestSpec],
    read: Callable[[IngestSpec], DataFrame],
    clock: _dt.datetime | str | None = None,
    dynamic: bool = True,
    database: str | None = None,
) -> dict[str, str]:
    """Read, stamp and write each table; returns name -> output path.

    One job per table; the loop is over the (small) table list, not data.
    Dynamic partition overwrite keeps earlier ingest days. A read that is not
    split arrives in one task; a rebalance deals its rows out to writers, as
    many as their size needs. With ``database`` each table is registered there with its
    partitions, so the latest batch is found in the catalog
    (:func:`ledgerlake.sources.parquet.latest_batch_of_table`).
    """
    out = {}
    for spec in specs:
        stamped = stamp_lineage(read(spec), spec.table_source, clock)
        rows = stamped if spec.partition_column else stamped.hint("rebalance")
        write_partitioned(rows, spec.output_path, schemas.INGEST_PARTITIONS, dynamic=dynamic)
        if database:
            spark = stamped.sparkSession
            catalog.ensure_database(spark, database)
            catalog.register_table(spark, f"`{database}`.`{spec.name}`", stamped.schema, schemas.INGEST_PARTITIONS, spec.output_path)
        out[spec.name] = spec.output_path
    return out
