"""JDBC table reads (function form and option form), partitioned at scale.

The reference reads each table through a single connection (one task). Given
a numeric ``partition_column``, the read is split into ``num_partitions``
range queries over [lower_bound, upper_bound]; missing bounds are fetched
with one ``min``/``max`` query (a single row). Where the column's values are
not spread evenly, equal ranges make one connection read most rows;
:func:`read_jdbc_quantiles` splits at quantiles of the column instead.
Connection details are arguments - nothing is stored in the code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    fetchsize: int | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    extra: dict | None = None,
) -> dict[str, str]:
    """Reader options for one table; partitioning needs all four settings."""
    opts = {"url": url, "dbtable": table}
    for k, v in (("user", user), ("password", password), ("driver", driver), ("fetchsize", fetchsize)):
        if v is not None:
            opts[k] = str(v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def column_bounds(spark: SparkSession, url: str, table: str, column: str, **conn) -> tuple:
    """(min, max) of a column, read with one query returning one row."""
    opts = jdbc_options(url, table, **conn)
    opts.pop("dbtable")
    opts["query"] = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**opts).load().first()
    return row["lo"], row["hi"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound=None,
    upper_bound=None,
    **conn,
) -> DataFrame:
    """One table as a DataFrame; split by ``partition_column`` when given.

    ``num_partitions`` defaults to the cluster's parallelism. A table without
    rows (no bounds) is read plainly.
    """
    if partition_column is not None:
        num_partitions = num_partitions or spark.sparkContext.defaultParallelism
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = column_bounds(spark, url, table, partition_column, **conn)
        if lower_bound is None or upper_bound is None:
            partition_column = lower_bound = upper_bound = num_partitions = None
    opts = jdbc_options(
        url,
        table,
        partition_column=partition_column,
        lower_bound=lower_bound,
        upper_bound=upper_bound,
        num_partitions=num_partitions,
        **conn,
    )
    return spark.read.format("jdbc").options(**opts).load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict) -> DataFrame:
    """Function form, ``spark.read.jdbc(url, table, properties=...)``."""
    return spark.read.jdbc(url=url, table=table, properties=properties)


def quantile_bounds(keys: DataFrame, column: str, num_partitions: int, error: float = 0.001) -> list:
    """At most ``num_partitions - 1`` ascending values that part the column's rows evenly.

    One pass with mergeable summaries (``approx_percentile``); a value that
    holds several shares of the rows stands once, so its split is larger and
    the number of splits smaller.
    """
    shares = [F.lit(i / num_partitions) for i in range(1, num_partitions)]
    if not shares:
        return []
    found = keys.agg(F.approx_percentile(column, F.array(*shares), F.lit(int(1 / error))).alias("q")).first()["q"]
    return sorted(set(found or []))


def split_predicates(column: str, bounds: list) -> list[str]:
    """Conditions, one a split; every row, also one without a key, meets exactly one."""
    if not bounds:
        return ["1 = 1"]
    first = f"{column} < {bounds[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds[:-1], bounds[1:])]
    return [first, *middle, f"{column} >= {bounds[-1]}"]


def read_jdbc_quantiles(spark: SparkSession, url: str, table: str, column: str, num_partitions: int | None = None, **conn) -> DataFrame:
    """One table, split at the quantiles of a numeric column.

    The column alone is read first (an index-only scan where the database has
    one), itself in equal ranges, to find the bounds.
    """
    num_partitions = num_partitions or spark.sparkContext.defaultParallelism
    narrow = read_jdbc(spark, url, f"(SELECT {column} FROM {table}) k", column, num_partitions, **conn)
    predicates = split_predicates(column, quantile_bounds(narrow, column, num_partitions))
    properties = jdbc_options(url, table, **conn)
    return spark.read.jdbc(url=properties.pop("url"), table=properties.pop("dbtable"), predicates=predicates, properties=properties)
