"""Whole-table JDBC reads, split into parallel range scans.

A plain ``format("jdbc")`` read is one task for the whole table.  Given a
numeric partition column (the primary key), Spark issues ``num_partitions``
range queries instead; the bounds only decide the stride, rows outside them
still land in the first/last partition.  When bounds are not given they are
read with one ``MIN/MAX`` query (a single row).  The number of ranges follows
the width of the bounds (``ROWS_PER_TASK`` ids each), not the cluster's cores.

``read_jdbc_tables`` reads the three tables as they are, each split on its
primary key; ``run_pipeline`` casts and checks them like CSV input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schemas import LOAD_ORDER, PRIMARY_KEYS
from ledgerline.tables import BankTables

# Ids in one range query; with gaps in the ids a task reads fewer rows.
ROWS_PER_TASK = 1_000_000
# Ranges at most: with very sparse ids they widen instead.
MAX_RANGES = 100_000


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    fetch_size: int = 10_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    props = dict(properties or {})
    reader = lambda: (  # noqa: E731 -- a fresh reader per read
        spark.read.format("jdbc").option("url", url).options(**props).option("fetchsize", fetch_size)
    )
    if partition_column is None:
        return reader().option("dbtable", table).load()
    if lower_bound is None or upper_bound is None:
        bounds = (
            reader()
            .option(
                "query",
                f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}",
            )
            .load()
            .first()
        )
        lower_bound = bounds["lo"] if lower_bound is None else lower_bound
        upper_bound = bounds["hi"] if upper_bound is None else upper_bound
        if bounds["lo"] is None:  # empty table
            return reader().option("dbtable", table).load()
    if num_partitions is None:
        width = int(upper_bound) - int(lower_bound) + 1
        num_partitions = min(MAX_RANGES, max(1, -(-width // rows_per_task)))
    return (
        reader()
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", int(lower_bound))
        .option("upperBound", int(upper_bound) + 1)
        .option("numPartitions", int(num_partitions))
        .load()
    )


def read_jdbc_tables(
    spark: SparkSession, url: str, properties: dict | None = None, rows_per_task: int = ROWS_PER_TASK
) -> BankTables:
    """The three tables of one database, in the types that it declares."""
    frames = {
        name: read_jdbc_table(
            spark, url, name, properties, partition_column=PRIMARY_KEYS[name], rows_per_task=rows_per_task
        )
        for name in LOAD_ORDER
    }
    return BankTables(**frames)
