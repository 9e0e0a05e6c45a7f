"""Staged banking tables in Parquet (the pipeline's working copy).

The declared schema is passed to the reader, so no footer inference is done
and the column types are exactly the declared ones.  Filters on the
predicate columns (dates, types, amounts) reach the scan as PushedFilters and
only the projected columns are read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.batches import is_batch_store, read_store
from ledgerline.schemas import ENVELOPE, LOAD_ORDER, TABLE_SCHEMAS
from ledgerline.tables import BankTables


def table_paths(base: str) -> dict[str, str]:
    base = base.rstrip("/")
    return {name: f"{base}/{name}" for name in LOAD_ORDER}


def read_parquet_tables(spark: SparkSession, base: str) -> BankTables:
    """The tables under ``base``: plain folders, or the current rows of a store of batches."""
    if is_batch_store(spark, base):
        return read_store(spark, base)
    paths = table_paths(base)
    frames = {
        name: spark.read.schema(TABLE_SCHEMAS[name]).parquet(paths[name]) for name in LOAD_ORDER
    }
    return BankTables(**frames)


def read_envelope(spark: SparkSession, path: str):
    """The result envelope written by ``write_result_envelope`` (partitioned by
    query_id), columns in declared order.  A ``query_id`` filter on it prunes
    folders instead of scanning every query's rows."""
    return spark.read.schema(ENVELOPE).parquet(path).select(*[f.name for f in ENVELOPE.fields])
