"""E2 -- append ingested rows to the Parquet table store, idempotently.

Parquet has no primary key, so a second run of the same input would append
the same rows again.  Each table is anti-joined on its primary key with the
keys already stored before the append.  No row is dropped unseen:

* a row equal to a stored one is a repeat and is skipped;
* a row whose key is stored with other values is appended to
  ``{path}_conflicts`` instead (the store keeps the first version), and
  ``append_table`` returns how many there were;
* a row with a NULL key has nothing to be compared with and is appended; the
  ``primary_key_null`` check reports it.

Stored rows are read only where their key lies in the input's range of keys (pushed
to the scan: ids grow with time, so a day's rows meet the newest files).  A changed
date cannot hide a known key, as it could if only the same months were compared.
The joins are shuffle joins: the store side is never broadcast.  Rows that repeat a key *within* one input are kept and reported
by the ``primary_key_duplicate`` check.  Two concurrent writers are not
isolated from each other.

Transactions are written clustered by ``(transaction_date, transaction_id)``:
a range repartition (the unique id lets the sampler split a busy day) and a
sort within each file.  Every file and row group then covers a narrow date
range, and the Parquet min/max statistics let a pushed ``transaction_date >=
bound`` filter skip old row groups -- the date-bounded queries (last 30
days, 3/6/12 months) read recent data, not the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.files import path_exists
from ledgerline.schemas import CLUSTER_KEYS, LOAD_ORDER, PRIMARY_KEYS, TABLE_SCHEMAS
from ledgerline.sources.parquet import table_paths
from ledgerline.tables import BankTables


def append_table(df: DataFrame, path: str, table: str) -> int:
    """Appends what is new; returns the number of rows that conflict with stored ones."""
    spark = df.sparkSession
    pk = PRIMARY_KEYS[table]
    new_rows, conflicts = df, 0
    if path_exists(spark, path):
        stored = spark.read.schema(TABLE_SCHEMAS[table]).parquet(path)
        # Only stored keys inside the input's range can meet it; the file statistics skip the rest.
        low, high = df.agg(F.min(pk), F.max(pk)).first()
        stored = stored.where(F.col(pk).between(low, high)) if low is not None else stored.limit(0)
        keys_stored = stored.select(F.col(pk).alias("stored_key"))
        new_rows = df.join(keys_stored, F.col(pk) == F.col("stored_key"), "left_anti")
        old = stored.select(pk, F.struct(*stored.columns).alias("stored_row"))
        again = df.join(old, pk, "left").groupBy(*[F.col(c) for c in df.columns]).agg(
            F.count("stored_row").alias("n"),
            F.count_if(F.col("stored_row") == F.struct(*[F.col(c) for c in stored.columns])).alias("equal"),
        )
        changed = again.where("n > 0 and equal = 0").select(*df.columns)
        conflicts = changed.count()
        if conflicts:
            changed.write.mode("append").parquet(f"{path}_conflicts")
    keys = CLUSTER_KEYS.get(table)
    if keys:
        order = [F.asc_nulls_first(k) for k in keys]
        new_rows = new_rows.repartitionByRange(*order).sortWithinPartitions(*order)
    new_rows.write.mode("append").parquet(path)
    return conflicts


def append_tables(tables: BankTables, store: str) -> dict[str, str]:
    """Append customers, accounts, transactions (parents first) under ``store``."""
    paths = table_paths(store)
    frames = dict(tables.items())
    for name in LOAD_ORDER:
        append_table(frames[name], paths[name], name)
    return paths
