"""Incremental CSV ingest with Structured Streaming (E1 + E2 as a stream).

The daily ingest appends the three CSV tables to the store.  Run as a batch,
a second run re-reads every file.  Here each table is a file stream over its
landing folder (``{landing}/customers/``, ``accounts/``, ``transactions/``):

* the file source records processed files in the query checkpoint, so a
  rerun only reads files that arrived since;
* ``trigger(availableNow=True)`` drains what is there and stops, so the job
  keeps its daily, scheduled shape;
* each micro-batch is published as one batch of the store (``ledgerline.batches``), named after
  checkpoint and epoch, so a batch replayed after a failure (``foreachBatch`` is
  at-least-once) finds its marker, or overwrites what it had begun;
* malformed records go to the batch's quarantine with file and reason, and are counted there;
* tables run parents first, each to completion, so accounts never land
  before their customers' batch.

Checkpoints live under the shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ledgerline.batches import publish_batch
from ledgerline.functions.casting import cast_to_schema
from ledgerline.schemas import LOAD_ORDER, TABLE_SCHEMAS
from ledgerline.session import checkpoint_dir
from ledgerline.sources.csv import CSV_READ_OPTIONS, REJECTED, reject_struct, rejects, restore_empty_strings, sound, text_schema
from ledgerline.sources.parquet import table_paths


def csv_stream(spark: SparkSession, folder: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The records of ``folder``: declared columns as text, and ``rejected``."""
    schema = TABLE_SCHEMAS[table]
    reader = spark.readStream.schema(text_schema(schema, malformed=True)).options(**CSV_READ_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    read = reader.csv(folder).withColumn(REJECTED, reject_struct(schema.names))
    return restore_empty_strings(read, schema, REJECTED)


def _publish(table: str, store: str, checkpoint: str):
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        typed = cast_to_schema(sound(batch), TABLE_SCHEMAS[table])
        publish_batch(
            batch.sparkSession, {table: typed}, store, f"{table}-{stream}-{epoch_id:08d}", rejected={table: rejects(batch)}
        )

    return handle


def ingest_landing(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint_base: str | None = None,
    max_files_per_trigger: int | None = None,
) -> dict[str, str]:
    """Drain new CSV files of each table into the store of batches; returns store paths."""
    base = (checkpoint_base or f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-ingest").rstrip("/")
    landing = landing.rstrip("/")
    paths = table_paths(store)
    for table in LOAD_ORDER:
        query = (
            csv_stream(spark, f"{landing}/{table}", table, max_files_per_trigger)
            .writeStream.foreachBatch(_publish(table, store, f"{base}/{table}"))
            .option("checkpointLocation", f"{base}/{table}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return paths
