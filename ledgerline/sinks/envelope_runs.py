"""E6, E8 and E9 by run: one folder for each query and run, with the schema of its rows.

    {path}/query_id=<id>/run_day=YYYY-MM-DD/run=<UTC time>/part-*.parquet   (run_ts, row_json)
    {path}/query_id=<id>/run_day=YYYY-MM-DD/run=<UTC time>/_schema          (schema of the result, JSON)

A run that is written again replaces its own folder, so a retried job leaves each row
once.  The folder names order the runs, so the newest page of a query opens
the newest run only, and older ones just as far as the page needs them, whatever the
length of the history.  The rows of a run are rebalanced before they are written: a small result is
one file.

With the schema at hand the JSON text comes back as the result's own columns and types
(a NULL is an absent key), and runs with different columns can be read as one table.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.files import file_system, path_exists
from ledgerline.operators.envelope import latest_rows
from ledgerline.sinks.results import to_envelope

_STORED = "run_ts timestamp, row_json string"
_RUN = re.compile(r"run=(\d{8}T\d{12})$")


def _moment(run_ts: _dt.datetime) -> _dt.datetime:
    return run_ts.astimezone(_dt.timezone.utc) if run_ts.tzinfo else run_ts.replace(tzinfo=_dt.timezone.utc)


def run_folder(path: str, query_id: str, run_ts: _dt.datetime) -> str:
    """The folder of one run; a datetime without a zone is taken as UTC."""
    at = _moment(run_ts)
    return f"{path.rstrip('/')}/query_id={query_id}/run_day={at:%Y-%m-%d}/run={at:%Y%m%dT%H%M%S%f}"


def write_envelope_run(df: DataFrame, query_id: str, path: str, run_ts: _dt.datetime) -> str:
    """Writes the rows of one result and run, and their schema; returns the run's folder."""
    spark, folder = df.sparkSession, run_folder(path, query_id, run_ts)
    # The result's own columns are dealt, not their JSON text, which is several times as long.
    rows = to_envelope(df.hint("rebalance"), query_id, _moment(run_ts)).drop("query_id")
    rows.write.mode("overwrite").parquet(folder)
    fs, target = file_system(spark, f"{folder}/_schema")
    out = fs.create(target, True)
    out.write(bytearray(df.schema.json().encode()))
    out.close()
    return folder


def runs_of(spark: SparkSession, path: str, query_id: str, since: _dt.date | None = None) -> list[str]:
    """Folders of the finished runs of a query, newest first (from the day ``since`` on): names are listed, no file is opened."""
    base = f"{path.rstrip('/')}/query_id={query_id}"
    if not path_exists(spark, base):
        return []
    fs, root = file_system(spark, base)
    found = []
    for day in fs.listStatus(root):
        name = day.getPath().getName()
        if name.startswith("run_day=") and (since is None or name >= f"run_day={since.isoformat()}"):
            found += [f"{base}/{name}/{run.getPath().getName()}" for run in fs.listStatus(day.getPath()) if _RUN.search(run.getPath().getName())]
    return sorted(found, key=lambda f: _RUN.search(f)[1], reverse=True)


def _read_run(spark: SparkSession, query_id: str, *folders: str) -> DataFrame:
    stored = spark.read.schema(_STORED).parquet(*folders)
    return stored.select(F.lit(query_id).alias("query_id"), "run_ts", "row_json")


def latest_page(spark: SparkSession, path: str, query_id: str, n: int = 50) -> DataFrame:
    """E8: the newest ``n`` rows of a query (JSON text), from as few runs as hold them.

    Runs are counted from their file footers, newest first, until they hold ``n`` rows.
    """
    held, folders = 0, []
    for folder in runs_of(spark, path, query_id):
        rows = _read_run(spark, query_id, folder).count()
        if rows:
            held += rows
            folders.append(folder)
        if held >= n:
            break
    if not folders:
        return spark.createDataFrame([], "row_json string")
    return latest_rows(_read_run(spark, query_id, *folders), query_id, n)


def run_schema(spark: SparkSession, folder: str) -> StructType:
    """The schema that was recorded with a run."""
    fs, path = file_system(spark, f"{folder}/_schema")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def unpack_run(spark: SparkSession, folder: str) -> DataFrame:
    """E9: the rows of one run with the columns and types of the result that was written."""
    schema = run_schema(spark, folder)
    parsed = spark.read.schema(_STORED).parquet(folder).select(F.from_json("row_json", schema).alias("r"))
    return parsed.select(*[F.col(f"r.`{name}`").alias(name) for name in schema.names])


def unpack_history(spark: SparkSession, path: str, query_id: str, since: _dt.date | None = None) -> DataFrame:
    """E9 over runs: ``run_ts`` and the typed columns of every run; a column that a run lacks is NULL."""
    frames = []
    for folder in runs_of(spark, path, query_id, since):
        at = _dt.datetime.strptime(_RUN.search(folder)[1], "%Y%m%dT%H%M%S%f").replace(tzinfo=_dt.timezone.utc)
        frames.append(unpack_run(spark, folder).select(F.lit(at).alias("run_ts"), "*"))
    if not frames:
        raise ValueError(f"no run of {query_id} under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
