"""Result sinks: one Parquet folder per query, and the generic JSON-row envelope."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_result_parquet(
    df: DataFrame,
    base: str,
    name: str,
    mode: str = "overwrite",
    single_file: bool = False,
    sorted_output: bool = True,
) -> str:
    """E5 -- write ``df`` to ``{base}/{name}``.

    ``sorted_output=False`` drops the query's final order: no sampling pass and no
    range exchange, but files of even size in any order (a limit keeps its order).

    ``single_file`` coalesces to one task (order-preserving after a global
    sort); use it only for results known to be small.
    """
    path = f"{base.rstrip('/')}/{name}"
    out = df if sorted_output else df.hint("rebalance")
    out = out.coalesce(1) if single_file else out
    out.write.mode(mode).parquet(path)
    return path


def to_envelope(df: DataFrame, query_id: str, run_ts=None) -> DataFrame:
    """E6 -- any result as ``(query_id, run_ts, row_json)``.

    ``to_json`` leaves out NULL fields, so their keys are absent from the JSON
    and read back as NULL.  ``run_ts`` is one timestamp for the whole run
    (``current_timestamp()`` when not given).  An aware datetime is that
    instant; text or a naive datetime is read in the session time zone, never
    in the driver's.
    """
    if run_ts is None:
        ts = F.current_timestamp()
    elif isinstance(run_ts, _dt.datetime) and run_ts.tzinfo is not None:
        ts = F.lit(run_ts)
    else:
        ts = F.lit(str(run_ts))
    return df.select(
        F.lit(query_id).alias("query_id"),
        ts.cast("timestamp").alias("run_ts"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row_json"),
    )


def write_result_envelope(df: DataFrame, query_id: str, path: str, run_ts=None) -> str:
    """E6 -- append the envelope rows of one result under ``{path}/query_id=<id>``.

    The layout is that of ``partitionBy("query_id")`` (reading one query back
    prunes to its folder), but each query appends into its own folder, so
    queries written at the same time from several threads never share a
    commit directory.
    """
    folder = f"{path.rstrip('/')}/query_id={query_id}"
    to_envelope(df, query_id, run_ts).drop("query_id").write.mode("append").parquet(folder)
    return path


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 10_000) -> str:
    """Append rows to a database table (the envelope, or a banking table).

    Each partition is one transaction of its connection; a task that is run
    again appends its rows again unless the table's key refuses them.
    """
    (
        df.write.format("jdbc")
        .option("url", url)
        .options(**(properties or {}))
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )
    return table
