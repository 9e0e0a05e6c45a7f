"""E11 -- the daily job: ingest, check, stage, run the 13 queries, write results.

Order: land (CSV or given tables, read once and kept as Parquet until staged; row counts,
cast losses and a checksum are taken in the same pass) -> cast to the declared layout -> publish
as one batch of the store (``ledgerline.batches``) -> constraint report -> each query on the
store's current rows -> one Parquet folder
per query (E5) and, optionally, the JSON-row envelope (E6, one folder for each query and run), built from the
written result folder rather than by running the query a second time.

A run that ended anywhere can be started again with the same source and ``as_of``: its batch has
the same name (the day and a checksum of the delivered rows), so a batch that was begun is
overwritten, one that was published is left as it is, and the report is that of one run.

Staging the inputs once in Parquet cuts the lineage (a retry re-reads the
store, not the source) and gives every query column pruning and pushed
filters; the 13 queries then read the store, not the source.  One ``as_of``
and one ``run_ts`` hold for the whole run.  Independent queries can be
submitted from several threads so Spark runs their jobs side by side.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from zoneinfo import ZoneInfo

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.batches import batch_name, publish_batch, read_store, row_checksum
from ledgerline.files import remove_path
from ledgerline.functions.casting import cast_to_schema, lost_in_cast
from ledgerline.operators import BANKING_QUERIES, check_constraints
from ledgerline.operators.checks import counted_rows
from ledgerline.schemas import PRIMARY_KEYS, TABLE_SCHEMAS
from ledgerline.sinks.envelope_runs import write_envelope_run
from ledgerline.sinks.results import append_jdbc, to_envelope, write_result_parquet
from ledgerline.session import scratch_path
from ledgerline.sources.csv import REJECTED, read_csv_tables, rejects, sound
from ledgerline.tables import BankTables

CONSTRAINTS_RESULT = "_constraints"


def resolve_as_of(spark: SparkSession, as_of=None) -> _dt.date:
    """One date for the run: given, or today in the session time zone."""
    if as_of is not None:
        if isinstance(as_of, _dt.datetime):  # a datetime is a date, too
            return as_of.date()
        return as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    tz = spark.conf.get("spark.sql.session.timeZone", "UTC")
    return _dt.datetime.now(ZoneInfo(tz)).date()


def _landed(spark: SparkSession, raw: BankTables, landing: str) -> tuple[BankTables, dict, dict]:
    """The delivered records as Parquet, read from their source once; and what that pass saw of
    each table: its checksum, and the cast losses of its sound records by column."""
    frames, sums, losses = {}, {}, {}
    for name, df in raw.items():
        schema, seen = TABLE_SCHEMAS[name], Observation()
        ok = F.col(REJECTED).isNull() if REJECTED in df.columns else F.lit(True)
        lost = [F.count_if(ok & lost_in_cast(c, schema)).alias(f"lost_{c}") for c in schema.names]
        df.observe(seen, *row_checksum(df), *lost).write.parquet(f"{landing}/{name}")
        frames[name] = spark.read.schema(df.schema).parquet(f"{landing}/{name}")
        values = seen.get
        sums[name] = {k: values[k] for k in ("n", "first", "second")}
        losses[name] = {c: values[f"lost_{c}"] or 0 for c in schema.names}
    return BankTables(**frames), sums, losses


def _load_report(counts: dict[str, dict]) -> list[tuple[str, str, str | None, int]]:
    rows = []
    for name, n in counts.items():
        rows.append((name, "malformed_record", None, n["malformed"]))
        for check, count in (("row_new", "new"), ("row_changed", "changed"), ("row_equal", "equal"), ("row_without_key", "no_key")):
            rows.append((name, check, PRIMARY_KEYS[name], n[count]))
    return rows


def run_pipeline(
    spark: SparkSession,
    source,
    store: str,
    out: str,
    as_of=None,
    envelope_path: str | None = None,
    run_ts: _dt.datetime | None = None,
    queries=None,
    mode: str = "overwrite",
    parallel_jobs: int = 1,
    single_file: bool = False,
    envelope_jdbc: tuple[str, str, dict] | None = None,
    sorted_output: bool = True,
    batch: str | None = None,
) -> dict[str, str]:
    """Run the job.  ``source`` is a CSV base folder or ``BankTables`` in any types
    (such as ``read_jdbc_tables`` or ``read_csv_tables(with_rejects=True)`` give); all are cast and checked alike.
    ``batch`` names the store's batch (default: from ``as_of`` and the delivered rows).
    ``envelope_jdbc`` (url, table, properties) appends the JSON rows to a database."""
    raw = source if isinstance(source, BankTables) else read_csv_tables(spark, source, with_rejects=True)
    landing = scratch_path(spark, "landing")
    raw, sums, losses = _landed(spark, raw, landing)
    as_of = resolve_as_of(spark, as_of)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc)

    checked = {name: REJECTED in df.columns for name, df in raw.items()}
    rejected = {name: rejects(df) for name, df in raw.items() if checked[name]}
    tables = BankTables(
        **{name: cast_to_schema(sound(df) if checked[name] else df, TABLE_SCHEMAS[name]) for name, df in raw.items()}
    )
    counts = publish_batch(spark, dict(tables.items()), store, batch or batch_name(as_of, sums), rejected)
    report = check_constraints(tables, losses=losses).unionByName(counted_rows(spark, _load_report(counts)))
    written = {CONSTRAINTS_RESULT: write_result_parquet(report, out, CONSTRAINTS_RESULT, mode)}
    remove_path(spark, landing)
    staged = read_store(spark, store)

    selected = {k: BANKING_QUERIES[k] for k in (queries or BANKING_QUERIES)}

    def run_one(key):
        df = selected[key](staged, as_of)
        path = write_result_parquet(df, out, key, mode, single_file, sorted_output)
        if envelope_path:
            # From the written result, so the query is not computed twice
            # (an appended folder also holds earlier runs: recompute then).
            source_df = spark.read.parquet(path) if mode == "overwrite" else df
            write_envelope_run(source_df, key, envelope_path, run_ts)
        if envelope_jdbc:
            url, table, properties = envelope_jdbc
            append_jdbc(to_envelope(spark.read.parquet(path) if mode == "overwrite" else df, key, run_ts), url, table, properties)
        return key, path

    if parallel_jobs > 1:
        with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
            written.update(dict(pool.map(run_one, selected)))
    else:
        written.update(dict(map(run_one, selected)))
    return written
