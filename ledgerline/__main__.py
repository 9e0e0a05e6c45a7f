"""Command line for ``spark-submit``.

    spark-submit ledgerline/__main__.py run    --source s3a://bucket/raw/ --store s3a://bucket/store/ \
        --out s3a://bucket/results/ [--envelope s3a://bucket/case_results/] [--as-of 2024-08-31] \
        [--queries q1a,q2c] [--parallel-jobs 4] [--mode overwrite|append] [--single-file]
    spark-submit ledgerline/__main__.py ingest --landing s3a://bucket/landing/ --store s3a://bucket/store/

``run`` is the daily job (ingest CSV or a database, constraint report, staging as one batch,
the 13 results, optional JSON envelope); run again after a failure, it leaves what one run leaves.
``ingest`` drains newly landed CSV files into the store with Structured Streaming (a replayed batch adds nothing
twice).  Of two writers at a time one fails and can be run again.  The session
takes its settings from the cluster; nothing is overridden here.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="ingest, check, stage and write all results")
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--source", help="folder with customers.csv, accounts.csv, transactions.csv")
    source.add_argument("--jdbc-url", help="database with the tables customers, accounts, transactions")
    run.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE", help="driver, user, ...")
    run.add_argument("--jdbc-envelope", default=None, metavar="TABLE", help="append the JSON rows to this table, too")
    run.add_argument("--multi-line", action="store_true", help="CSV with line breaks inside quotes (one task a file)")
    run.add_argument("--store", required=True, help="Parquet table store; the input becomes one published batch of it")
    run.add_argument("--out", required=True, help="one folder per result is written under it")
    run.add_argument("--envelope", default=None, help="also append JSON rows (query_id, run_ts, row_json) here")
    run.add_argument("--as-of", default=None, help="ISO date; default: today in the session time zone")
    run.add_argument("--queries", default=None, help="comma list of query keys; default: all 13")
    run.add_argument("--parallel-jobs", type=int, default=1)
    run.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    run.add_argument("--single-file", action="store_true", help="one file per result (small results only)")
    run.add_argument("--unsorted", action="store_true", help="write results without their final order")
    ing = sub.add_parser("ingest", help="stream newly landed CSV files into the store")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--store", required=True)
    ing.add_argument("--checkpoint", default=None, help="default: under spark.checkpoint.dir")
    ing.add_argument("--max-files-per-trigger", type=int, default=None)
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"ledgerline-{args.command}").getOrCreate()
    if args.command == "run":
        from ledgerline.plans.pipeline import run_pipeline
        from ledgerline.sources.csv import read_csv_tables
        from ledgerline.sources.jdbc import read_jdbc_tables

        options = dict(pair.split("=", 1) for pair in args.jdbc_option)
        if args.jdbc_url:
            source = read_jdbc_tables(spark, args.jdbc_url, options)
        else:
            source = read_csv_tables(spark, args.source, with_rejects=True, multiLine=str(args.multi_line).lower())
        if args.jdbc_envelope and not args.jdbc_url:
            raise SystemExit("--jdbc-envelope needs --jdbc-url")

        written = run_pipeline(
            spark,
            source,
            args.store,
            args.out,
            as_of=args.as_of,
            envelope_path=args.envelope,
            queries=args.queries.split(",") if args.queries else None,
            mode=args.mode,
            parallel_jobs=args.parallel_jobs,
            single_file=args.single_file,
            sorted_output=not args.unsorted,
            envelope_jdbc=(args.jdbc_url, args.jdbc_envelope, options) if args.jdbc_envelope else None,
        )
        for name, path in sorted(written.items()):
            print(f"[WRITE] {name} -> {path}")
    else:
        from ledgerline.streaming import ingest_landing

        for name, path in ingest_landing(
            spark, args.landing, args.store, args.checkpoint, args.max_files_per_trigger
        ).items():
            print(f"[STORE] {name} -> {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
