"""Registered queries over the driver's test tables: ``name -> fn(spark, sf_dir)``.

Every entry reads the given tables (``customer``, ``orders``, ``lineitem``,
``documents``) in full and derives everything else with Spark, so its work
grows with the scale factor.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.batches import publish_batch, published, read_daily, read_store
from ledgerline.functions.casting import cast_to_schema
from ledgerline.operators import BANKING_QUERIES, check_constraints, latest_rows, unpack_q1a, word_count
from ledgerline.operators.basic import total_balance_by_type
from ledgerline.operators.movements import running_balances
from ledgerline.operators.quality import duplicate_account_types
from ledgerline.operators.rollup import ROLLUP_QUERIES
from ledgerline.plans.pipeline import run_pipeline
from ledgerline.schemas import ACCOUNTS, CUSTOMERS, TABLE_SCHEMAS, TRANSACTIONS
from ledgerline.session import scratch_path
from ledgerline.sinks.csv import write_csv_table
from ledgerline.sinks.envelope_runs import latest_page, unpack_run, write_envelope_run
from ledgerline.sinks.results import to_envelope, write_result_envelope, write_result_parquet
from ledgerline.sinks.tables import append_table
from ledgerline.sources.csv import read_csv_table, read_csv_with_rejects, rejects, sound
from ledgerline.sources.parquet import read_envelope
from ledgerline.sources.testdata import (
    TESTDATA_AS_OF,
    bank_tables_from_testdata,
    documents_text,
    faulty_feed_from_testdata,
)
from ledgerline.tables import BankTables

QueryFn = Callable[[SparkSession, str], DataFrame]

# One fixed run timestamp for the envelope queries (a run stamps all its rows alike).
ENVELOPE_RUN_TS = _dt.datetime(2001, 8, 1, 6, 0, 0)


def _banking(key: str) -> QueryFn:
    query = BANKING_QUERIES[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF)

    run.__name__ = f"{key}_{query.__name__}"
    run.__doc__ = query.__doc__
    return run


def _banking_sql(key: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ledgerline.plans.sql import run_sql

        return run_sql(spark, bank_tables_from_testdata(spark, sf_dir), key, TESTDATA_AS_OF)

    run.__name__ = f"sql_{key}"
    run.__doc__ = f"{key} through spark.sql (SQL text, DataFrame arguments, :as_of marker)."
    return run


def q2c_small_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q2c with windows of at most eight rows: most accounts go by digits."""
    return running_balances(bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF, window_rows=8)


def word_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10 over every document text."""
    return word_count(documents_text(spark, sf_dir))


def check_constraints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 and E7 over a feed of text with faults in it."""
    raw = faulty_feed_from_testdata(spark, sf_dir)
    typed = BankTables(**{name: cast_to_schema(df, TABLE_SCHEMAS[name]) for name, df in raw.items()})
    return check_constraints(typed, raw)


def _q1a_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = bank_tables_from_testdata(spark, sf_dir)
    return to_envelope(total_balance_by_type(tables, TESTDATA_AS_OF), "q1a", ENVELOPE_RUN_TS)


def envelope_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 -> E8: the first 50 JSON rows of the newest of two runs of q4c; the older run
    stored fewer columns."""
    found = duplicate_account_types(bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF)
    older = to_envelope(found.drop("total_accounts_of_type"), "q4c", ENVELOPE_RUN_TS)
    newer = to_envelope(found, "q4c", ENVELOPE_RUN_TS + _dt.timedelta(days=1))
    return latest_rows(older.unionByName(newer), "q4c", 50)


def envelope_unpack_q1a_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 -> E9: q1a through JSON text and back to typed columns."""
    return unpack_q1a(_q1a_envelope(spark, sf_dir))


def parquet_round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the derived transactions as Parquet and read them back typed."""
    path = scratch_path(spark, "transactions")
    bank_tables_from_testdata(spark, sf_dir).transactions.write.parquet(path)
    return spark.read.schema(TRANSACTIONS).parquet(path)


def csv_round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the derived customers as CSV and ingest them back (E1 + E4)."""
    path = scratch_path(spark, "customers.csv")
    write_csv_table(bank_tables_from_testdata(spark, sf_dir).customers, path)
    return read_csv_table(spark, path, CUSTOMERS)


def store_append_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2: two appends of accounts to one store (the second with repeats, changes, new
    and NULL keys); the stored rows, and the conflicts beside them."""
    path = f"{scratch_path(spark, 'store')}/accounts"
    accounts = bank_tables_from_testdata(spark, sf_dir).accounts
    k = F.col("account_id")
    key = F.when(k % 503 != 0, k)
    append_table(accounts.where(k % 3 != 0).withColumn("account_id", key), path, "accounts")
    changed = F.when(k % 10 == 1, F.col("balance") + 1).otherwise(F.col("balance"))
    append_table(accounts.withColumns({"account_id": key, "balance": changed}), path, "accounts")
    return (
        spark.read.schema(ACCOUNTS).parquet(path).withColumn("state", F.lit("stored"))
        .unionByName(spark.read.schema(ACCOUNTS).parquet(f"{path}_conflicts").withColumn("state", F.lit("conflict")))
    )


def result_sink_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: q4a written as a result folder without its order, and read back."""
    found = BANKING_QUERIES["q4a"](bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF)
    return spark.read.parquet(write_result_parquet(found, scratch_path(spark, "results"), "q4a", sorted_output=False))


def envelope_sink_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6: two runs of q4c appended to an envelope folder; the newest page of it."""
    path = scratch_path(spark, "envelope")
    found = duplicate_account_types(bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF)
    write_result_envelope(found, "q4c", path, ENVELOPE_RUN_TS + _dt.timedelta(days=1))
    write_result_envelope(found.drop("total_accounts_of_type"), "q4c", path, ENVELOPE_RUN_TS)
    return latest_rows(read_envelope(spark, path), "q4c", 50)


def content_sum(df: DataFrame) -> Column:
    """An exact sum of one 60-bit hash for each row, whatever the rows' order.

    A row is hashed as its values in the order of the column names, doubles as whole
    millionths (money and means of money), NULL as a tilde, with bars between.
    """

    def text(name: str, kind: str) -> Column:
        value = F.floor(F.col(f"`{name}`") * 1e6) if kind == "double" else F.col(f"`{name}`")
        return F.coalesce(value.cast("string"), F.lit("~"))

    row = F.concat_ws("|", *[text(name, kind) for name, kind in sorted(df.dtypes)])
    return F.sum(F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")).cast("string")


def daily_job_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11: the whole job; for each written result its rows, non-NULL values and content."""
    base = scratch_path(spark, "job")
    written = run_pipeline(
        spark, bank_tables_from_testdata(spark, sf_dir), f"{base}/store", f"{base}/out", as_of=TESTDATA_AS_OF
    )

    def extent(name: str) -> DataFrame:
        result = spark.read.parquet(written[name])
        values = sum((F.count(F.col(c)) for c in result.columns), F.lit(0))
        return result.agg(
            F.count(F.lit(1)).alias("n_rows"), values.cast("long").alias("n_values"), content_sum(result).alias("content")
        ).select(F.lit(name).alias("result"), "n_rows", "n_values", "content")

    return reduce(DataFrame.unionByName, [extent(name) for name in BANKING_QUERIES])


def _two_days(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two batches: a first day with part of the rows, a second one with all of them, some changed."""
    day2 = bank_tables_from_testdata(spark, sf_dir)
    k, t = F.col("account_id"), F.col("transaction_id")
    accounts = day2.accounts.withColumn("account_id", F.when(k % 503 != 0, k))
    day1 = {
        "customers": day2.customers.where("customer_id % 4 <> 0"),
        "accounts": accounts.where((k % 3 != 0) | k.isNull()).where(F.col("customer_id") % 2 == 0),
        "transactions": day2.transactions.where(t % 5 != 0),
    }
    publish_batch(spark, day1, path, "day1")
    moved = F.when(k % 10 == 1, F.coalesce(F.col("balance"), F.lit(0.0)) + 1).otherwise(F.col("balance"))
    changed = {
        "customers": day2.customers,
        "accounts": accounts.withColumn("balance", moved),
        "transactions": day2.transactions.withColumn(
            "description", F.when(t % 7 == 0, F.lit("corrected")).otherwise(F.col("description"))
        ),
    }
    publish_batch(spark, changed, path, "day2")


def store_versions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 as versions: the current accounts after two batches (changed, new and key-less rows)."""
    path = scratch_path(spark, "batches")
    _two_days(spark, sf_dir, path)
    return read_store(spark, path).accounts


def store_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 as versions: what each of two batches brought, and the second one again, which brings nothing."""
    path = scratch_path(spark, "batches")
    _two_days(spark, sf_dir, path)
    publish_batch(spark, dict(bank_tables_from_testdata(spark, sf_dir).items()), path, "day2")
    kinds = ("delivered", "new", "changed", "equal", "no_key", "replaced")
    rows = [
        (m["batch"], table, *[m["tables"][table][kind] for kind in kinds])
        for m in published(spark, path)
        for table in m["tables"]
    ]
    counts = spark.createDataFrame(rows, "batch string, table_name string, " + ", ".join(f"n_{k} bigint" for k in kinds))
    current = dict(read_store(spark, path).items())
    sizes = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n_current")).withColumn("table_name", F.lit(name)) for name, df in current.items()],
    )
    return counts.join(sizes, "table_name")


def _on_store(key: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "batches")
        publish_batch(spark, dict(bank_tables_from_testdata(spark, sf_dir).items()), path, "day1")
        return BANKING_QUERIES[key](read_store(spark, path), TESTDATA_AS_OF)

    run.__name__ = f"store_{key}"
    run.__doc__ = f"{key} on a published store, whose older months are not opened."
    return run


def _on_rollup(key: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "batches")
        tables = bank_tables_from_testdata(spark, sf_dir)
        wrong = F.when(F.col("transaction_id") % 3 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
        # Part of the rows first, some of them wrong; then all of them, which replaces the wrong ones.
        first = tables.transactions.where("transaction_id % 2 = 0").withColumn("amount", wrong)
        publish_batch(spark, {"customers": tables.customers, "accounts": tables.accounts, "transactions": first}, path, "day1")
        publish_batch(spark, {"transactions": tables.transactions}, path, "day2")
        return ROLLUP_QUERIES[key](read_daily(spark, path), read_store(spark, path), TESTDATA_AS_OF)

    run.__name__ = f"rollup_{key}"
    run.__doc__ = f"{key} on the daily sums of a store after two batches, the second with corrections."
    return run


def envelope_page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 and E8 by run: three runs of q4c, one of them written twice; the newest page."""
    path = scratch_path(spark, "envelope-runs")
    found = duplicate_account_types(bank_tables_from_testdata(spark, sf_dir), TESTDATA_AS_OF)
    few = found.where("customer_id % 97 = 0")
    for days, rows in ((0, found.drop("total_accounts_of_type")), (2, few), (2, few), (1, found)):
        write_envelope_run(rows, "q4c", path, ENVELOPE_RUN_TS + _dt.timedelta(days=days))
    return latest_page(spark, path, "q4c", 50)


def envelope_round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 and E9 for all 13 results: written as JSON rows, read back typed by their recorded schemas; their content."""
    path = scratch_path(spark, "envelope-runs")
    tables = bank_tables_from_testdata(spark, sf_dir)

    def extent(key: str) -> DataFrame:
        back = unpack_run(spark, write_envelope_run(BANKING_QUERIES[key](tables, TESTDATA_AS_OF), key, path, ENVELOPE_RUN_TS))
        values = sum((F.count(F.col(c)) for c in back.columns), F.lit(0))
        return back.agg(
            F.count(F.lit(1)).alias("n_rows"), values.cast("long").alias("n_values"), content_sum(back).alias("content")
        ).select(F.lit(key).alias("result"), "n_rows", "n_values", "content")

    return reduce(DataFrame.unionByName, [extent(key) for key in BANKING_QUERIES])


def csv_quarantine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1: customers as CSV text with faulty records, and how many were loaded or refused, and why."""
    path = scratch_path(spark, "customers.csv")
    customers = bank_tables_from_testdata(spark, sf_dir).customers
    k = F.col("customer_id")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in customers.columns]
    line = (
        F.when(k % 11 == 3, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(k % 13 == 5, F.concat_ws(",", *fields[:3]))
        .when(k % 17 == 7, F.concat_ws(",", fields[0], F.concat(F.lit('"'), fields[1]), *fields[2:]))
        .otherwise(F.concat_ws(",", *fields))
    )
    # One column of whole lines under the header, without quotes: text as a careless deliverer writes it.
    customers.select(line.alias(",".join(customers.columns))).write.option("header", True).option("quote", "").option(
        "escape", ""
    ).option("sep", "\u0001").csv(path)
    found = read_csv_with_rejects(spark, path, CUSTOMERS)
    refused = rejects(found).groupBy("reason", "n_fields").agg(F.count(F.lit(1)).alias("n"))
    loaded = cast_to_schema(sound(found), CUSTOMERS).agg(F.count("customer_id").alias("n"))
    return refused.unionByName(
        loaded.select(F.lit("loaded").alias("reason"), F.lit(len(CUSTOMERS.names)).cast("long").alias("n_fields"), "n")
    )


def registered_queries() -> dict[str, QueryFn]:
    queries: dict[str, QueryFn] = {key: _banking(key) for key in BANKING_QUERIES}
    queries.update({f"sql_{key}": _banking_sql(key) for key in BANKING_QUERIES})
    queries.update(
        {
            "q2c_small_chunks": q2c_small_chunks,
            "word_count": word_count_query,
            "check_constraints": check_constraints_query,
            "envelope_latest": envelope_latest_query,
            "envelope_unpack_q1a": envelope_unpack_q1a_query,
            "parquet_round_trip": parquet_round_trip_query,
            "csv_round_trip": csv_round_trip_query,
            "store_append": store_append_query,
            "result_sink": result_sink_query,
            "envelope_sink": envelope_sink_query,
            "daily_job": daily_job_query,
            "store_versions": store_versions_query,
            "store_counts": store_counts_query,
            "store_q2a": _on_store("q2a"),
            "store_q3b": _on_store("q3b"),
            "csv_quarantine": csv_quarantine_query,
            **{f"rollup_{key}": _on_rollup(key) for key in ROLLUP_QUERIES},
            "envelope_page": envelope_page_query,
            "envelope_round_trip": envelope_round_trip_query,
        }
    )
    return queries
