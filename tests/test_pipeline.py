"""E11 end to end, and the streaming ingest."""

from __future__ import annotations

import os

from conftest import SF_SMALL, rows

from ledgerline.operators import BANKING_QUERIES
from ledgerline.plans.pipeline import CONSTRAINTS_RESULT, run_pipeline
from ledgerline.sinks.csv import write_csv_table
from ledgerline.sources.parquet import read_envelope, read_parquet_tables
from ledgerline.sources.testdata import TESTDATA_AS_OF, bank_tables_from_testdata
from ledgerline.streaming import ingest_landing


def test_pipeline_writes_all_results_and_matches_queries(spark, scratch):
    tables = bank_tables_from_testdata(spark, SF_SMALL)
    out = f"{scratch}/out"
    written = run_pipeline(
        spark, tables, f"{scratch}/store", out, as_of=TESTDATA_AS_OF,
        envelope_path=f"{scratch}/envelope", parallel_jobs=4,
    )
    assert set(written) == set(BANKING_QUERIES) | {CONSTRAINTS_RESULT}
    for key in ("q1a", "q2c", "q4a"):
        stored = rows(spark.read.parquet(written[key]))
        direct = rows(BANKING_QUERIES[key](tables, TESTDATA_AS_OF))
        assert sorted(stored, key=repr) == sorted(direct, key=repr), key
    env = read_envelope(spark, f"{scratch}/envelope")
    assert env.select("query_id").distinct().count() == 13
    assert env.where("query_id = 'q2c'").count() == 6000
    # A second run stages nothing new and rewrites the results.
    run_pipeline(spark, tables, f"{scratch}/store", out, as_of=TESTDATA_AS_OF, queries=["q1a"])
    assert read_parquet_tables(spark, f"{scratch}/store").transactions.count() == 6000


def test_pipeline_from_csv(spark, scratch):
    tables = bank_tables_from_testdata(spark, SF_SMALL)
    src = f"{scratch}/csv"
    for name, df in tables.items():
        write_csv_table(df, f"{src}/{name}.csv")
    written = run_pipeline(spark, src, f"{scratch}/store", f"{scratch}/out", as_of=TESTDATA_AS_OF, queries=["q4b", "q3a"])
    assert spark.read.parquet(written["q4b"]).count() == 67
    assert spark.read.parquet(written["q3a"]).count() == 150
    report = {(r[0], r[1], r[2]): r[3] for r in rows(spark.read.parquet(written[CONSTRAINTS_RESULT]))}
    assert report[("customers", "cast_loss", "date_of_birth")] == 0
    assert report[("accounts", "foreign_key_orphan", "customer_id")] == 0


def _csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(header + "\n" + "\n".join(lines) + "\n")


def test_streaming_ingest_is_incremental_and_idempotent(spark, scratch):
    landing, store, ckpt = f"{scratch}/landing", f"{scratch}/store", f"{scratch}/ckpt"
    _csv(f"{landing}/customers/day1.csv", "customer_id,first_name,last_name,date_of_birth,address,city,state,zip",
         ["1,a,b,1980-01-01,x,c,s,01234", "2,c,d,,,,,"])
    _csv(f"{landing}/accounts/day1.csv", "account_id,customer_id,account_type,opening_date,balance",
         ["10,1,Loan,2020-01-01,5.5"])
    _csv(f"{landing}/transactions/day1.csv",
         "transaction_id,account_id,transaction_date,transaction_type,amount,description",
         ["100,10,2020-01-02,Deposit,5.5,x"])
    ingest_landing(spark, landing, store, ckpt)
    ingest_landing(spark, landing, store, ckpt)  # nothing new
    t = read_parquet_tables(spark, store)
    assert (t.customers.count(), t.accounts.count(), t.transactions.count()) == (2, 1, 1)
    assert rows(t.customers.where("customer_id = 1").select("zip")) == [("01234",)]
    # Day 2 re-delivers a known row and adds a new one.
    _csv(f"{landing}/transactions/day2.csv",
         "transaction_id,account_id,transaction_date,transaction_type,amount,description",
         ["100,10,2020-01-02,Deposit,5.5,x", "101,10,2020-01-03,Withdrawal,1.5,y"])
    ingest_landing(spark, landing, store, ckpt)
    assert read_parquet_tables(spark, store).transactions.count() == 2


def test_command_line_run(spark, scratch):
    from ledgerline.__main__ import main

    tables = bank_tables_from_testdata(spark, SF_SMALL)
    src = f"{scratch}/csv"
    for name, df in tables.items():
        write_csv_table(df, f"{src}/{name}.csv")
    assert main(["run", "--source", src, "--store", f"{scratch}/store", "--out", f"{scratch}/out",
                 "--as-of", "2001-08-01", "--queries", "q1c,q4e", "--single-file"]) == 0
    assert spark.read.parquet(f"{scratch}/out/q1c").count() == 5
    assert spark.read.parquet(f"{scratch}/out/q4e").count() == 124


def test_pipeline_casts_and_checks_given_tables(spark, scratch):
    from ledgerline.tables import BankTables

    tables = bank_tables_from_testdata(spark, SF_SMALL)
    delivered = BankTables(
        tables.customers,
        tables.accounts.selectExpr(
            "cast(account_id as string) as account_id", "customer_id", "account_type", "opening_date",
            "case when account_id % 2 = 0 then 'n/a' else cast(balance as string) end as balance",
        ),
        tables.transactions,
    )
    written = run_pipeline(
        spark, delivered, f"{scratch}/store", f"{scratch}/out", as_of=TESTDATA_AS_OF, queries=["q1a"], sorted_output=False
    )
    report = {(r[0], r[1], r[2]): r[3] for r in rows(spark.read.parquet(written[CONSTRAINTS_RESULT]))}
    assert report[("accounts", "cast_loss", "balance")] == tables.accounts.where("account_id % 2 = 0").count()
    assert dict(read_parquet_tables(spark, f"{scratch}/store").accounts.dtypes)["account_id"] == "bigint"
    assert spark.read.parquet(written["q1a"]).count() == 502
