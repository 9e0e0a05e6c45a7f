"""Sources, sinks and job-level operators: E1, E2, E5-E10."""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os

from conftest import account, customer, make_tables, rows, tx
from pyspark.sql import functions as F

from ledgerline.operators import check_constraints, latest_rows, total_balance_by_type, unpack_q1a, word_count
from ledgerline.schemas import CUSTOMERS
from ledgerline.sinks import append_tables, to_envelope, write_result_envelope, write_result_parquet
from ledgerline.sources import read_csv_raw, read_csv_table, read_csv_tables, read_envelope, read_parquet_tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_e1_csv_types_zip_empty_and_bad_date(spark, scratch):
    path = f"{scratch}/customers.csv"
    _write(
        path,
        "customer_id,first_name,last_name,date_of_birth,address,city,state,zip\n"
        "1,Ann,Lee,1980-02-03,Main St,X,Y,01234\n"
        "2,Bob,,not-a-date,,X,Y,\n"
        '3,NA,N/A,1990-01-01,"",X,Y,"   "\n',
    )
    got = rows(read_csv_table(spark, path, CUSTOMERS).orderBy("customer_id"))
    assert got[0] == (1, "Ann", "Lee", dt.date(1980, 2, 3), "Main St", "X", "Y", "01234")
    assert got[1] == (2, "Bob", None, None, None, "X", "Y", None)
    assert got[2] == (3, "NA", "N/A", dt.date(1990, 1, 1), "", "X", "Y", "   ")


def test_e1_three_tables_and_cast_losses(spark, scratch):
    _write(f"{scratch}/customers.csv", "customer_id,first_name,last_name,date_of_birth,address,city,state,zip\n1,a,b,,,,,\n")
    _write(f"{scratch}/accounts.csv", "account_id,customer_id,account_type,opening_date,balance\n10,1,Loan,2020-01-01,abc\n")
    _write(
        f"{scratch}/transactions.csv",
        "transaction_id,account_id,transaction_date,transaction_type,amount,description\n"
        "100,10,2020-13-01,Deposit,5.5,x\n",
    )
    typed = read_csv_tables(spark, scratch)
    raw = read_csv_tables(spark, scratch, raw=True)
    assert rows(typed.accounts) == [(10, 1, "Loan", dt.date(2020, 1, 1), None)]
    report = {(r[0], r[1], r[2]): r[3] for r in rows(check_constraints(typed, raw))}
    assert report[("accounts", "cast_loss", "balance")] == 1
    assert report[("transactions", "cast_loss", "transaction_date")] == 1
    assert report[("customers", "cast_loss", "customer_id")] == 0


def test_e7_one_violation_each(spark):
    t = make_tables(
        spark,
        customers=[customer(1), customer(1), customer(2)],
        accounts=[account(10, 1), account(11, 99)],
        transactions=[tx(100, 10), tx(101, 10), tx(102, 12)],
    )
    nullkey = spark.createDataFrame(
        [(None, 10, None, None, None, None)],
        "transaction_id long, account_id long, transaction_date date, transaction_type string, "
        "amount double, description string",
    )
    from ledgerline.tables import BankTables

    t = BankTables(t.customers, t.accounts, t.transactions.unionByName(nullkey))
    report = {(r[0], r[1], r[2]): r[3] for r in rows(check_constraints(t))}
    assert report[("customers", "primary_key_duplicate", "customer_id")] == 1
    assert report[("accounts", "foreign_key_orphan", "customer_id")] == 1
    assert report[("transactions", "foreign_key_orphan", "account_id")] == 1
    assert report[("transactions", "primary_key_null", "transaction_id")] == 1
    assert report[("accounts", "primary_key_duplicate", "account_id")] == 0


def test_e6_e8_e9_envelope_round_trip(spark, scratch):
    t = make_tables(
        spark,
        customers=[customer(1), customer(2)],
        accounts=[account(10, 1, kind=None, balance=15000000.0), account(20, 2, kind="Loan", balance=2.5)],
    )
    q1a = total_balance_by_type(t)
    path = f"{scratch}/envelope"
    write_result_envelope(q1a, "q1a", path, run_ts=dt.datetime(2024, 1, 1))
    write_result_envelope(q1a, "q1a", path, run_ts=dt.datetime(2024, 1, 2))
    env = read_envelope(spark, path)
    assert env.columns == ["query_id", "run_ts", "row_json"]
    assert env.count() == 4
    first = json.loads(rows(latest_rows(env, "q1a", 1))[0][0])
    assert "account_type" not in first or first["account_type"] is not None
    none_typed = [json.loads(r[2]) for r in rows(env) if "account_type" not in json.loads(r[2])]
    assert none_typed and all(d["customer_id"] == 1 for d in none_typed)
    back = rows(unpack_q1a(env.where(F.col("run_ts") == F.lit(dt.datetime(2024, 1, 2)))))
    assert back == [("1", None, decimal.Decimal("15000000.0000000000")), ("2", "Loan", decimal.Decimal("2.5000000000"))]


def test_e6_columns_and_single_run_ts(spark):
    t = make_tables(spark, customers=[customer(1)], accounts=[account(10, 1, balance=1.0)])
    env = to_envelope(total_balance_by_type(t), "q1a")
    assert env.columns == ["query_id", "run_ts", "row_json"]
    assert env.select("run_ts").distinct().count() == 1


def test_e10_word_count(spark):
    df = spark.createDataFrame([("Hello Spark Hello",), ("a  b",), (None,)], "text string")
    got = dict(rows(word_count(df)))
    assert got == {"Hello": 2, "Spark": 1, "a": 1, "": 1, "b": 1}


def test_e5_write_and_e2_idempotent_append(spark, scratch):
    t = make_tables(
        spark,
        customers=[customer(1), customer(2)],
        accounts=[account(10, 1)],
        transactions=[tx(100, 10), tx(101, 10)],
    )
    store = f"{scratch}/store"
    append_tables(t, store)
    append_tables(t, store)  # a rerun adds nothing
    staged = read_parquet_tables(spark, store)
    assert (staged.customers.count(), staged.accounts.count(), staged.transactions.count()) == (2, 1, 2)
    more = make_tables(spark, customers=[customer(3)], accounts=[], transactions=[tx(102, 10)])
    append_tables(more, store)
    staged = read_parquet_tables(spark, store)
    assert (staged.customers.count(), staged.transactions.count()) == (3, 3)
    out = write_result_parquet(total_balance_by_type(staged), f"{scratch}/results", "q1a", single_file=True)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1
    assert rows(spark.read.parquet(out)) == [(1, "Checking", 0.0)]


def test_csv_raw_keeps_text(spark, scratch):
    path = f"{scratch}/c.csv"
    _write(path, "customer_id,first_name,last_name,date_of_birth,address,city,state,zip\nx1,a,b,c,d,e,f,g\n")
    assert rows(read_csv_raw(spark, path, CUSTOMERS)) == [("x1", "a", "b", "c", "d", "e", "f", "g")]


def test_e2_transactions_clustered_by_date(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    from ledgerline.sources.testdata import bank_tables_from_testdata

    store = f"{scratch}/store"
    # Small input: keep AQE from merging everything into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        append_tables(bank_tables_from_testdata(spark, "/root/testdata/sf0.001"), store)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = []
    for f in glob.glob(f"{store}/transactions/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        col = [meta.schema.column(i).name for i in range(meta.num_columns)].index("transaction_date")
        for g in range(meta.num_row_groups):
            st = meta.row_group(g).column(col).statistics
            if st is not None and st.has_min_max:
                ranges.append((st.min, st.max))
    assert len(ranges) > 1
    ranges.sort()
    # Files cover consecutive, non-overlapping date ranges (a shared boundary day at most).
    for (lo1, hi1), (lo2, hi2) in zip(ranges, ranges[1:]):
        assert hi1 <= lo2


def test_csv_binds_by_header_name_and_reads_quotes(spark, scratch):
    path = f"{scratch}/accounts.csv"
    with open(path, "w") as f:
        f.write('customer_id,account_id,balance,account_type,opening_date,extra\n100,7,1.5,"Al ""Ace"" \\",2020-01-01,x\n')
    from ledgerline.schemas import ACCOUNTS
    from ledgerline.sources.csv import read_csv_table

    row = read_csv_table(spark, path, ACCOUNTS).first()
    assert (row.account_id, row.customer_id, row.balance, row.account_type) == (7, 100, 1.5, 'Al "Ace" \\')


def test_append_reports_conflicts_and_keeps_null_keys(spark, scratch):
    from ledgerline.schemas import ACCOUNTS
    from ledgerline.sinks.tables import append_table

    def frame(*rows):
        return spark.createDataFrame(
            list(rows), "account_id bigint, customer_id bigint, account_type string, opening_date date, balance double"
        )

    path = f"{scratch}/store/accounts"
    first = (1, 1, "Loan", None, 5.0)
    assert append_table(frame(first, (None, 1, "Loan", None, 1.0)), path, "accounts") == 0
    changed = (1, 1, "Loan", None, 6.0)
    assert append_table(frame(first, changed, (None, 2, "Loan", None, 2.0), (2, 1, "Loan", None, 7.0)), path, "accounts") == 1
    stored = sorted((r.account_id or 0, r.balance) for r in spark.read.schema(ACCOUNTS).parquet(path).collect())
    assert stored == [(0, 1.0), (0, 2.0), (1, 5.0), (2, 7.0)]
    assert [r.balance for r in spark.read.schema(ACCOUNTS).parquet(path + "_conflicts").collect()] == [6.0]


def test_run_ts_does_not_depend_on_the_drivers_time_zone(spark, monkeypatch):
    import datetime
    import time

    from ledgerline.sinks.results import to_envelope

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        moment = datetime.datetime(2024, 1, 2, 14, 35)
        for ts in (moment, "2024-01-02 14:35:00", moment.replace(tzinfo=datetime.timezone.utc)):
            got = to_envelope(spark.range(1), "q", ts).selectExpr("cast(run_ts as string) as s").first().s
            assert got == "2024-01-02 14:35:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_unsorted_result_has_no_sort_and_the_same_rows(spark, scratch):
    t = make_tables(spark, customers=[customer(1)], accounts=[account(i, 1, balance=-float(i)) for i in range(1, 9)])
    from ledgerline.operators import BANKING_QUERIES

    found = BANKING_QUERIES["q4e"](t)
    path = write_result_parquet(found, scratch, "q4e", sorted_output=False)
    assert sorted(rows(spark.read.parquet(path))) == sorted(rows(found))
    plan = found.hint("rebalance")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan


def test_append_reads_only_the_range_of_the_inputs_keys(spark, scratch):
    from ledgerline.sinks.tables import append_table

    path = f"{scratch}/store/accounts"
    kind = "account_id bigint, customer_id bigint, account_type string, opening_date date, balance double"

    def frame(*values):
        return spark.createDataFrame(list(values), kind)

    append_table(frame((1, 1, "Loan", None, 1.0), (9, 1, "Loan", None, 9.0)), path, "accounts")
    # No key at all, then a range that holds one stored key.
    assert append_table(frame((None, 1, "Loan", None, 3.0)), path, "accounts") == 0
    assert append_table(frame((5, 1, "Loan", None, 5.0), (9, 1, "Loan", None, 8.0)), path, "accounts") == 1
    stored = sorted((r[0] or 0) for r in rows(spark.read.parquet(path)))
    assert stored == [0, 1, 5, 9]
