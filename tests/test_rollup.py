"""Daily sums beside the batches: equal to the direct queries, without a look at the transactions."""

from __future__ import annotations

import datetime as dt
import glob

from conftest import account, customer, make_tables, rows, tx

from ledgerline.batches import compact_store, drop_compacted, publish_batch, read_daily, read_store
from ledgerline.operators import BANKING_QUERIES
from ledgerline.operators.rollup import ROLLUP_QUERIES, daily_rollup

AS_OF = dt.date(2024, 8, 31)


def _day(spark, *transactions):
    return make_tables(
        spark,
        customers=[customer(1), customer(2), customer(3)],
        accounts=[account(10, 1, balance=8.5), account(20, 2, balance=None), account(30, 1, balance=0.0), account(40, 3, balance=1.0)],
        transactions=transactions,
    )


def _same(spark, store):
    t, r = read_store(spark, store), read_daily(spark, store)
    for key, fn in ROLLUP_QUERIES.items():
        assert sorted(rows(fn(r, t, AS_OF)), key=repr) == sorted(rows(BANKING_QUERIES[key](t, AS_OF)), key=repr), key
    sums = sorted(rows(daily_rollup(t.transactions)), key=repr)
    assert sorted(rows(r.drop("month")), key=repr) == sums


FIRST = (
    tx(1, 10, "2024-08-30", "Deposit", 10.5), tx(2, 10, "2024-08-30", "Deposit", None), tx(3, 20, None, "Payment", 2.0),
    tx(4, 20, "2024-08-01", "Deposit", None), tx(5, 30, "2024-06-01", "Fee", 9.0), tx(6, 99, "2024-08-30", "Deposit", 1.0),
    tx(7, 30, "2024-08-02", None, 1.0), tx(8, 30, "2024-08-02", "Transfer", float("nan")),
)


def test_batches_add_and_take_off(spark, scratch):
    publish_batch(spark, dict(_day(spark, *FIRST).items()), scratch, "a")
    _same(spark, scratch)
    # Other amount, other day, other type, other account, no amount any more, and a row of its own.
    second = (
        tx(1, 10, "2024-08-30", "Deposit", 11.5), tx(3, 20, "2024-08-29", "Payment", 2.0), tx(5, 30, "2024-06-01", "Deposit", 9.0),
        tx(7, 40, "2024-08-02", "Deposit", 1.0), tx(8, 30, "2024-08-02", "Transfer", 4.0), tx(9, 40, "2023-01-01", "Withdrawal", 0.25),
    )
    counts = publish_batch(spark, {"transactions": _day(spark, *second).transactions}, scratch, "b")["transactions"]
    assert (counts["changed"], counts["new"]) == (5, 1)
    _same(spark, scratch)
    publish_batch(spark, {"transactions": _day(spark, *FIRST).transactions}, scratch, "c")  # and back
    _same(spark, scratch)
    compact_store(spark, scratch, "d")
    _same(spark, scratch)
    drop_compacted(spark, scratch)
    _same(spark, scratch)


def test_no_transaction_file_and_no_old_month_is_opened(spark, scratch):
    publish_batch(spark, dict(_day(spark, *FIRST, tx(11, 10, "2020-01-01", "Deposit", 5.0)).items()), scratch, "a")
    t = read_store(spark, scratch)
    want = {key: sorted(rows(BANKING_QUERIES[key](t, AS_OF)), key=repr) for key in ("q2b", "q3a", "q3b")}
    old = glob.glob(f"{scratch}/_daily/batch=a/month=202001/*.parquet")
    assert old
    for f in glob.glob(f"{scratch}/transactions/**/*.parquet", recursive=True) + old:
        with open(f, "w") as out:
            out.write("not parquet")
    t, r = read_store(spark, scratch), read_daily(spark, scratch)
    for key in want:
        found = ROLLUP_QUERIES[key](r, t, AS_OF)
        assert "PartitionFilters: [isnotnull(month" in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(found), key=repr) == want[key]


def test_empty_store(spark, scratch):
    publish_batch(spark, dict(_day(spark).items()), scratch, "a")
    assert read_daily(spark, scratch).count() == 0
    _same(spark, scratch)


def test_merged_sums_are_dealt_once_by_account(spark, scratch):
    publish_batch(spark, dict(_day(spark, *FIRST).items()), scratch, "a")
    publish_batch(spark, {"transactions": _day(spark, tx(1, 10, "2024-08-30", "Deposit", 11.5)).transactions}, scratch, "b")
    per_account = read_daily(spark, scratch).groupBy("account_id").count()
    assert per_account._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1
    _same(spark, scratch)


def test_order_of_q4a_samples_an_exchange(spark, scratch):
    publish_batch(spark, dict(_day(spark, *FIRST).items()), scratch, "a")
    found = ROLLUP_QUERIES["q4a"](read_daily(spark, scratch), read_store(spark, scratch), AS_OF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan[plan.index("Exchange rangepartitioning"):]
    _same(spark, scratch)
