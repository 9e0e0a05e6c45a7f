"""Transaction analysis: large withdrawals, deposits per customer, running balances."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import (
    as_double,
    days_before,
    money_sum,
    months_before,
    since,
    signed_amount,
    to_money,
)
from ledgerline.functions.domain import DEPOSIT, LARGE_WITHDRAWAL, WITHDRAWAL
from ledgerline.tables import BankTables


def large_withdrawals(t: BankTables, as_of=None, days: int = 30) -> DataFrame:
    """q2a -- withdrawals above 500 dated on or after ``as_of - days``.

    The conjunctive filter is applied to transactions before both joins; with
    Parquet input it is pushed into the scan.  transaction_id breaks ties in
    the sort so the range partitioner can split equal (date, amount) runs.
    """
    tx = t.transactions.where(
        (F.col("transaction_type") == F.lit(WITHDRAWAL))
        & (F.col("amount") > LARGE_WITHDRAWAL)
        & since(t.transactions, days_before(as_of, days))
    ).select("transaction_id", "account_id", "transaction_date", "amount")
    return (
        tx.join(t.accounts.select("account_id", "customer_id"), "account_id")
        .join(t.customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .orderBy(
            F.desc_nulls_last("transaction_date"),
            F.desc_nulls_last("amount"),
            F.asc_nulls_first("transaction_id"),
        )
        .select("account_id", "customer_id", "first_name", "last_name", "transaction_date", "amount")
    )


def deposits_per_customer(t: BankTables, as_of=None, months: int = 6) -> DataFrame:
    """q2b -- exact total of deposits per customer over the last ``months``.

    Deposits are summed per account first (partial aggregation before any
    shuffle), so only one row per account meets the accounts table.
    """
    deposits = t.transactions.where(
        (F.col("transaction_type") == F.lit(DEPOSIT))
        & since(t.transactions, months_before(as_of, months))
    )
    per_account = deposits.groupBy("account_id").agg(money_sum("amount").alias("dep"))
    return (
        per_account.join(t.accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(as_double(F.sum("dep")).alias("total_deposits"))
        .orderBy(F.asc_nulls_first("customer_id"))
    )


# --------------------------------------------------------------------------
# q2c: running balance rebuilt backwards from the current balance.
#
# For a transaction r of account a, ordered by (date DESC NULLS LAST, id DESC):
#     running_balance(r) = balance(a) - sum(signed amounts of rows before r)
# i.e. the balance minus everything that happened after r.  A NULL date counts
# as the oldest.  Rows without an account id belong to no account, on either side.
#
# No window of the job holds more than a stated number of rows:
#   * an account of at most WINDOW_ROWS rows (or MOST_HOT-th part of all rows, if
#     that is more) is one window.  One exchange by account serves window and join;
#   * the others are *hot*: fewer than MOST_HOT accounts by that definition, so their
#     ids are a broadcast of a proven size.  Their rows never share a window or a task by
#     account.  A row's place is written as digits that depend on the row alone --
#     day, id >> 42, id >> 21, id -- and the later sum of a row is the sum of the later
#     digits on each level:
#         later days of the account        (at most 3.7 million days in a date's range)
#       + later id >> 42 of the day        (at most 2^22)
#       + later id >> 21 inside those      (at most 2^21)
#       + later ids inside those           (at most 2^21, ids being unique)
#     Each level is a window over the sums of the level below, which come from
#     partial aggregates; no level looks at the data to choose its grain.
# Which accounts are hot is part of the lazy plan: no job runs while it is built,
# and where there is none the adaptive plan drops the levels.
# --------------------------------------------------------------------------

WINDOW_ROWS = 1 << 16
MOST_HOT = 100_000
ID_SHIFTS = (42, 21)

_TX_COLUMNS = ("account_id", "transaction_id", "transaction_date", "transaction_type", "amount")


def _later(sums: str, within: list[str], order: str):
    """The sum of ``sums`` over what comes before in descending ``order``."""
    earlier = (
        Window.partitionBy(*within).orderBy(F.desc_nulls_last(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(sums).over(earlier), F.lit(0))


def hot_accounts(transactions: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """The ids of accounts with too many rows for one window: fewer than ``MOST_HOT``."""
    total = transactions.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_account = transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return per_account.where((F.col("n") > window_rows) & (F.col("n") > total / MOST_HOT)).select("account_id")


def _later_by_digits(rows: DataFrame, shifts: tuple[int, ...] = ID_SHIFTS) -> DataFrame:
    """``rows`` with ``later``, without a window over more rows than a digit has values."""
    names = [f"digit_{s}" for s in shifts]
    rows = rows.withColumns({n: F.shiftright("transaction_id", s) for n, s in zip(names, shifts)})
    keys = ["account_id", "transaction_date", *names]
    # From the finest level up: sums of each prefix of the keys, and the later siblings' sum.
    levels, sums = [], rows.groupBy(*keys).agg(F.sum("signed").alias("s"))
    for depth in range(len(keys), 1, -1):
        if depth < len(keys):
            sums = sums.groupBy(*keys[:depth]).agg(F.sum("s").alias("s"))
        levels.append(sums.withColumn("after", _later("s", keys[: depth - 1], keys[depth - 1])))
    # From the coarsest down: what is later on this level and on those above.
    carry = levels[-1].select(*keys[:2], F.col("after").alias("carry"))
    for depth, level in zip(range(3, len(keys) + 1), reversed(levels[:-1])):
        below = level.select(*keys[:depth], "after")
        carry = _same_keys(below, carry, keys[: depth - 1]).select(
            *[below[k] for k in keys[:depth]], (F.col("after") + F.col("carry")).alias("carry")
        )
    inside = rows.withColumn("inside", _later("signed", keys, "transaction_id"))
    return _same_keys(inside, carry, keys).select(
        *[inside[c] for c in (*_TX_COLUMNS, "signed")], (F.col("inside") + F.col("carry")).alias("later")
    )


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where NULL dates and ids equal each other."""
    return left.join(right, reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys]))


def running_balances(t: BankTables, as_of=None, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """q2c -- the balance right after each transaction, rebuilt backwards.

    Accounts with more than ``window_rows`` rows are worked through by digits; that
    changes the plan's grain, never the result.
    """
    rows = t.transactions.where(F.col("account_id").isNotNull()).select(*_TX_COLUMNS, signed_amount().alias("signed"))
    hot = F.broadcast(hot_accounts(t.transactions.where(F.col("account_id").isNotNull()), window_rows))
    in_account = (
        Window.partitionBy("account_id")
        .orderBy(F.desc_nulls_last("transaction_date"), F.desc_nulls_last("transaction_id"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    plain = rows.join(hot, "account_id", "left_anti").withColumn(
        "later", F.coalesce(F.sum("signed").over(in_account), F.lit(0))
    )
    levelled = _later_by_digits(rows.join(hot, "account_id", "left_semi"))
    owners = t.accounts.where(F.col("account_id").isNotNull()).select("account_id", "balance")
    balance = as_double(to_money("balance") - F.col("later")).alias("running_balance")
    return (
        plain.join(owners, "account_id")
        .select(*_TX_COLUMNS, balance)
        .unionByName(levelled.join(owners, "account_id").select(*_TX_COLUMNS, balance))
        .orderBy(
            F.asc_nulls_first("account_id"),
            F.asc_nulls_first("transaction_date"),
            F.asc_nulls_first("transaction_id"),
        )
    )
