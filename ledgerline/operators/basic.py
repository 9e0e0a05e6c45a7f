"""Basic queries: balances per customer, recent accounts, top customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import as_double, days_before, money_sum
from ledgerline.tables import BankTables


def total_balance_by_type(t: BankTables, as_of=None) -> DataFrame:
    """q1a -- total balance per (customer, account type).

    Partial aggregation runs before the shuffle, so a customer owning a large
    share of all accounts collapses map-side.
    """
    return (
        t.accounts.groupBy("customer_id", "account_type")
        .agg(as_double(money_sum("balance")).alias("total_balance"))
        .orderBy(F.asc_nulls_first("customer_id"), F.asc_nulls_first("account_type"))
    )


def recent_accounts(t: BankTables, as_of=None, days: int = 365) -> DataFrame:
    """q1b -- accounts opened on or after ``as_of - days``, with the owner's name.

    No upper bound: accounts dated after ``as_of`` stay in.  account_id breaks
    ties so the range-partitioned sort can split a busy day.
    """
    opened = t.accounts.where(F.col("opening_date") >= days_before(as_of, days)).select(
        "customer_id", "account_id", "opening_date"
    )
    owners = t.customers.select("customer_id", "first_name", "last_name")
    return (
        opened.join(owners, "customer_id")
        .select("customer_id", "first_name", "last_name", "account_id", "opening_date")
        .orderBy(
            F.desc_nulls_last("opening_date"),
            F.asc_nulls_first("customer_id"),
            F.asc_nulls_first("account_id"),
        )
    )


def top_customers_by_balance(t: BankTables, as_of=None, n: int = 5) -> DataFrame:
    """q1c -- the ``n`` customers with the highest total balance.

    NULL totals rank last, ties go to the lower customer_id.  Planned as
    TakeOrderedAndProject: each partition keeps its own top ``n``.
    """
    totals = t.accounts.groupBy("customer_id").agg(money_sum("balance").alias("total"))
    owners = t.customers.select("customer_id", "first_name", "last_name")
    return (
        totals.join(owners, "customer_id")
        .orderBy(F.desc_nulls_last("total"), F.asc_nulls_first("customer_id"))
        .limit(n)
        .select("first_name", "last_name", as_double("total").alias("total_balance"))
    )
