"""Advanced KPIs: average transaction vs. average balance, most active customers.

Both pre-aggregate transactions per account before any join.  The account
key is what the transactions carry; rolling up to customers afterwards
touches at most one row per account, so the big table is never shuffled
row by row and a hot account is folded map-side by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import mean_of, money_count, money_sum, months_before, since, years_before
from ledgerline.tables import BankTables


def _owner(t: BankTables) -> DataFrame:
    return t.accounts.select("account_id", "customer_id")


def average_transaction_and_balance(t: BankTables, as_of=None) -> DataFrame:
    """q3a -- per customer: mean transaction amount over the last year and mean
    account balance; 0.0 where the customer has none."""
    recent = t.transactions.where(since(t.transactions, years_before(as_of, 1)))
    per_account = recent.groupBy("account_id").agg(
        money_sum("amount").alias("tx_sum"), money_count("amount").alias("tx_n")
    )
    per_customer_tx = (
        per_account.join(_owner(t), "account_id")
        .groupBy("customer_id")
        .agg(F.sum("tx_sum").alias("tx_sum"), F.sum("tx_n").alias("tx_n"))
    )
    per_customer_bal = t.accounts.groupBy("customer_id").agg(
        money_sum("balance").alias("bal_sum"), money_count("balance").alias("bal_n")
    )
    return (
        t.customers.select("customer_id")
        .join(per_customer_tx, "customer_id", "left")
        .join(per_customer_bal, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce(mean_of("tx_sum", "tx_n"), F.lit(0.0)).alias("avg_transaction_amount"),
            F.coalesce(mean_of("bal_sum", "bal_n"), F.lit(0.0)).alias("avg_balance"),
        )
        .orderBy(F.asc_nulls_first("customer_id"))
    )


def most_active_customers(t: BankTables, as_of=None, months: int = 3) -> DataFrame:
    """q3b -- customers with the most transactions in the last ``months``; all ties.

    Instead of a DENSE_RANK over one global window (every row through a single
    partition), the top count is a two-phase MAX -- one row by construction,
    so broadcasting it is safe -- and the winners are an equi-join on it.
    """
    recent = t.transactions.where(since(t.transactions, months_before(as_of, months)))
    per_account = recent.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    per_customer = (
        per_account.join(_owner(t), "account_id")
        .groupBy("customer_id")
        .agg(F.sum("n").alias("number_of_transactions"))
    )
    top = per_customer.agg(F.max("number_of_transactions").alias("number_of_transactions"))
    winners = per_customer.join(F.broadcast(top), "number_of_transactions")
    return (
        winners.join(t.customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .select("customer_id", "first_name", "last_name", "number_of_transactions")
        .orderBy(F.asc_nulls_first("customer_id"))
    )
