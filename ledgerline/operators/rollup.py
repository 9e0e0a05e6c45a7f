"""Daily sums of transactions, and the queries that they answer.

The rollup has exact sums and counts for each (account, day, type).  The store keeps it
beside its batches (``ledgerline.batches``): each batch adds the sums of the rows that it brought
and takes off those of the versions that it replaced, so publishing reads the new rows
and the replaced ones, never the history, and reading merges the batches' parts.

q2b, q3a, q3b and q4a need no more than these sums.  Their forms here read no transaction row and return
what the direct forms return, bit for bit: the sums are decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import as_double, mean_of, months_before, since, to_money, years_before
from ledgerline.functions.domain import DEPOSIT, OUTFLOW_TYPES
from ledgerline.tables import BankTables

KEYS = ("account_id", "transaction_date", "transaction_type")
# Rows, amounts with an exact value, and their sum.
MEASURES = ("n_rows", "n_amounts", "amount_sum")


def daily_rollup(transactions: DataFrame, sign: Column | int = 1, *more: str) -> DataFrame:
    """``account_id, transaction_date, transaction_type, n_rows, n_amounts, amount_sum``; ``sign`` -1 takes rows off.
    Columns ``more`` that follow from the keys are kept."""
    amount, sign = to_money("amount"), F.lit(sign)
    return transactions.groupBy(*KEYS, *more).agg(
        F.sum(sign).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(amount.isNotNull(), sign)), F.lit(0)).cast("bigint").alias("n_amounts"),
        F.coalesce(F.sum(F.when(sign < 0, -amount).otherwise(amount)), F.lit(0)).cast("decimal(38,6)").alias("amount_sum"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """One row for each key that still has rows.

    The parts are dealt by account, as the sums for each account and the join with the accounts
    need them; an account has no more rows than days and types in each part.
    """
    sums = [F.sum(m).cast("decimal(38,6)" if m == "amount_sum" else "bigint").alias(m) for m in MEASURES]
    dealt = parts.repartition("account_id")
    return dealt.groupBy(*KEYS, *[c for c in ("month",) if c in parts.columns]).agg(*sums).where("n_rows <> 0")


def _per_account(rollup: DataFrame) -> DataFrame:
    """Sums for each account; a sum of no amounts is NULL, as the sum of its rows would be."""
    total, n = F.sum("amount_sum"), F.sum("n_amounts")
    return rollup.groupBy("account_id").agg(
        F.when(n > 0, total).alias("s"), n.alias("n"), F.sum("n_rows").alias("n_rows")
    ).where("n_rows <> 0")


def _signed() -> Column:
    kind = F.col("transaction_type")
    return (
        F.when(kind == F.lit(DEPOSIT), F.col("amount_sum")).when(kind.isin(*OUTFLOW_TYPES), -F.col("amount_sum")).otherwise(F.lit(0))
    )


def deposits_per_customer(r: DataFrame, t: BankTables, as_of=None, months: int = 6) -> DataFrame:
    """q2b on the rollup ``r``."""
    recent = r.where((F.col("transaction_type") == F.lit(DEPOSIT)) & since(r, months_before(as_of, months)))
    return (
        _per_account(recent)
        .join(t.accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(as_double(F.sum("s")).alias("total_deposits"))
        .orderBy(F.asc_nulls_first("customer_id"))
    )


def average_transaction_and_balance(r: DataFrame, t: BankTables, as_of=None) -> DataFrame:
    """q3a on the rollup ``r``."""
    owner = t.accounts.select("account_id", "customer_id")
    spent = (
        _per_account(r.where(since(r, years_before(as_of, 1))))
        .join(owner, "account_id")
        .groupBy("customer_id")
        .agg(F.sum("s").alias("tx_sum"), F.sum("n").alias("tx_n"))
    )
    money = to_money("balance")
    held = t.accounts.groupBy("customer_id").agg(F.sum(money).alias("bal_sum"), F.count(money).alias("bal_n"))
    return (
        t.customers.select("customer_id")
        .join(spent, "customer_id", "left")
        .join(held, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce(mean_of("tx_sum", "tx_n"), F.lit(0.0)).alias("avg_transaction_amount"),
            F.coalesce(mean_of("bal_sum", "bal_n"), F.lit(0.0)).alias("avg_balance"),
        )
        .orderBy(F.asc_nulls_first("customer_id"))
    )


def most_active_customers(r: DataFrame, t: BankTables, as_of=None, months: int = 3) -> DataFrame:
    """q3b on the rollup ``r``."""
    per_customer = (
        _per_account(r.where(since(r, months_before(as_of, months))))
        .join(t.accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id")
        .agg(F.sum("n_rows").alias("number_of_transactions"))
    )
    # One row, so the broadcast has a proven size.
    top = F.broadcast(per_customer.agg(F.max("number_of_transactions").alias("number_of_transactions")))
    return (
        per_customer.join(top, "number_of_transactions")
        .join(t.customers.select("customer_id", "first_name", "last_name"), "customer_id")
        .select("customer_id", "first_name", "last_name", "number_of_transactions")
        .orderBy(F.asc_nulls_first("customer_id"))
    )


def balance_mismatches(r: DataFrame, t: BankTables, as_of=None) -> DataFrame:
    """q4a on the rollup ``r``."""
    moved = r.groupBy("account_id").agg(F.sum(_signed()).alias("calc"))
    calculated = F.coalesce(F.col("calc"), F.lit(0))
    return (
        t.accounts.select("account_id", "balance")
        .join(moved, "account_id", "left")
        .where(calculated != F.coalesce(to_money("balance"), F.lit(0)))
        .select("account_id", F.col("balance").alias("account_balance"), as_double(calculated).alias("calculated_balance"))
        # The order samples its input: of an exchange, not of the sums and the join, which would run twice.
        .hint("rebalance", "account_id")
        .orderBy(F.asc_nulls_first("account_id"))
    )


ROLLUP_QUERIES = {
    "q2b": deposits_per_customer,
    "q3a": average_transaction_and_balance,
    "q3b": most_active_customers,
    "q4a": balance_mismatches,
}
