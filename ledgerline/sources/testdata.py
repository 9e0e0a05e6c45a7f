"""Derive the three banking tables from the driver's TPC-H-like test tables.

The mapping is a fixed contract (``FIXTURES.md`` section 2) shared with the
DuckDB oracle, so that both engines see the same customers, accounts and
transactions.  It is written with the DataFrame API (the oracle writes it in
SQL), which makes the oracle check an independent second derivation.

Every customer, order and line item becomes one row, so each derivation is a
map-only projection: no shuffle, and filters and columns of a query reach the
scan.  This is the adapter for the driver's test tables; production input comes
from the Parquet store written by the pipeline.

``faulty_feed_from_testdata`` derives the same tables as delivered text, with
duplicated, missing and dangling keys and unreadable values in them, for the
constraint report.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.tables import BankTables

# The greatest o_orderdate at every scale factor of the test data.
TESTDATA_AS_OF = _dt.date(2001, 8, 1)


def _null(type_name: str):
    return F.lit(None).cast(type_name)


# --- fixed values of the derivation contract -------------------------------
PRIORITY_TO_ACCOUNT_TYPE = (
    ("1-URGENT", "Checking"),
    ("2-HIGH", "Savings"),
    ("3-MEDIUM", "Credit"),
    ("4-NOT SPECIFIED", "Loan"),
)
DEFAULT_ACCOUNT_TYPE = "Checking"
BIRTH_EPOCH = _dt.date(1950, 1, 1)
SHIP_EPOCH = _dt.date(1992, 1, 1)
# ---------------------------------------------------------------------------


def derive_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    return customer.select(
        k.alias("customer_id"),
        F.substring("c_name", 1, 8).alias("first_name"),
        F.substr(F.col("c_name"), F.lit(10)).alias("last_name"),
        F.when(k % 17 == 0, _null("date"))
        .otherwise(F.date_add(F.lit(BIRTH_EPOCH), (k % 18000).cast("int")))
        .alias("date_of_birth"),
        F.when(k % 7 == 0, _null("string"))
        .when(k % 7 == 1, F.lit("   "))
        .otherwise(F.col("c_mktsegment"))
        .alias("address"),
        F.col("c_nationkey").cast("string").alias("city"),
        (F.col("c_nationkey") % 5).cast("string").alias("state"),
        F.when(k % 13 == 0, F.lit(""))
        .when(k % 13 == 1, _null("string"))
        .otherwise(F.lpad(k.cast("string"), 5, "0"))
        .alias("zip"),
    )


def derive_accounts(orders: DataFrame) -> DataFrame:
    """Every order is an account.  The owner's id is moved on by one where it is a
    multiple of 11, so that some customers have none."""
    k = F.col("o_orderkey").cast("long")
    owner = F.col("o_custkey").cast("long")
    prio = F.col("o_orderpriority")
    account_type = F.when(k % 97 == 0, _null("string"))
    for priority, kind in PRIORITY_TO_ACCOUNT_TYPE:
        account_type = account_type.when(prio == priority, F.lit(kind))
    account_type = account_type.otherwise(F.lit(DEFAULT_ACCOUNT_TYPE))
    price = F.col("o_totalprice").cast("double")
    return orders.select(
        k.alias("account_id"),
        F.when(owner % 11 == 0, owner + 1).otherwise(owner).alias("customer_id"),
        account_type.alias("account_type"),
        F.col("o_orderdate").cast("date").alias("opening_date"),
        F.when(k % 101 == 0, _null("double"))
        .when((k % 5 == 0) | (k % 23 == 0), F.lit(0.0))
        .when(k % 7 == 0, -price)
        .otherwise(price)
        .alias("balance"),
    )


def derive_transactions(lineitem: DataFrame) -> DataFrame:
    """Every line item is a transaction; its ship date is part of the id, which
    (order, line, part) alone do not make unique.  On accounts whose id is a multiple
    of 23 nothing moves: amounts and balance are 0."""
    okey = F.col("l_orderkey").cast("long")
    line = F.col("l_linenumber")
    part = F.col("l_partkey").cast("long")
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.lit(SHIP_EPOCH))
    tx_type = (
        F.when(line.between(1, 3), F.lit("Deposit"))
        .when(line == 4, F.lit("Withdrawal"))
        .when(line == 5, F.lit("Payment"))
        .when(line == 6, F.lit("Transfer"))
        .when(
            line == 7,
            F.when(part % 10 == 0, _null("string"))
            .when(part % 10 == 1, F.lit("Fee"))
            .otherwise(F.lit("Withdrawal")),
        )
    )
    return lineitem.select(
        (((okey * 10 + line) * 1000000 + part) * 10000 + day).alias("transaction_id"),
        okey.alias("account_id"),
        F.when(F.col("l_suppkey") % 41 == 0, _null("date"))
        .otherwise(F.col("l_shipdate").cast("date"))
        .alias("transaction_date"),
        tx_type.alias("transaction_type"),
        F.when(part % 50 == 0, _null("double"))
        .when(okey % 23 == 0, F.lit(0.0))
        .otherwise(F.floor("l_extendedprice").cast("double") / 64)
        .alias("amount"),
        F.col("l_returnflag").alias("description"),
    )


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bank_tables_from_testdata(spark: SparkSession, sf_dir: str) -> BankTables:
    """Lazy banking tables over ``{sf_dir}/{customer,orders,lineitem}.parquet``."""
    customers = derive_customers(read_source(spark, sf_dir, "customer"))
    accounts = derive_accounts(read_source(spark, sf_dir, "orders"))
    transactions = derive_transactions(read_source(spark, sf_dir, "lineitem"))
    return BankTables(customers, accounts, transactions)


def faulty_feed_from_testdata(spark: SparkSession, sf_dir: str) -> BankTables:
    """The three tables as text, as a careless deliverer would send them."""
    clean = bank_tables_from_testdata(spark, sf_dir)

    def text(df: DataFrame, **changed) -> DataFrame:
        return df.select(*[changed.get(c, F.col(c)).cast("string").alias(c) for c in df.columns])

    cid, aid, owner = F.col("customer_id"), F.col("account_id"), F.col("customer_id")
    tid = F.col("transaction_id")
    return BankTables(
        text(
            clean.customers,
            customer_id=F.when(cid % 307 == 0, _null("long")).when(cid % 113 == 0, cid - 1).otherwise(cid),
            date_of_birth=F.when(cid % 29 == 0, F.lit("unknown")).otherwise(F.col("date_of_birth").cast("string")),
        ),
        text(
            clean.accounts,
            account_id=F.when(aid % 503 == 0, _null("long")).when(aid % 211 == 0, aid - 1).otherwise(aid),
            customer_id=F.when(aid % 331 == 0, _null("long")).when(aid % 401 == 0, -owner - 1).otherwise(owner),
            balance=F.when(aid % 89 == 0, F.lit("n/a")).otherwise(F.col("balance").cast("string")),
        ),
        text(
            clean.transactions,
            transaction_id=F.when(tid % 701 == 0, F.concat(F.lit("T"), tid.cast("string")))
            .when(tid % 601 == 0, F.lit("600"))
            .otherwise(tid.cast("string")),
            account_id=F.when(tid % 809 == 0, _null("long")).otherwise(aid),
        ),
    )


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``words`` input: one ``text`` column over the test documents."""
    return read_source(spark, sf_dir, "documents").select("text")
