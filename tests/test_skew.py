"""Hot keys: one account / one customer holding most rows.

With broadcast joins off (every table "large") and small skew thresholds,
AQE must split the hot partitions of the inner joins in q2a and q1b, and the
results must stay whole.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import re

from pyspark.sql import functions as F

from ledgerline.operators import BANKING_QUERIES, movements, running_balances
from ledgerline.tables import BankTables

AS_OF = dt.date(2024, 8, 31)


@contextlib.contextmanager
def skew_planning(spark):
    keys = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _tables(spark, n=120_000, hot_account=7, hot_customer=7):
    customers = spark.range(1000).select(
        F.col("id").alias("customer_id"),
        F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.lit("x").alias("address"),
        F.lit("c").alias("city"),
        F.lit("s").alias("state"),
        F.lit("z").alias("zip"),
    )
    accounts = spark.range(n // 10).select(
        F.col("id").alias("account_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(F.lit(hot_customer)).alias("customer_id"),
        F.lit("Loan").alias("account_type"),
        F.lit(dt.date(2024, 8, 1)).alias("opening_date"),
        F.lit(1.0).alias("balance"),
    )
    transactions = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(F.lit(hot_account)).alias("account_id"),
        F.lit(AS_OF - dt.timedelta(days=1)).alias("transaction_date"),
        F.lit("Withdrawal").alias("transaction_type"),
        F.lit(600.0).alias("amount"),
        F.lit(None).cast("string").alias("description"),
    )
    return BankTables(customers, accounts, transactions)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_q2a_hot_account_and_customer_are_split(spark):
    t = _tables(spark)
    with skew_planning(spark):
        df = BANKING_QUERIES["q2a"](t, AS_OF)
        plan = _final_plan(df)
        assert df.count() == 120_000
    assert "SortMergeJoin(skew=true) [account_id" in plan
    assert "SortMergeJoin(skew=true) [customer_id" in plan


def test_q1b_hot_customer_is_split(spark):
    t = _tables(spark)
    with skew_planning(spark):
        df = BANKING_QUERIES["q1b"](t, AS_OF)
        plan = _final_plan(df)
        assert df.count() == 12_000
    assert "SortMergeJoin(skew=true) [customer_id" in plan


def _strewn(spark, n=60_000):
    """A tenth of all rows on account 7, with ids over the whole 64-bit range."""
    t = _tables(spark, n=n)
    return BankTables(
        t.customers,
        t.accounts,
        t.transactions.withColumns(
            {
                "account_id": F.when(F.col("transaction_id") % 10 == 0, 7).otherwise(F.col("transaction_id") % 5000 + 10),
                "transaction_date": F.date_add(F.lit(AS_OF), -(F.col("transaction_id") % 37).cast("int")),
                "transaction_id": F.xxhash64("transaction_id"),
                "amount": F.col("transaction_id") / 8,
            }
        ),
    )


def test_q2c_hot_account_stays_exact(spark):
    t = _strewn(spark)
    whole = [tuple(r) for r in running_balances(t, AS_OF).collect()]
    split = [tuple(r) for r in running_balances(t, AS_OF, window_rows=100).collect()]
    assert len(whole) == 60_000
    assert whole == split


def test_q2c_no_window_beyond_its_bound(spark):
    t = _strewn(spark)
    tx = t.transactions
    assert [r[0] for r in movements.hot_accounts(tx, 100).collect()] == [7]
    levelled = movements._later_by_digits(tx.where("account_id = 7").withColumn("signed", F.lit(1).cast("decimal(28,6)")))
    plan = levelled._jdf.queryExecution().analyzed().toString()
    keys = [m.split(",")[:4] for m in re.findall(r"windowspecdefinition\(([^)]*?) DESC NULLS LAST", plan)]
    # One window for each level: partitioned by the levels above, ordered by the next digit.
    names = [[re.sub(r"#.*", "", k).strip() for k in ks] for ks in keys]
    assert sorted(map(len, names)) != [] and any("digit_21" in ks for ks in names)
    digits = tx.where("account_id = 7").selectExpr("transaction_date d", "shiftright(transaction_id, 42) h", "shiftright(transaction_id, 21) m", "transaction_id i")
    largest = [
        digits.selectExpr("count(distinct d)"),
        digits.groupBy("d").agg(F.countDistinct("h").alias("n")).selectExpr("max(n)"),
        digits.groupBy("d", "h").agg(F.countDistinct("m").alias("n")).selectExpr("max(n)"),
        digits.groupBy("d", "h", "m").agg(F.countDistinct("i").alias("n")).selectExpr("max(n)"),
    ]
    # 6000 rows: no window holds more than a day's rows of one digit.
    assert max(df.first()[0] for df in largest) < 300


def test_q2c_digits_hold_any_id(spark):
    """Window bounds by construction: days of a date's range, 22, 21 and 21 bits of an id."""
    assert movements.ID_SHIFTS == (42, 21)
    assert (dt.date.max - dt.date.min).days < 2**22
    ends = spark.sql("select shiftright(x, 42) h from values (-9223372036854775808L), (9223372036854775807L) t(x)").collect()
    assert ends[1][0] - ends[0][0] < 2**22
