from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.schemas import ACCOUNTS, CUSTOMERS, TRANSACTIONS  # noqa: E402
from ledgerline.tables import BankTables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("ledgerline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleaned by pattern)."""
    return tempfile.mkdtemp(prefix="ledgerline-test-")


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def customer(cid, first="F", last="L", dob="1980-01-01", address="Main St", city="c", state="s", zip_="12345"):
    return (cid, first, last, D(dob) if isinstance(dob, str) else dob, address, city, state, zip_)


def account(aid, cid, kind="Checking", opened="2020-01-01", balance=0.0):
    return (aid, cid, kind, D(opened) if isinstance(opened, str) else opened, balance)


def tx(tid, aid, date="2020-01-01", kind="Deposit", amount=1.0, desc=None):
    return (tid, aid, D(date) if isinstance(date, str) else date, kind, amount, desc)


def make_tables(spark, customers=(), accounts=(), transactions=()) -> BankTables:
    return BankTables(
        spark.createDataFrame(list(customers), CUSTOMERS),
        spark.createDataFrame(list(accounts), ACCOUNTS),
        spark.createDataFrame(list(transactions), TRANSACTIONS),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]
