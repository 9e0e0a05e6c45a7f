"""Every registered query against its DuckDB oracle SQL (exact values)."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os

import pytest
from conftest import SF_ORACLE

import __spark_entry__ as entry_module
from ledgerline.plans.catalog import registered_queries
from ledgerline.plans.oracle import ORACLE_SQL

EXPECTED_ROWS = {
    # FIXTURES.md section 2, measured row counts at sf0.01.
    "q1a": 5064, "q1b": 2302, "q1c": 5, "q2a": 451, "q2b": 1125, "q2c": 60000,
    "q3a": 1500, "q3b": 1, "q4a": 14290, "q4b": 649, "q4c": 3825, "q4d": 1743,
    "q4e": 1280, "word_count": 95039,
}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in ("customer", "orders", "lineitem", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_ORACLE}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_ORACLE)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_module.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    if name in EXPECTED_ROWS:
        assert len(got) == EXPECTED_ROWS[name]
    assert _bag(got, list(df.columns)) == _bag(want, cols)


def test_every_query_has_an_oracle():
    assert set(registered_queries()) == set(ORACLE_SQL)
    assert set(registered_queries()) <= set(entry_module.queries())
    assert {f"sql_{k}" for k in EXPECTED_ROWS if k.startswith("q")} <= set(entry_module.queries())


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == [
        "account_id", "transaction_id", "transaction_date", "transaction_type", "amount", "running_balance",
    ]
    assert df.count() == 6000


def test_constraint_report_counts_faults(spark):
    found = {tuple(r)[:3]: r.violations for r in entry_module.queries()["check_constraints"](spark, SF_ORACLE).collect()}
    for check in ("primary_key_duplicate", "primary_key_null", "not_null", "foreign_key_orphan", "cast_loss"):
        assert any(n > 0 for (_, kind, _), n in found.items() if kind == check), check


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test data")
def test_row_counts_sf0001(spark):
    q = entry_module.queries()
    small = "/root/testdata/sf0.001"
    expected = {"q1a": 502, "q1b": 214, "q1c": 5, "q2a": 49, "q2b": 106, "q3a": 150, "q3b": 2,
                "q4a": 1429, "q4b": 67, "q4c": 381, "q4d": 171, "q4e": 124}
    for name, n in expected.items():
        assert q[name](spark, small).count() == n, name
