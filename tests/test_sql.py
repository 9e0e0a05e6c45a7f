"""The SQL-text forms give the DataFrame results, row for row and in order."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, account, customer, make_tables, rows, tx

from ledgerline.operators import BANKING_QUERIES
from ledgerline.plans.sql import SQL_QUERIES, run_sql
from ledgerline.sources.testdata import TESTDATA_AS_OF, bank_tables_from_testdata


@pytest.fixture(scope="module")
def tables(spark):
    return bank_tables_from_testdata(spark, SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL_QUERIES))
def test_sql_equals_dataframe(spark, tables, key):
    assert rows(run_sql(spark, tables, key, TESTDATA_AS_OF)) == rows(BANKING_QUERIES[key](tables, TESTDATA_AS_OF))


def test_sql_blank_fields_and_ties(spark):
    import datetime as dt

    t = make_tables(
        spark,
        customers=[customer(1, address="  "), customer(2, zip_=""), customer(3)],
        accounts=[account(10, 1), account(20, 2)],
        transactions=[tx(1, 10, date="2024-08-01"), tx(2, 20, date="2024-08-02")],
    )
    as_of = dt.date(2024, 8, 31)
    assert rows(run_sql(spark, t, "q4b", as_of)) == [(1, "F", "L", "address"), (2, "F", "L", "zip")]
    assert [r[0] for r in rows(run_sql(spark, t, "q3b", as_of))] == [1, 2]


def test_sql_every_query_has_sql(spark):
    assert set(SQL_QUERIES) == set(BANKING_QUERIES)
