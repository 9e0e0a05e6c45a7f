"""Randomised differential test: all 13 queries, DataFrame and SQL forms,
against the DuckDB oracle SQL on small adversarial tables (NULL dates, types
and amounts, blank fields, orphans, duplicated account keys, ties)."""

from __future__ import annotations

import collections
import datetime as dt
import os

import pytest
from conftest import make_tables
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import BANKING_QUERIES
from ledgerline.plans.oracle import over_bank_views
from ledgerline.plans.sql import run_sql

duckdb = pytest.importorskip("duckdb")
pa = pytest.importorskip("pyarrow")

AS_OF = dt.date(2001, 8, 1)
_day = st.integers(min_value=-420, max_value=15).map(lambda d: AS_OF + dt.timedelta(days=d))
_maybe_day = st.one_of(st.none(), _day)
_money = st.one_of(st.none(), st.integers(-200, 200).map(lambda k: k * 25 / 4))
_amount = st.one_of(st.none(), st.integers(0, 40_000).map(lambda k: k / 64))

customers_st = st.lists(
    st.tuples(
        st.sampled_from(["Ann", "Bo", None]),
        st.one_of(st.none(), st.just(dt.date(1980, 1, 1))),
        st.sampled_from([None, "", "  ", "Main St"]),
        st.sampled_from([None, "", " ", "01234"]),
    ),
    min_size=1,
    max_size=6,
)
accounts_st = st.lists(
    st.tuples(
        st.integers(1, 6),  # account ids may repeat
        st.integers(1, 7),  # customer 7 may not exist
        st.sampled_from([None, "Checking", "Credit", "Loan"]),
        _maybe_day,
        _money,
    ),
    max_size=8,
)
transactions_st = st.lists(
    st.tuples(
        st.integers(1, 7),  # account 7 may not exist
        _maybe_day,
        st.sampled_from([None, "Deposit", "Withdrawal", "Payment", "Transfer", "Fee", "deposit"]),
        _amount,
    ),
    max_size=25,
)


def _arrow(rows, names, types):
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), type=t) for n, c, t in zip(names, cols, types)})


def _bag(rows):
    return collections.Counter(tuple(r) for r in rows)


@settings(max_examples=int(os.environ.get("LEDGERLINE_DIFF_EXAMPLES", "6")), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(customers=customers_st, accounts=accounts_st, transactions=transactions_st)
def test_queries_match_oracle_on_random_tables(spark, customers, accounts, transactions):
    cust = [(i + 1, f, "L", dob, addr, "c", "s", z) for i, (f, dob, addr, z) in enumerate(customers)]
    acc = list(accounts)
    txs = [(i + 1, a, d, k, amt, None) for i, (a, d, k, amt) in enumerate(transactions)]
    t = make_tables(spark, customers=cust, accounts=acc, transactions=txs)

    con = duckdb.connect()
    con.register("customers", _arrow(cust, t.customers.columns, [pa.int64(), pa.string(), pa.string(), pa.date32(), pa.string(), pa.string(), pa.string(), pa.string()]))
    con.register("accounts", _arrow(acc, t.accounts.columns, [pa.int64(), pa.int64(), pa.string(), pa.date32(), pa.float64()]))
    con.register("transactions", _arrow(txs, t.transactions.columns, [pa.int64(), pa.int64(), pa.date32(), pa.string(), pa.float64(), pa.string()]))

    for key, query in BANKING_QUERIES.items():
        res = con.execute(over_bank_views(key))
        cols = [d[0] for d in res.description]
        want = _bag(res.fetchall())
        df = query(t, AS_OF)
        assert list(df.columns) == cols, key
        assert _bag(df.collect()) == want, key
        assert _bag(run_sql(spark, t, key, AS_OF).collect()) == want, f"sql_{key}"
