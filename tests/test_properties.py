"""Property tests: running balances, the hot-account path, type coverage."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL, account, customer, make_tables, rows, tx
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.domain import VALID_TRANSACTION_TYPES
from ledgerline.operators import invalid_transaction_types, running_balances
from ledgerline.sources.testdata import TESTDATA_AS_OF, bank_tables_from_testdata


def _signed(kind, amount):
    if amount is None:
        return None
    if kind == "Deposit":
        return amount
    if kind in ("Withdrawal", "Payment", "Transfer"):
        return -amount
    return 0.0


def test_q2c_newest_keeps_balance_and_steps_by_signed_amount(spark):
    t = bank_tables_from_testdata(spark, SF_SMALL)
    got = rows(running_balances(t, TESTDATA_AS_OF))
    balances = {r[0]: r[4] for r in rows(t.accounts)}
    by_account = {}
    for r in got:
        by_account.setdefault(r[0], []).append(r)
    assert sum(len(v) for v in by_account.values()) == 6000
    for aid, txs in by_account.items():
        # Output is oldest first; the newest row carries the current balance.
        newest = txs[-1]
        if balances[aid] is None:
            assert all(r[5] is None for r in txs)
            continue
        assert abs(newest[5] - balances[aid]) < 1e-6
        for older, newer in zip(txs, txs[1:]):
            step = _signed(newer[3], newer[4])
            if step is not None:
                assert abs((newer[5] - older[5]) - step) < 1e-6


def test_q2c_window_size_does_not_matter_on_testdata(spark):
    t = bank_tables_from_testdata(spark, SF_SMALL)
    assert rows(running_balances(t, TESTDATA_AS_OF)) == rows(running_balances(t, TESTDATA_AS_OF, window_rows=3))


_dates = st.one_of(st.none(), st.dates(min_value=dt.date(2024, 1, 1), max_value=dt.date(2024, 1, 10)))
_kinds = st.sampled_from(["Deposit", "Withdrawal", "Payment", "Transfer", "Fee", None])
_amounts = st.one_of(st.none(), st.integers(min_value=0, max_value=10_000).map(lambda c: c / 64))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.integers(1, 3), _dates, _kinds, _amounts), min_size=1, max_size=60),
    window_rows=st.integers(0, 9),
    spread=st.sampled_from([1, 2**21 - 1, 2**41 + 5, -(2**40) - 3]),
)
def test_q2c_window_size_does_not_matter(spark, data, window_rows, spread):
    accounts = [account(1, 1, balance=100.0), account(2, 1, balance=None), account(3, 1, balance=-7.5)]
    txs = [tx((i + 1) * spread, a, d, k, amt) for i, (a, d, k, amt) in enumerate(data)]
    t = make_tables(spark, customers=[customer(1)], accounts=accounts, transactions=txs)
    assert rows(running_balances(t)) == rows(running_balances(t, window_rows=window_rows))


def test_q4d_and_valid_cover_all_transactions(spark):
    t = bank_tables_from_testdata(spark, SF_SMALL)
    invalid = invalid_transaction_types(t).count()
    valid = t.transactions.where(F.col("transaction_type").isin(*VALID_TRANSACTION_TYPES)).count()
    assert invalid + valid == t.transactions.count()
