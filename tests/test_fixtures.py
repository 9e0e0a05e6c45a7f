"""Hand fixtures for what the derived data cannot show (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from conftest import D, account, customer, make_tables, rows, tx

from ledgerline.operators import (
    BANKING_QUERIES,
    average_transaction_and_balance,
    balance_mismatches,
    deposits_per_customer,
    duplicate_account_types,
    invalid_transaction_types,
    large_withdrawals,
    missing_customer_fields,
    most_active_customers,
    negative_non_credit_balances,
    recent_accounts,
    running_balances,
    top_customers_by_balance,
    total_balance_by_type,
)
from ledgerline.tables import BankTables

AS_OF = D("2024-08-31")


def test_q4b_null_blank_and_present(spark):
    t = make_tables(
        spark,
        customers=[
            customer(1, dob=None),
            customer(2, address=None),
            customer(3, address="  "),
            customer(4, zip_=None),
            customer(5, zip_=""),
            customer(6, dob=None, address=" ", zip_=None),
            customer(7),
        ],
    )
    got = rows(missing_customer_fields(t))
    assert got == [
        (1, "F", "L", "date_of_birth"),
        (2, "F", "L", "address"),
        (3, "F", "L", "address"),
        (4, "F", "L", "zip"),
        (5, "F", "L", "zip"),
        (6, "F", "L", "date_of_birth,address,zip"),
    ]


def test_q4a_exact_sums_and_missing_transactions(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1, balance=0.3), account(11, 1, balance=None), account(12, 1, balance=5.0)],
        transactions=[tx(100, 10, amount=0.1), tx(101, 10, amount=0.2)],
    )
    assert rows(balance_mismatches(t)) == [(12, 5.0, 0.0)]


def test_q4a_signs_and_unknown_types(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1, balance=40.0), account(11, 1, balance=1.0)],
        transactions=[
            tx(1, 10, kind="Deposit", amount=100.0),
            tx(2, 10, kind="Withdrawal", amount=30.0),
            tx(3, 10, kind="Payment", amount=20.0),
            tx(4, 10, kind="Transfer", amount=10.0),
            tx(5, 10, kind="Fee", amount=999.0),
            tx(6, 10, kind=None, amount=999.0),
            tx(7, 11, kind="Deposit", amount=None),
        ],
    )
    # account 10: 100-30-20-10 = 40 -> consistent; account 11: NULL sum -> 0 vs 1.
    assert rows(balance_mismatches(t)) == [(11, 1.0, 0.0)]


def test_q1c_ties_and_null_total(spark):
    t = make_tables(
        spark,
        customers=[customer(i, first=f"c{i}") for i in range(1, 8)],
        accounts=[
            account(1, 1, balance=600.0),
            account(2, 2, balance=500.0),
            account(3, 3, balance=400.0),
            account(4, 4, balance=300.0),
            account(5, 6, balance=200.0),
            account(6, 5, balance=200.0),
            account(7, 7, balance=None),
        ],
    )
    got = rows(top_customers_by_balance(t))
    assert [r[0] for r in got] == ["c1", "c2", "c3", "c4", "c5"]
    assert got[-1][2] == 200.0


def test_q1c_null_total_ranks_last(spark):
    t = make_tables(
        spark,
        customers=[customer(1, first="a"), customer(2, first="b")],
        accounts=[account(1, 1, balance=None), account(2, 2, balance=-5.0)],
    )
    assert [r[0] for r in rows(top_customers_by_balance(t))] == ["b", "a"]


def test_q2c_running_balance(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1, balance=100.0)],
        transactions=[
            tx(1, 10, date="2024-01-01", kind="Deposit", amount=50.0),
            tx(2, 10, date="2024-01-02", kind="Withdrawal", amount=20.0),
            tx(3, 10, date="2024-01-03", kind="Fee", amount=7.0),
        ],
    )
    got = rows(running_balances(t))
    assert [r[-1] for r in got] == [120.0, 100.0, 100.0]


def test_q2c_ties_and_null_date(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1, balance=0.0)],
        transactions=[
            tx(5, 10, date="2024-01-02", kind="Deposit", amount=1.0),
            tx(4, 10, date="2024-01-02", kind="Deposit", amount=2.0),
            tx(9, 10, date=None, kind="Deposit", amount=4.0),
            tx(1, 10, date="2024-01-03", kind="Deposit", amount=8.0),
        ],
    )
    got = rows(running_balances(t))
    # Output order: account, date NULLS FIRST, id.  Newest (id 1) keeps the
    # balance; the NULL-dated row is the oldest.
    assert [(r[1], r[-1]) for r in got] == [(9, -11.0), (4, -9.0), (5, -8.0), (1, 0.0)]


def test_q2c_orphan_transactions_dropped(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1, balance=1.0)],
        transactions=[tx(1, 10), tx(2, 99)],
    )
    assert [r[1] for r in rows(running_balances(t))] == [1]


def test_q3b_keeps_all_ties(spark):
    t = make_tables(
        spark,
        customers=[customer(1), customer(2), customer(3)],
        accounts=[account(10, 1), account(11, 1), account(20, 2), account(30, 3)],
        transactions=[
            tx(1, 10, date="2024-08-01"),
            tx(2, 11, date="2024-08-02"),
            tx(3, 20, date="2024-08-01"),
            tx(4, 20, date="2024-08-03"),
            tx(5, 30, date="2024-08-01"),
            tx(6, 30, date="2020-01-01"),  # outside the 3 months
        ],
    )
    assert rows(most_active_customers(t, AS_OF)) == [(1, "F", "L", 2), (2, "F", "L", 2)]


def test_q3b_empty_window(spark):
    t = make_tables(spark, customers=[customer(1)], accounts=[account(10, 1)], transactions=[tx(1, 10, date="2000-01-01")])
    assert rows(most_active_customers(t, AS_OF)) == []


def test_date_bounds_month_end_and_inclusive(spark):
    # as_of 2024-08-31, 6 months -> 2024-02-29 inclusive; a future row is in.
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1)],
        transactions=[
            tx(1, 10, date="2024-02-29", amount=1.0),
            tx(2, 10, date="2024-02-28", amount=10.0),
            tx(3, 10, date="2025-01-01", amount=100.0),
        ],
    )
    assert rows(deposits_per_customer(t, D("2024-08-31"))) == [(1, 101.0)]
    # as_of 2024-02-29, 1 year -> 2023-02-28 inclusive.
    t2 = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(10, 1)],
        transactions=[tx(1, 10, date="2023-02-28", amount=2.0), tx(2, 10, date="2023-02-27", amount=4.0)],
    )
    assert rows(average_transaction_and_balance(t2, D("2024-02-29"))) == [(1, 2.0, 0.0)]


def test_q1b_365_days_inclusive(spark):
    t = make_tables(
        spark,
        customers=[customer(1, first="a")],
        accounts=[
            account(1, 1, opened="2023-09-01"),  # exactly 365 days before
            account(2, 1, opened="2023-08-31"),  # one day too old
            account(3, 1, opened="2025-01-01"),  # future
        ],
    )
    assert [r[3] for r in rows(recent_accounts(t, AS_OF))] == [3, 1]


def test_q2a_filters_and_order(spark):
    t = make_tables(
        spark,
        customers=[customer(1, first="a")],
        accounts=[account(10, 1)],
        transactions=[
            tx(1, 10, date="2024-08-30", kind="Withdrawal", amount=501.0),
            tx(2, 10, date="2024-08-30", kind="Withdrawal", amount=900.0),
            tx(3, 10, date="2024-08-01", kind="Withdrawal", amount=700.0),  # exactly 30 days
            tx(4, 10, date="2024-07-31", kind="Withdrawal", amount=700.0),  # 31 days
            tx(5, 10, date="2024-08-30", kind="Withdrawal", amount=500.0),  # not > 500
            tx(6, 10, date="2024-08-30", kind="Payment", amount=900.0),
            tx(7, 10, date="2024-08-30", kind="withdrawal", amount=900.0),  # case-sensitive
        ],
    )
    got = rows(large_withdrawals(t, AS_OF))
    assert [(r[4], r[5]) for r in got] == [(D("2024-08-30"), 900.0), (D("2024-08-30"), 501.0), (D("2024-08-01"), 700.0)]


def test_q4d_q4e_types(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[
            account(1, 1, kind=None, balance=-1.0),
            account(2, 1, kind="Credit", balance=-1.0),
            account(3, 1, kind="Loan", balance=-1.0),
            account(4, 1, kind="Loan", balance=1.0),
        ],
        transactions=[
            tx(1, 1, kind=None),
            tx(2, 1, kind="deposit"),
            tx(3, 1, kind="Fee"),
            tx(4, 1, kind="Deposit"),
        ],
    )
    assert [r[0] for r in rows(invalid_transaction_types(t))] == [1, 2, 3]
    assert rows(negative_non_credit_balances(t)) == [(3, 1, "Loan", -1.0)]


def test_q4c_and_q1a_null_type_group(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[
            account(1, 1, kind=None, balance=1.0),
            account(2, 1, kind=None, balance=2.0),
            account(3, 1, kind="Loan", balance=4.0),
        ],
    )
    assert rows(duplicate_account_types(t)) == [(1, None, 1, 2)]
    assert rows(total_balance_by_type(t)) == [(1, None, 3.0), (1, "Loan", 4.0)]


def test_q3a_zero_when_absent(spark):
    t = make_tables(
        spark,
        customers=[customer(1), customer(2), customer(3)],
        accounts=[account(10, 1, balance=10.0), account(11, 1, balance=20.0), account(20, 2, balance=None)],
        transactions=[tx(1, 10, date="2024-08-01", amount=3.0), tx(2, 11, date="2024-08-02", amount=None)],
    )
    assert rows(average_transaction_and_balance(t, AS_OF)) == [(1, 3.0, 15.0), (2, 0.0, 0.0), (3, 0.0, 0.0)]


def test_as_of_defaults_to_today(spark):
    today = dt.date.today()
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(1, 1, opened=today), account(2, 1, opened=today - dt.timedelta(days=400))],
    )
    assert [r[3] for r in rows(recent_accounts(t))] == [1]


def test_q2c_null_account_ids_match_nothing(spark):
    accounts = spark.createDataFrame(
        [(1, 1, "Loan", None, 10.0), (None, 1, "Loan", None, 50.0)],
        "account_id bigint, customer_id bigint, account_type string, opening_date date, balance double",
    )
    transactions = spark.createDataFrame(
        [(1, 1, None, "Deposit", None, 1.0), (2, None, None, "Deposit", None, 1.0), (3, None, None, "Deposit", None, 1.0)],
        "transaction_id bigint, account_id bigint, transaction_date date, transaction_type string, "
        "description string, amount double",
    )
    t = BankTables(make_tables(spark).customers, accounts, transactions)
    assert [r[1] for r in rows(running_balances(t))] == [1]
    from ledgerline.plans.sql import run_sql

    assert [r[1] for r in rows(run_sql(spark, t, "q2c", D("2024-02-01")))] == [1]


def test_money_without_exact_value_counts_as_missing(spark):
    t = make_tables(
        spark,
        customers=[customer(1)],
        accounts=[account(1, 1, balance=10.0)],
        transactions=[tx(i, 1, date="2024-01-01", amount=a) for i, a in enumerate((float("nan"), 5.0, 4.0, float("inf"), 1e23))],
    )
    assert rows(BANKING_QUERIES["q3a"](t, D("2024-02-01")))[0][1] == 4.5
    from ledgerline.plans.sql import run_sql

    assert rows(run_sql(spark, t, "q3a", D("2024-02-01")))[0][1] == 4.5
