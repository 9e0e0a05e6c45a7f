"""The store of published batches: versions, replay, month pruning, quarantine, compaction."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from conftest import SF_SMALL, account, customer, make_tables, rows, tx

from ledgerline import batches
from ledgerline.batches import compact_store, drop_compacted, publish_batch, published, read_rejected, read_store
from ledgerline.operators import BANKING_QUERIES
from ledgerline.plans.pipeline import run_pipeline
from ledgerline.sources.csv import read_csv_rejects, read_csv_table
from ledgerline.sources.testdata import TESTDATA_AS_OF, bank_tables_from_testdata
from ledgerline.schemas import ACCOUNTS

AS_OF = dt.date(2024, 8, 31)


def _day1(spark):
    return make_tables(
        spark,
        customers=[customer(1), customer(2)],
        accounts=[account(10, 1, balance=100.0), account(20, 2, balance=5.0)],
        transactions=[tx(1, 10, date="2024-08-01", amount=100.0), tx(2, 20, date="2023-01-05", amount=5.0), tx(3, 20, date=None)],
    )


def _publish(spark, tables, store, batch):
    return publish_batch(spark, dict(tables.items()), store, batch)


def _balances(spark, store, **kw):
    return sorted((r.account_id or 0, r.balance) for r in read_store(spark, store, **kw).accounts.collect())


def test_changed_balance_changes_the_queries_on_day_two(spark, scratch):
    _publish(spark, _day1(spark), scratch, "d1")
    day2 = make_tables(
        spark,
        customers=[customer(1), customer(2)],
        accounts=[account(10, 1, balance=100.0), account(20, 2, balance=7.5), account(30, 1, balance=1.0)],
        transactions=[tx(2, 20, date="2023-01-05", amount=5.0), tx(4, 20, date="2024-08-30", amount=2.5)],
    )
    counts = _publish(spark, day2, scratch, "d2")
    assert counts["accounts"] | {"malformed": 0} == {
        "delivered": 3, "new": 1, "changed": 1, "equal": 1, "no_key": 0, "replaced": 1, "written": 2, "malformed": 0}
    assert (counts["transactions"]["equal"], counts["transactions"]["new"]) == (1, 1)
    t = read_store(spark, scratch)
    assert _balances(spark, scratch) == [(10, 100.0), (20, 7.5), (30, 1.0)]
    assert [tuple(r) for r in BANKING_QUERIES["q1a"](t).collect()] == [(1, "Checking", 101.0), (2, "Checking", 7.5)]
    # q4a: account 20 now differs (5 + 2.5 with the undated deposit of 1), 30 has no transactions.
    assert [r[0] for r in rows(BANKING_QUERIES["q4a"](t))] == [20, 30]
    assert _balances(spark, scratch, upto="d1") == [(10, 100.0), (20, 5.0)]


def test_versions_change_back_and_repeats_stay_together(spark, scratch):
    def day(batch, *accounts):
        return publish_batch(spark, {"accounts": make_tables(spark, accounts=accounts).accounts}, scratch, batch)["accounts"]

    day("a", account(1, 1, balance=1.0), account(2, 1, balance=2.0))
    day("b", account(1, 1, balance=9.0))
    day("c", account(1, 1, balance=1.0))  # back to the first value
    assert _balances(spark, scratch) == [(1, 1.0), (2, 2.0)]
    n = day("d", account(1, 1, balance=1.0), account(1, 1, balance=3.0))
    assert (n["changed"], n["replaced"], n["equal"]) == (2, 1, 0)
    assert _balances(spark, scratch) == [(1, 1.0), (1, 3.0), (2, 2.0)]
    n = day("e", account(1, 1, balance=3.0))  # already among the current rows
    assert (n["written"], n["equal"]) == (0, 1)
    n = day("f", account(1, 1, balance=float("nan")), account(1, 1, balance=None))
    assert (n["changed"], n["replaced"]) == (2, 1)  # both rows belong to batch d
    assert day("g", account(1, 1, balance=float("nan")))["equal"] == 1
    assert read_store(spark, scratch).accounts.count() == 3


def test_rows_without_key_are_written_and_nothing_else_repeats(spark, scratch):
    accounts = spark.createDataFrame([(None, 1, "Loan", None, 1.0), (5, 1, "Loan", None, 5.0)], "account_id bigint, customer_id bigint, account_type string, opening_date date, balance double")
    first = publish_batch(spark, {"accounts": accounts}, scratch, "a")["accounts"]
    again = publish_batch(spark, {"accounts": accounts}, scratch, "a")["accounts"]
    assert first == again and first["no_key"] == 1
    later = publish_batch(spark, {"accounts": accounts}, scratch, "b")["accounts"]
    assert (later["no_key"], later["equal"], later["written"]) == (1, 1, 1)
    assert _balances(spark, scratch) == [(0, 1.0), (0, 1.0), (5, 5.0)]
    only_null = accounts.where("account_id is null")
    assert publish_batch(spark, {"accounts": only_null}, scratch, "c")["accounts"]["no_key"] == 1
    empty = publish_batch(spark, {"accounts": accounts.limit(0)}, scratch, "d")["accounts"]
    assert empty["written"] == 0 and len(_balances(spark, scratch)) == 4


def _folders(folder):
    """Folders with files; how many files each has is the adaptive plan's choice."""
    return sorted({os.path.dirname(os.path.relpath(f, folder)) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)})


def test_run_that_ends_between_two_tables_is_invisible_and_can_be_repeated(spark, scratch, monkeypatch):
    whole, broken = f"{scratch}/whole", f"{scratch}/broken"
    day2 = make_tables(
        spark, customers=[customer(1), customer(3)], accounts=[account(10, 1, balance=50.0)],
        transactions=[tx(1, 10, date="2024-08-01", amount=90.0), tx(9, 10, date="2024-08-20")],
    )
    report = {}
    for base in (whole, broken):
        run_pipeline(spark, _day1(spark), f"{base}/store", f"{base}/out", as_of=AS_OF - dt.timedelta(days=1))
        if base == broken:
            real = batches._write_table

            def ends(spark_, delivered, store, table, *rest):
                if table == "transactions":
                    raise KeyboardInterrupt("the machine went away")
                return real(spark_, delivered, store, table, *rest)

            before = rows(read_store(spark, f"{base}/store").accounts)
            monkeypatch.setattr(batches, "_write_table", ends)
            with pytest.raises(KeyboardInterrupt):
                run_pipeline(spark, day2, f"{base}/store", f"{base}/out", as_of=AS_OF)
            monkeypatch.undo()
            assert sorted(rows(read_store(spark, f"{base}/store").accounts)) == sorted(before)  # nothing is visible
        run_pipeline(spark, day2, f"{base}/store", f"{base}/out", as_of=AS_OF)
        if base == broken:
            run_pipeline(spark, day2, f"{base}/store", f"{base}/out", as_of=AS_OF)  # and once more, for nothing
        store = read_store(spark, f"{base}/store")
        report[base] = (
            [sorted(rows(df), key=repr) for _, df in store.items()],
            {key: sorted(rows(spark.read.parquet(f"{base}/out/{key}")), key=repr) for key in (*BANKING_QUERIES, "_constraints")},
            [(m["number"], m["batch"], m["tables"]) for m in published(spark, f"{base}/store")],
            _folders(f"{base}/store"),
        )
    assert report[whole] == report[broken]
    checks = {(r[0], r[1]): r[3] for r in report[whole][1]["_constraints"] if r[1].startswith("row_")}
    assert checks[("accounts", "row_changed")] == 1 and checks[("customers", "row_new")] == 1
    assert checks[("transactions", "row_changed")] == 1 and checks[("transactions", "row_new")] == 1


def test_two_writers_one_fails(spark, scratch):
    publish_batch(spark, {"accounts": _day1(spark).accounts}, scratch, "a")
    taken = {"number": 1, "batch": "late", "tables": {}}
    with pytest.raises(RuntimeError, match="another batch"):
        batches._publish_marker(spark, scratch, taken)
    assert [m["batch"] for m in published(spark, scratch)] == ["a"]
    for bad in ("", "a/b", "x=1", " a"):
        with pytest.raises(ValueError):
            publish_batch(spark, {}, scratch, bad)
    with pytest.raises(ValueError):
        read_store(spark, scratch, upto="unknown")


def test_old_months_are_not_opened(spark, scratch):
    tables = bank_tables_from_testdata(spark, SF_SMALL)
    publish_batch(spark, dict(tables.items()), scratch, "d1")
    store = read_store(spark, scratch)
    for key in ("q2a", "q2b", "q3a", "q3b"):
        plan = BANKING_QUERIES[key](store, TESTDATA_AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan, key
        want = sorted(rows(BANKING_QUERIES[key](tables, TESTDATA_AS_OF)), key=repr)
        assert sorted(rows(BANKING_QUERIES[key](store, TESTDATA_AS_OF)), key=repr) == want
    months = sorted(os.path.basename(f) for f in glob.glob(f"{scratch}/transactions/batch=d1/month=*"))
    assert "month=__HIVE_DEFAULT_PARTITION__" in months and len(months) > 50
    # Old months hold rubbish now: whoever opens them fails.
    for folder in months[:40] + months[-1:]:
        for f in glob.glob(f"{scratch}/transactions/batch=d1/{folder}/*.parquet"):
            with open(f, "w") as out:
                out.write("not parquet")
    fresh = read_store(spark, scratch)
    for key in ("q2a", "q2b", "q3a", "q3b"):
        want = sorted(rows(BANKING_QUERIES[key](tables, TESTDATA_AS_OF)), key=repr)
        assert sorted(rows(BANKING_QUERIES[key](fresh, TESTDATA_AS_OF)), key=repr) == want


def test_tables_without_changed_keys_are_read_without_a_join(spark, scratch):
    _publish(spark, _day1(spark), scratch, "d1")
    publish_batch(spark, {"accounts": make_tables(spark, accounts=[account(20, 2, balance=6.0)]).accounts}, scratch, "d2")
    store = read_store(spark, scratch)
    assert "Join" not in store.transactions._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in store.accounts._jdf.queryExecution().optimizedPlan().toString()


def test_compaction_keeps_rows_and_drops_old_folders(spark, scratch):
    _publish(spark, _day1(spark), scratch, "d1")
    publish_batch(spark, {"accounts": make_tables(spark, accounts=[account(20, 2, balance=6.0)]).accounts}, scratch, "d2")
    before = [sorted(rows(df), key=repr) for _, df in read_store(spark, scratch).items()]
    compact_store(spark, scratch, "c1")
    assert compact_store(spark, scratch, "c1")["accounts"]["written"] == 2
    assert [sorted(rows(df), key=repr) for _, df in read_store(spark, scratch).items()] == before
    assert _balances(spark, scratch, upto="d1") == [(10, 100.0), (20, 5.0)]
    assert drop_compacted(spark, scratch) == ["d1", "d2"]
    assert [sorted(rows(df), key=repr) for _, df in read_store(spark, scratch).items()] == before
    n = publish_batch(spark, {"accounts": make_tables(spark, accounts=[account(20, 2, balance=8.0)]).accounts}, scratch, "d3")
    assert n["accounts"]["replaced"] == 1 and _balances(spark, scratch) == [(10, 100.0), (20, 8.0)]


HEADER = "account_id,customer_id,account_type,opening_date,balance"


def _csv_feed(folder, lines):
    os.makedirs(folder, exist_ok=True)
    feed = {
        "customers": ("customer_id,first_name,last_name,date_of_birth,address,city,state,zip", ["1,a,b,1980-01-01,x,c,s,01234", "2,short"]),
        "accounts": (HEADER, lines),
        "transactions": ("transaction_id,account_id,transaction_date,transaction_type,amount,description", ["100,10,2020-01-02,Deposit,5.5,x", "101,10,2020-01-02,Deposit,5.5,x,y,z"]),
    }
    for name, (header, body) in feed.items():
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write("\n".join([header, *body]) + "\n")


def test_malformed_records_are_quarantined_and_counted(spark, scratch):
    lines = ["10,1,Loan,2020-01-01,5.0", "11,1,Loan,2020-01-01,5.0,EXTRA", "12,1,Loan", '13,1,"a,b",2020-01-01,"6"', '14,1,"open,2020-01-01,6', "15,1,Loan,bad,1"]
    _csv_feed(f"{scratch}/csv", lines)
    path = f"{scratch}/csv/accounts.csv"
    assert sorted(r.account_id for r in read_csv_table(spark, path, ACCOUNTS).collect()) == [10, 13, 15]
    found = {r.record: (r.reason, r.n_fields) for r in read_csv_rejects(spark, path, ACCOUNTS).collect()}
    assert found == {lines[1]: ("too_many_fields", 6), lines[2]: ("too_few_fields", 3), lines[4]: ("unreadable", 5)}
    for _ in range(2):  # a rerun counts and keeps the same
        run_pipeline(spark, f"{scratch}/csv", f"{scratch}/store", f"{scratch}/out", as_of=AS_OF, queries=["q1a"])
        report = {(r[0], r[1], r[2]): r[3] for r in rows(spark.read.parquet(f"{scratch}/out/_constraints"))}
        assert [report[(t, "malformed_record", None)] for t in ("customers", "accounts", "transactions")] == [1, 3, 1]
        assert report[("accounts", "cast_loss", "opening_date")] == 1 and report[("accounts", "row_new", "account_id")] == 3
        kept = read_rejected(spark, f"{scratch}/store", "accounts").collect()
        assert sorted(r.record for r in kept) == sorted(found) and all(r.file.endswith("accounts.csv") for r in kept)
    assert read_rejected(spark, f"{scratch}/store", "customers").first().reason == "too_few_fields"


def test_stream_quarantines_and_replays(spark, scratch):
    from ledgerline.streaming import ingest_landing

    os.makedirs(f"{scratch}/landing")
    for name, body in (("customers", "customer_id,first_name,last_name,date_of_birth,address,city,state,zip\n1,a,b,,,,,\n"),
                       ("accounts", HEADER + "\n10,1,Loan,2020-01-01,5.0\n11,1\n"),
                       ("transactions", "transaction_id,account_id,transaction_date,transaction_type,amount,description\n")):
        os.makedirs(f"{scratch}/landing/{name}")
        with open(f"{scratch}/landing/{name}/day1.csv", "w") as out:
            out.write(body)
    ingest_landing(spark, f"{scratch}/landing", f"{scratch}/store", f"{scratch}/ckpt")
    assert _balances(spark, f"{scratch}/store") == [(10, 5.0)]
    assert [(r.reason, r.record) for r in read_rejected(spark, f"{scratch}/store", "accounts").collect()] == [("too_few_fields", "11,1")]
    # The same epoch again, as after a failure before the checkpoint's commit.
    marks = published(spark, f"{scratch}/store")
    for f in glob.glob(f"{scratch}/ckpt/accounts/commits/*") + glob.glob(f"{scratch}/ckpt/accounts/commits/.*.crc"):
        os.remove(f)
    with open(f"{scratch}/landing/accounts/day2.csv", "w") as out:
        out.write(HEADER + "\n10,1,Loan,2020-01-01,6.0\n")
    ingest_landing(spark, f"{scratch}/landing", f"{scratch}/store", f"{scratch}/ckpt")
    assert _balances(spark, f"{scratch}/store") == [(10, 6.0)]
    after = published(spark, f"{scratch}/store")
    assert after[: len(marks)] == marks and len(after) == len(marks) + 1


def test_second_batch_deals_both_sides_once_by_key(spark, scratch):
    day = make_tables(spark, accounts=[account(1, 1, balance=0.0), account(2, 1, balance=float("nan")), account(3, 1, balance=3.0), account(3, 1, balance=4.0)])
    publish_batch(spark, {"accounts": day.accounts}, scratch, "a")
    # 0.0 and -0.0 are equal, NaN equals itself; of key 3 one of two rows changes, so both are replaced.
    second = [account(1, 1, balance=-0.0), account(2, 1, balance=float("nan")), account(3, 1, balance=3.0), account(3, 1, balance=5.0), account(4, 1)]
    delivered = make_tables(spark, accounts=second).accounts
    current = batches._rows_of(spark, scratch, "accounts", batches.published(spark, scratch))
    decided = batches._decided(delivered, current, delivered.columns, "account_id")
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan
    n = publish_batch(spark, {"accounts": delivered}, scratch, "b")["accounts"]
    assert (n["delivered"], n["new"], n["changed"], n["equal"], n["replaced"], n["written"]) == (5, 1, 2, 2, 1, 3)
    held = sorted((r.account_id, r.balance) for r in read_store(spark, scratch).accounts.collect() if r.account_id != 2)
    assert held == [(1, 0.0), (3, 3.0), (3, 5.0), (4, 0.0)]
