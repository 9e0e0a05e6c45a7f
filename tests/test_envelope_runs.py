"""The envelope by run: pages from the newest run, typed read-back, replay."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks import envelope_runs
from ledgerline.sinks.envelope_runs import latest_page, run_schema, runs_of, unpack_history, unpack_run, write_envelope_run
from ledgerline.sinks.results import to_envelope

DAY = dt.datetime(2024, 1, 1, 6)


def _result(spark, n, extra=False):
    rows = spark.range(n).selectExpr("id as k", "cast(id / 8 as double) as amount", "if(id % 3 = 0, null, date'2024-01-31') as day", "cast(1.5e7 + id as decimal(20,2)) as total")
    return rows.withColumn("note", F.lit('a "quoted", text')) if extra else rows


def test_newest_page_opens_one_runs_files(spark, scratch):
    one = write_envelope_run(_result(spark, 60), "q", scratch, DAY)
    assert len(glob.glob(f"{one}/part-*.parquet")) == 1  # small results are one file
    # 400 older runs whose files are rubbish: whoever opens one fails.
    import os

    for i in range(1, 401):
        at = DAY - dt.timedelta(hours=7 * i)
        folder = f"{scratch}/query_id=q/run_day={at:%Y-%m-%d}/run={at:%Y%m%dT%H%M%S%f}"
        os.makedirs(folder)
        with open(f"{folder}/part-0.parquet", "w") as out:
            out.write("not parquet")
    assert len(runs_of(spark, scratch, "q")) == 401
    assert len(runs_of(spark, scratch, "q", since=DAY.date())) == 1
    page = [r.row_json for r in latest_page(spark, scratch, "q", 50).collect()]
    assert len(page) == 50 and page == sorted(page)


def test_page_goes_back_as_far_as_it_needs(spark, scratch):
    for i, n in enumerate((30, 0, 30, 5)):
        write_envelope_run(_result(spark, n), "q", scratch, DAY + dt.timedelta(days=i))
    newest = runs_of(spark, scratch, "q")
    with open(glob.glob(f"{newest[-1]}/part-*.parquet")[0], "w") as out:
        out.write("not parquet")
    assert latest_page(spark, scratch, "q", 35).count() == 35
    assert latest_page(spark, scratch, "other").count() == 0
    with pytest.raises(Exception):
        latest_page(spark, scratch, "q", 36).count()


def test_run_written_again_leaves_its_rows_once(spark, scratch):
    for _ in range(2):
        folder = write_envelope_run(_result(spark, 7), "q", scratch, DAY)
    assert unpack_run(spark, folder).count() == 7
    aware = dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert write_envelope_run(_result(spark, 7), "q", scratch, aware) == folder


def test_typed_read_back_and_changed_columns(spark, scratch):
    first = write_envelope_run(_result(spark, 9), "q", scratch, DAY)
    second = write_envelope_run(_result(spark, 4, extra=True), "q", scratch, DAY + dt.timedelta(days=1))
    for folder, want in ((first, _result(spark, 9)), (second, _result(spark, 4, extra=True))):
        back = unpack_run(spark, folder)
        assert [f.dataType for f in run_schema(spark, folder)] == [f.dataType for f in want.schema]
        assert back.dtypes == want.dtypes and sorted(back.collect()) == sorted(want.collect())
    history = unpack_history(spark, scratch, "q")
    assert history.columns == ["run_ts", "k", "amount", "day", "total", "note"]
    assert history.groupBy("run_ts").agg(F.count("note").alias("n"), F.count("k").alias("k")).orderBy("run_ts").select("n", "k").collect() == [(0, 9), (4, 4)]
    assert unpack_history(spark, scratch, "q", since=dt.date(2024, 1, 2)).count() == 4


def test_columns_are_dealt_not_their_json_text(spark, scratch, monkeypatch):
    seen = []

    def noted(df, *args):
        seen.append(df._jdf.queryExecution().analyzed().toString())
        return to_envelope(df, *args)

    monkeypatch.setattr(envelope_runs, "to_envelope", noted)
    folder = envelope_runs.write_envelope_run(spark.range(3), "q", scratch, dt.datetime(2024, 1, 1))
    assert "Rebalance" in seen[0] or "rebalance" in seen[0]
    assert spark.read.parquet(folder).count() == 3
