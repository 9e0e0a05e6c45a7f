"""Rows that are written once leave no shuffle files behind."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, written

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


@pytest.mark.parametrize("make", [cut, lambda df: written(df, "scratch-test")], ids=["cut", "written"])
def test_shuffle_files_go_with_the_action(spark, make):
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    sums = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    rows = make(sums)
    for _ in range(50):  # they go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP, None) == setting
    assert {tuple(r) for r in rows.collect()} == {(k, sum(range(k, 5000, 7))) for k in range(7)}
    assert sums.count() == 7
