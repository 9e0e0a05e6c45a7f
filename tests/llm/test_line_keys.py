"""op5's keys: any two lines within the edits share one, and each pair is verified one way."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerline.llm.line_dedup import line_keys, near_links, with_line_keys


def _edited(rng, line, edits):
    for _ in range(edits):
        at, kind, letter = rng.randrange(len(line)), rng.randrange(3), rng.choice("ab\u00e9\U0001f600")
        line = line[:at] + ("" if kind == 0 else letter) + line[at + (kind != 1):]
    return line


def test_lines_within_two_edits_are_found(spark):
    rng = random.Random(5)
    lines, pairs = [], []
    for k in range(60):
        line = "".join(rng.choice("abcdefgh \u00e9\U0001f600") for _ in range(rng.randrange(27, 60)))
        pairs.append((2 * k, 2 * k + 1))
        lines += [(2 * k, line), (2 * k + 1, _edited(rng, line, 2))]
    table = spark.createDataFrame([*lines, (1000, "short")], "id bigint, line string").withColumn("n", F.length("line"))
    keyed = with_line_keys(table, 2, 24)
    assert [r.id for r in keyed.where("keys is null").collect()] == [1000]
    assert {r.c for r in line_keys(keyed, 2).groupBy("id").count().withColumnRenamed("count", "c").collect()} == {12}

    def texts_of(ids):
        return table.join(ids, "id").select("id", F.lit(0).cast("long").alias("id2"), "line")

    links = near_links(keyed.where("keys is not null").select("id", "keys"), texts_of, 2)
    assert sorted((r.a, r.b) for r in links.collect()) == pairs
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN both_ways" in plan
