"""Hard negatives against brute force, with parts and blocks of a few rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives as hn

VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute(rows, is_anchor, scale=256, positives=5, k=10):
    valid = [
        (i, [math.floor(scale * x) for x in v], y)
        for i, v, y in rows
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, q, y in valid:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * z for x, z in zip(q, v)), i, w) for i, v, w in valid if i != a and len(v) == len(q))
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            p_score = -s
            band = [(-t, i) for t, i, w in scored if w != y and 30 * p_score <= 100 * -t <= 90 * p_score][:k]
            out += [(a, p, rank, i, p_score, t) for rank, (t, i) in enumerate(band, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, part_rows, block_rows", [(0, 17, 5), (1, 1000, 1000), (2, 40, 3)])
def test_against_brute_force(spark, monkeypatch, seed, part_rows, block_rows):
    monkeypatch.setattr(hn, "PART_ROWS", part_rows)
    monkeypatch.setattr(hn, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hn, "SEEDS", [2048, 30, 0][seed])
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(300):
        c = rng.choice(centres)
        length = rng.choice([0.2, 1, 1, 5])
        rows.append((i, [length * (x + rng.gauss(0, 0.4)) for x in c], rng.randrange(3)))
    rows += [(300 + i, [1.0, 0.5, 0.0, 0.0, -0.5, 1.0], i % 3) for i in range(60)]  # one hot vector
    df = spark.createDataFrame(rows, VECTORS)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert got(hn.mine_hard_negatives(df, F.col("vec_id") % 10 == 0)) == want


def test_invalid_rows_dimensions_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [0.5, 0.0], 1), (3, [0.6, None], 1), (4, [nan, 0.0], 1), (5, [inf, 0.0], 1),
        (6, None, 1), (7, [], 1), (8, [0.5, 0.5], None), (None, [0.5, 0.5], 1), (9, [0.5, 0.5, 0.5], 1), (10, [0.0, 0.0], 1),
        (11, [0.4, 9.0], 2), (12, [-1.0, 0.0], 0), (13, [0.5, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as row", "2 as part", "3 as block", "4 as norm", "5 as bucket")
    want = brute(rows, lambda i: i < 20)
    assert got(hn.mine_hard_negatives(df, F.col("vec_id") < 20)) == want
    assert got(hn.mine_hard_negatives(df.limit(0), F.col("vec_id") < 20)) == []
    assert got(hn.mine_hard_negatives(df, F.col("vec_id") > 99)) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.1], 1), (2, [0.5, 0.1], 1)]
    assert got(hn.mine_hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)


def test_large_components(spark):
    rows = [(0, [1e200, 0.0], 0), (1, [1e200, 1.0], 0), (2, [1e300, 1.7e308], 1), (3, [0.5, 0.0], 1), (4, [1e9, 0.0], 1), (5, [2e9, 1.0], 1)]
    found = got(hn.mine_hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 2 == 0))
    assert all(abs(s) < 2**63 for r in found for s in r[4:])


def test_labels_may_be_text_or_derived(spark):
    rows = [(i, [1.0 - i / 40, i / 40], i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS)
    text = F.concat(F.lit("l"), F.col("label").cast("string"))
    want = brute(rows, lambda i: i % 5 == 0)
    assert got(hn.mine_hard_negatives(df, F.col("vec_id") % 5 == 0, label=text)) == want
    assert got(hn.mine_hard_negatives(df.drop("label"), F.col("vec_id") % 5 == 0, label=F.col("vec_id") % 4)) == want


def test_lists_lose_nothing_and_prune():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(2000, 16))
    v = np.floor(2560 * v / np.linalg.norm(v, axis=1)[:, None])  # one length bucket
    lists = hn.CoordinateLists(v, np.linalg.norm(v, axis=1))
    pruned = 0
    for q in v[:40]:
        scores = v @ q
        for share in (0.5, 0.9, 0.97):
            bound = share * scores.max()
            at = lists.candidates(q, float(np.linalg.norm(q)), bound)
            assert set(np.flatnonzero(scores >= bound)) <= set(at)
            pruned += len(at) < len(v) // 2
    assert pruned > 20
