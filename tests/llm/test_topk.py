"""Top-k search: blocks of queries by need, open pairs only, large components."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk

VECTORS = "vec_id bigint, embedding array<double>"


def brute(rows, is_query, k=10, scale=1024):
    v = {i: [int(np.floor(x * scale)) for x in e] for i, e in rows}
    out = []
    for q in filter(is_query, v):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:k]
        out += [(q, rank, c, -score) for rank, (score, c) in enumerate(best, 1)]
    return sorted(out)


def got(found):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_many_blocks_equal_brute_force(spark, monkeypatch, spread):
    """Many small blocks and parts; a third of all vectors are one vector."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "PART_ROWS", 32)
    monkeypatch.setattr(topk, "SEEDS", 24)
    rng = np.random.default_rng(11)
    rows = [(i, (rng.normal(size=6) * np.exp(spread * rng.normal())).tolist()) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(100)]
    frame = spark.createDataFrame(rows, VECTORS)
    assert got(topk.top_k(frame, F.col("vec_id") % 4 == 0)) == brute(rows, lambda i: i % 4 == 0)


def test_closed_pairs_are_not_formed(spark):
    """A block whose queries need long vectors opens the buckets of long vectors only."""
    sizes = spark.createDataFrame([(2, 0, 3, 1.0), (2, 9, 2, 10.0), (3, 9, 1, 10.0)], "dim int, bucket int, parts bigint, longest double")
    queries = spark.createDataFrame([(0, 2, 5.0), (0, 2, 8.0), (1, 2, 0.5), (1, 2, 90.0), (2, 2, 11.0)], "block int, dim int, need double")
    found = {(r.block, r.dim, r.bucket, r.part) for r in topk.live_pairs(queries, sizes).collect()}
    assert found == {(0, 2, 9, 0), (0, 2, 9, 1), *[(1, 2, 0, p) for p in range(3)], (1, 2, 9, 0), (1, 2, 9, 1)}


def test_large_components(spark):
    """Squares of these overflow; scores are cut to a long's range, ties go to the smaller id."""
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1.0]), (2, [1.7e308, 1.7e308]), (3, [0.5, 0.0]), (4, [-1e306, 0.0])]
    found = got(topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0))
    top = 2**63 - 1
    assert found == [(0, 1, 1, top), (0, 2, 2, top), (0, 3, 3, top), (0, 4, 4, -top)]
