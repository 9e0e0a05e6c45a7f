"""Candidate families of the near-duplicate join: pairs that met within the radius, nothing wider."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerline.llm import near_dedup as nd

SETS = "node bigint, digest binary, sig binary"


def components(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("block", [8, 1024])
@pytest.mark.parametrize("percent", [80, 85])
def test_families_are_components_of_close_pairs(spark, monkeypatch, block, percent):
    """Chains and stars of signatures, many of which meet their key's smallest set only beyond the radius."""
    monkeypatch.setattr(nd, "SIGNATURE_BLOCK", block)
    rng = np.random.default_rng(percent)
    radius = nd.radius_of(percent)
    sigs = []
    for _ in range(12):
        start = rng.integers(0, 2**16, nd.HASHES, dtype=np.uint16)
        for _ in range(rng.integers(1, 25)):
            other = (start if rng.random() < 0.5 else sigs[-1] if sigs else start).copy()
            other[rng.choice(nd.HASHES, rng.integers(0, 2 * radius), replace=False)] = rng.integers(0, 2**16)
            sigs.append(other)
    order = rng.permutation(len(sigs))
    sigs = [sigs[i] for i in order]
    rows = [(i, b"%d" % i, s.astype("<u2").tobytes()) for i, s in enumerate(sigs)]
    close = [(i, j) for j in range(len(sigs)) for i in range(j) if (sigs[i] != sigs[j]).sum() <= radius]
    want = components(len(sigs), close)
    met = {i for pair in close for i in pair}
    found = {r.node: r.family for r in nd.candidate_families(spark.createDataFrame(rows, SETS), percent).collect()}
    assert found == {i: want[i] for i in met}


def test_sets_that_share_an_id_do_not_hide_others(spark):
    """Two sets of one id under the same keys as a third set: the key's members are told apart by digest."""
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**16, nd.HASHES, dtype=np.uint16)
    b = rng.integers(0, 2**16, nd.HASHES, dtype=np.uint16)
    rows = [(n, bytes([k]), s.astype("<u2").tobytes()) for k, (n, s) in enumerate([(1, a), (3, a), (3, a), (9, a), (1, b), (5, b), (5, b), (9, b)])]
    found = {r.node: r.family for r in nd.candidate_families(spark.createDataFrame(rows, SETS), 85).collect()}
    assert found == {1: 1, 3: 1, 5: 1, 9: 1}


def test_loosely_similar_texts_make_no_family(spark, make_docs):
    """Of texts that share a third of their shingles most meet under common keys, but nothing is compared on full sets."""
    rng = random.Random(4)
    common = [f"c{rng.randrange(10**6)}" for _ in range(60)]
    texts = []
    for i in range(400):
        own = [f"w{i}x{j}" for j in range(56)]
        texts.append(" ".join(common + own))
    sets = [set(nd.shingles(t).tolist()) for t in texts]
    similarity = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert 0.3 < similarity < 0.4
    rows = [(i, b"%d" % i, nd.signature(nd.shingles(t)).astype("<u2").tobytes()) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, SETS)
    assert nd.met_sets(frame, 85).select("node").distinct().count() > len(texts) / 2
    assert nd.candidate_families(frame, 85).count() == 0
    got = nd.near_duplicates(make_docs(texts))
    assert got.where("kept").count() == len(texts)
