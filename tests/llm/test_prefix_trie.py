"""The conversation trie against a plain-Python trie, with blocks down to a few conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import prefix_trie as pt

TURNS = "conv_id bigint, turn int, role string, text string"


def _sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def brute(conversations):
    """conversations: id -> list of (role, text)."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        out[p] = (
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids),
            sum(out[k][5] for k in kids) or 1, own + sum(out[k][6] for k in kids), _sha(ends[p]),
        )
    return sorted(out.values(), key=lambda r: (r[1], r[0]))


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def rows_of(conversations):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, block_rows", [(0, 3), (1, 10), (2, 100_000)])
def test_random_small_alphabet(spark, monkeypatch, seed, block_rows):
    monkeypatch.setattr(pt, "BLOCK_ROWS", block_rows)
    rng = random.Random(seed)
    pool = [("u", "a"), ("a", "bb"), ("u", ""), ("", "ccc")]
    conversations = {
        rng.randrange(-1000, 100_000): [rng.choice(pool[: 2 + seed]) for _ in range(rng.randrange(1, 6))] for _ in range(150)
    }
    df = spark.createDataFrame(rows_of(conversations), TURNS)
    assert got(pt.prefix_trie(df)) == brute(conversations)


def test_hot_conversation_and_long_one(spark, monkeypatch):
    monkeypatch.setattr(pt, "BLOCK_ROWS", 7)
    hot = [("user", "hello"), ("assistant", "hi")]
    conversations = {i: list(hot) for i in range(0, 200, 2)}
    conversations |= {i: hot + [("user", f"q{i % 9}")] for i in range(1, 60, 2)}
    conversations |= {1000: hot[:1], 1001: hot[:1], 5000: [("x", str(i)) for i in range(400)], 5001: [("x", str(i)) for i in range(400)]}
    df = spark.createDataFrame(rows_of(conversations), TURNS)
    assert got(pt.prefix_trie(df)) == brute(conversations)


def test_nulls_ties_repeats_and_empty(spark):
    rows = [
        (1, None, None, "x"), (1, 0, "u", None), (1, 0, "u", None), (2, 5, "", "x"), (2, 7, "u", ""), (2, 7, "u", ""),
        (3, 1, "u", "y"), (3, 1, "a", "y"), (4, 1, "a", "y"), (4, 1, "u", "y"), (None, 1, "u", "lost"),
    ]
    tie = [("a", "y"), ("u", "y")]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as block", "2 as sequence", "3 as turns", "4 as depth")
    nodes = got(pt.prefix_trie(df))
    same = [("", "x"), ("u", ""), ("u", "")]
    wants = [brute({1: same, 2: same, 3: t, 4: t}) for t in (tie, tie[::-1])]
    assert nodes in wants  # a tie has one order for all conversations
    assert pt.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_shared_heads(spark):
    rng = random.Random(4)
    turns = {c: [("u", f"{c}-{i}") for i in range(rng.randrange(1, 8))] for c in [*range(0, 60), *range(105, 130), 200, -7]}
    want = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = turns.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        want[c] = base[:h] + own[h:]
    df = spark.createDataFrame(rows_of(turns), TURNS)
    assert any(not t for t in want.values())  # some are left without a turn
    assert got(pt.trie_nodes(pt.with_shared_heads(pt.turn_sequences(df)))) == brute(want)


def test_extents():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 4, 37)
    table = pt.RangeMinimum(values)
    for i in range(37):
        for bound in range(6):
            r, left = i, i
            while r + 1 < 37 and values[r + 1] >= bound:
                r += 1
            while left > 0 and values[left] >= bound:
                left -= 1
            at = np.array([i])
            assert table.right_extent(at, np.array([bound]))[0] == r
            assert table.left_extent(at, np.array([bound]))[0] == left
            assert table.between(at, np.array([36]))[0] == values[i:].min()


def test_common_turns():
    turn = [bytes([i]) * pt.WIDTH for i in range(4)]
    a = b"".join(turn * 5)
    assert pt.common_turns(a, a) == 20 and pt.common_turns(a, b"") == 0
    for k in range(20):
        b = a[: k * pt.WIDTH] + b"\xff" * (pt.WIDTH * 3)
        assert pt.common_turns(a, b) == pt.common_turns(b, a) == k
