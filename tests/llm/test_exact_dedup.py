"""Exact duplicates against plain Python."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm.exact_dedup import content_hash, exact_duplicates, without_exact_copies

TEXTS = [
    "a b", "a  b", "a\tb", "a\x0bb", "a b", "a b ", " a b", "", None, " ", "\n\t", "A b", "x" * 300_000, "x" * 300_000,
    "x" * 299_999, "café", "café", "a b",
]


def _want(rows):
    norm = {}
    for at, (i, text) in enumerate(rows):
        norm.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append((i, at))
    out = []
    for body, members in norm.items():
        ids = [i for i, _ in members if i is not None]
        keep = min(ids) if ids else None
        n_kept = 0
        for i, _ in members:
            kept = i == keep and not n_kept
            n_kept += kept
            out.append((i, keep, len(members), kept, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [None, 2, 0])
def test_groups_and_collisions(spark, make_docs, bits):
    rows = [(i * 7 % 17, t) for i, t in enumerate(TEXTS)] + [(99, "lone"), (98, "a b")]
    digest = content_hash if bits is None else lambda t: F.substring(content_hash(t), 1, 1 if bits else 0)
    got = exact_duplicates(make_docs([t for _, t in rows], ids=[i for i, _ in rows]), digest=digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert _got(got) == _want(rows)


@pytest.mark.parametrize("weak", [False, True])
def test_repeated_rows_and_null_ids(spark, make_docs, weak):
    rows = [(3, "A"), (3, "A"), (5, "A"), (5, "B"), (None, "B"), (None, "C"), (None, "C"), (3, "D"), (3, "A ")]
    digest = (lambda t: F.lit(b"\0")) if weak else content_hash
    got = exact_duplicates(make_docs([t for _, t in rows], ids=[i for i, _ in rows]), digest=digest)
    assert _got(got) == _want(rows)


def test_hot_text_and_growth(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "hot  text").otherwise(F.concat(F.lit("t"), (F.col("id") % 5000).cast("string"))).alias("text")
    )
    got = exact_duplicates(df).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in got} == {True: 5001, False: 24_999}


def test_empty_and_clashing_columns(spark, make_docs):
    assert exact_duplicates(make_docs([])).count() == 0
    docs = make_docs(["a b", "a  b", "c", None, ""]).withColumns(
        {"hash": F.lit("h"), "body": F.lit(1), "row": F.lit(2), "keep_id": F.lit(3), "content_sha256": F.lit(4), "a.b": F.lit(5)}
    )
    assert sorted(r["doc_id"] for r in exact_duplicates(docs).where("kept").collect()) == [0, 2, 3]
    kept = without_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["keep_id"]) for r in kept.collect()) == [(0, "a b", 3), (2, "c", 3), (3, None, 3)]


def test_without_copies_keeps_one_of_repeated_rows(spark, make_docs):
    kept = without_exact_copies(make_docs(["A", "A", "B", "A", "C", "C"], ids=[3, 3, 3, 1, None, None]))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, "A"), (3, "B"), (None, "C")], key=repr)
