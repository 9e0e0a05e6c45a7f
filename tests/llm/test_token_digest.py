"""op3's digests: made once for each pass, equal where the counts must be equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm.token_counts import token_counts, with_digest
from ledgerline.session import scratch_path


def test_digest_of_a_document_is_computed_once_for_the_join(spark, make_docs):
    got = token_counts(make_docs(["One two", "one  TWO", "", None]), scratch_path(spark, "cache"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    rows = sorted(tuple(r) for r in got.collect())
    assert [r[1] for r in rows] == [7, 8, 0, 0] and rows[0][2] == rows[1][2] > 0 and rows[2][2] == rows[3][2] == 0


def test_digest_folds_ascii_case_and_white_space_only(spark):
    same = [
        ["a b", "A B", "a\nb", "A \t\n b", "a\r\nB", "a\x0b\x0cb", "a  b"],
        ["\u00e9 a", "\u00e9\tA"], ["\u00c9 a"], ["e\u0301 A"], ["e\u0301 a"], ["ab"], [" a b"], ["a b "], ["<| a"], ["<| A"], ["<|  a"], ["\x1ca b"], [""],
    ]
    texts = [(k, t) for k, group in enumerate(same) for t in group]
    docs = spark.createDataFrame(texts, "k int, text string")
    found = with_digest(docs, "v").groupBy("digest").agg(F.collect_set("k").alias("ks"), F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r.ks, r.n) for r in found) == [([k], len(group)) for k, group in enumerate(same)]
