"""Registered queries of this subpackage: ``name -> fn(spark, sf_dir)``, and their SQL.

Each thin query applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import sha256_of_joined, table
from ledgerline.llm.decontaminate import benchmark_hits
from ledgerline.llm.exact_dedup import exact_duplicates
from ledgerline.llm.hard_negatives import mine_hard_negatives
from ledgerline.llm.language_id import identify_languages
from ledgerline.llm.line_dedup import dedup_lines
from ledgerline.llm.lm_score import score_texts
from ledgerline.llm.near_dedup import near_duplicates
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.pii import personal_data_digest
from ledgerline.llm.prefix_trie import trie_nodes, turn_sequences, with_shared_heads
from ledgerline.llm.sql import ORACLE_SQL
from ledgerline.llm.token_counts import token_counts
from ledgerline.llm.topk import top_k
from ledgerline.llm.toxicity import score_toxicity
from ledgerline.session import scratch_path

__all__ = ["LLM_QUERIES", "ORACLE_SQL"]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh cache each time: the query shows the whole work, not an earlier run's."""
    return token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        "n_exact",
        "n_near",
        "n_links",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_of_joined(F.col("item_ids")).alias("items_sha256"),
        "contaminated",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id carries the next label."""
    label, vec_id = F.col("label"), F.col("vec_id")
    return mine_hard_negatives(
        table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(with_shared_heads(turn_sequences(table(spark, sf_dir, "conversations"))))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_minhash,
        op3_token_counts,
        op4_toxicity,
        op5_line_dedup,
        op6_lm_score,
        op7_language_id,
        op8_pii,
        op9_packing,
        op10_decontaminate,
        op11_hard_negatives,
        op12_prefix_trie,
        op13_exact_dedup,
    )
}
