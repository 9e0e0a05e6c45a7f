"""Token counts through a digest cache.

The key of a text is the SHA-256 digest of the tokenizer's version and the
normalised content.  Counts already stored under that key are joined; only
distinct missing contents are encoded, and their counts are appended to the
cache (a Parquet table partitioned by tokenizer version).  The result is then
one join of the documents' digests with the cache.

The normalisation must not change a count.  The tokenizer folds white space
and case itself, so runs of ASCII white space become one space, and A-Z become
a-z unless the text has combining marks (composition and case folding do not
commute then).  Texts with ``<|`` are kept as they are, since special strings are
matched before the tokenizer normalises.  ``fold=False`` keys on the raw text
instead, for tokenizers that keep white space and case.

Defined results: a NULL text counts as empty (0 tokens); repeated texts and
rows are counted alike; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerline.llm.tokenizers_cached import chunk_counter, public_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CACHE_SCHEMA = "digest binary, n_tokens bigint, version string"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: a changed file never meets old counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()[:32]


def with_digest(docs: DataFrame, version: str, fold: bool = True) -> DataFrame:
    """``docs`` (whose ``text`` has no NULL) with ``digest``: the key of each text."""
    text, plain, spaced = F.col("text"), F.col("plain_text"), F.col("spaced_text")
    raw = F.concat(F.lit("raw:"), text)
    if not fold:
        return docs.withColumn("digest", _digest(raw, version))
    # Columns of their own: inside one expression each use would compute them again.
    # Most texts have no white space but single spaces and line breaks; those need no pattern.
    odd = plain.contains("  ")
    for space in ("\t", "\x0b", "\f", "\r"):
        odd = odd | plain.contains(space)
    folded = (
        F.when(F.octet_length(spaced) == F.length(spaced), F.lower(spaced))  # ASCII only
        .when(spaced.rlike("\\p{M}"), spaced)
        .otherwise(F.translate(spaced, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    )
    return (
        docs.withColumn("plain_text", F.replace(text, F.lit("\n"), F.lit(" ")))
        .withColumn("spaced_text", F.when(odd, F.regexp_replace(plain, "[ \\t-\\r]+", " ")).otherwise(plain))
        .withColumn("digest", _digest(F.when(text.contains("<|"), raw).otherwise(F.concat(F.lit("folded:"), folded)), version))
        .drop("plain_text", "spaced_text")
    )


def _digest(content: Column, version: str) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(f"{version}:"), content).cast("binary"), 256))


def _count(text: Column, path: str) -> Column:
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = chunk_counter(path)
        for texts in batches:
            # A few texts at a time: the words of a batch are held together.
            parts = [counter.counts(list(texts.iloc[i : i + 500])) for i in range(0, len(texts), 500)]
            yield pd.Series([n for part in parts for n in part], dtype="int64")

    return F.pandas_udf(count, "bigint")(text)


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """Stored (digest, n_tokens) of one tokenizer version, one row for each digest."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, cache_path: str, *, tokenizer_path: str | None = None, limit: int = LIMIT, fold: bool = True
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``."""
    spark = docs.sparkSession
    path = tokenizer_path or public_path(TOKENIZER)
    version = tokenizer_version(path)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = with_digest(texts, version, fold).withColumn("n_bytes", F.octet_length("text").cast("long"))
    # One text for each digest (partial aggregation folds a hot text inside each task).
    misses = (
        keyed.groupBy("digest")
        .agg(F.first("text").alias("text"))
        .join(read_cache(spark, cache_path, version), "digest", "left_anti")
    )
    encoded = misses.select("digest", _count(F.col("text"), path).alias("n_tokens"), F.lit(version).alias("version"))
    encoded.write.mode("append").partitionBy("version").parquet(cache_path)
    # A left join: an inner one would infer a filter on the digest, which computes it twice.  Every digest is stored now.
    counted = keyed.drop("text").join(read_cache(spark, cache_path, version), "digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
