"""A training corpus from raw documents, in five stages over the whole table.

Each stage is ``fn(spark, docs, sf_dir) -> DataFrame``; its rows are written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of
``docs``:

1. ``language_id``: documents without letters, or in none of the learned languages, go;
2. ``line_dedup``: lines that repeat earlier ones go, and documents made of nothing else;
3. ``near_dedup``: one document of each near-duplicate group (five words, Jaccard
   similarity of 0.8 or more) stays;
4. ``decontaminate``: documents that hold benchmark passages go;
5. ``pack``: the rest is packed into token sequences.

NULL, empty and repeated values are handled as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import fold, table, written
from ledgerline.llm.decontaminate import decontaminate
from ledgerline.llm.language_id import fit_language_model, known_language
from ledgerline.llm.line_dedup import without_repeated_lines
from ledgerline.llm.near_dedup import without_near_duplicates
from ledgerline.llm.packing import pack_documents


NEAR_PERCENT = 80
MIN_GRAMS = 100  # n-grams from which a text is judged
MIN_KNOWN = 10  # percent of them that the language model must have met


def language_id_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects.

    Those are texts without a letter, and texts of which the model knows next to nothing: of
    their n-grams (``MIN_GRAMS`` or more) fewer than ``MIN_KNOWN`` percent occur in the texts of its
    landmarks.  Shorter texts with a letter stay, for want of evidence.  Where no row has a
    usable ``lang`` there is no model to reject by, and every text with a letter stays.
    """
    model = fit_language_model(docs, fold(F.col("doc_id"), 5) != 0)
    if model is None:
        return docs.where(F.col("text").rlike("\\p{L}"))
    return docs.where(known_language(docs, model, MIN_GRAMS, MIN_KNOWN))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines."""
    return without_repeated_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates.

    Rows are told apart by id and set of shingles, so a text that shares its id with a
    duplicate is judged by itself.  Of a group the rows with its smallest id stay, of these one for each
    set; rows with NULL id, and texts without words, are in no group and stay.
    """
    return without_near_duplicates(docs, percent=NEAR_PERCENT)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pack", pack_stage),
]

# Language identification is a fitted model, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
