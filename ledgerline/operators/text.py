"""Word frequency over a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(df: DataFrame, column: str = "text") -> DataFrame:
    """Count of each word, splitting on single spaces.

    Case-sensitive, no normalisation; consecutive, leading or trailing spaces
    yield empty words, which are counted like any other word ("a  b" gives
    a, "", b).  NULL text contributes nothing.  Whole texts are split.

    ``split`` + ``explode`` stay inside whole-stage codegen, and the count is a
    partial (map-side) aggregate, so a very frequent word is folded before the
    shuffle instead of landing in one reducer row by row.
    """
    words = df.select(F.explode(F.split(F.col(column), " ", -1)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
