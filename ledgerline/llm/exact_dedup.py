"""Exact duplicates: equal texts found by a 128-bit content hash, then byte by byte.

Two texts are equal when they are identical after every run of white space
(``[\\x20\\x09-\\x0D]+``) has become one space.  The method:

1. rows are grouped by (content hash, normalised text).  The hash leads, so a group
   is found by 16 bytes; the text makes Spark compare the bytes inside a hash group,
   and texts that merely collide end in groups of their own.  Each task first folds
   its own copies into one row (smallest id and count), so a text that a third of all
   rows share costs one row for each task, and no list of ids is ever built;
2. a hash with several texts is a collision.  These are counted, not guessed;
3. each row (id and hash only, no text) joins its group by the hash.  Rows whose hash
   collides join by hash and text instead; where there is no collision, no text moves.

So every distinct text is shuffled once, whatever the number of its copies, and the
joins carry 16-byte keys; Spark splits a hot one (skew join).

Defined results: a NULL text counts as empty; the empty text is a text like any other.
The smallest id of a group stays, NULL only if the group has no other id.  Of rows that
repeat that id (with an equal text) one stays, the others are copies of it; NULL ids are
compared in the same way.  Texts have no maximum length here beyond that of a
Spark string.  Other columns, whatever their names, are ignored by
``exact_duplicates`` and kept by ``without_exact_copies``.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with each run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return docs.select(F.col("doc_id"), normalised(F.col("text")).alias("body")).select(
        "doc_id", "body", digest(F.col("body")).alias("hash")
    )


def exact_duplicates(docs: DataFrame, *, digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``digest`` gives the content hash of a normalised text; a weaker one makes more
    collisions, never another result.
    """
    rows = _keyed(docs, digest)
    # Compared with their texts, kept without them.
    groups = written(_groups(rows).drop("body"), "text-groups")
    # What rows need of their text is taken once; `row` tells repeated rows apart.
    slim = written(
        rows.select(
            "doc_id",
            "hash",
            F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "text-keys",
    )
    collided = groups.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hash")
    sizes = groups.where("group_size > 1")
    if collided.isEmpty():
        found = slim.join(sizes, "hash", "left").withColumn("body", F.lit(""))
    else:
        found = _with_collisions(rows, slim, sizes, collided)
    alone = F.col("group_size").isNull()
    found = found.withColumns(
        {
            "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")),
            "group_size": F.coalesce("group_size", F.lit(1)),
        }
    )
    # Of rows with the group's smallest id, the first one stays.
    first = (
        found.where((F.col("group_size") > 1) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("hash", "body")
        .agg(F.min("row").alias("first_row"))
        .select("first_row")
    )
    return found.join(first, F.col("row") == F.col("first_row"), "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("group_size") == 1) | F.col("first_row").isNotNull()).alias("kept"),
        "text_sha256",
    )


def _groups(rows: DataFrame) -> DataFrame:
    """Equal texts, folded in each task before they travel."""
    return rows.groupBy("hash", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _with_collisions(rows, slim, sizes, collided) -> DataFrame:
    """Rows with their group where some hashes belong to several texts."""
    found = (
        slim.join(collided, "hash", "left_anti").join(sizes, "hash", "left").withColumn("body", F.lit(""))
    )
    # Colliding rows are read again with their texts, and grouped rows told apart by a fresh number.
    colliding = written(
        rows.join(collided, "hash", "left_semi").select(
            "doc_id",
            "hash",
            F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
            (-1 - F.monotonically_increasing_id()).alias("row"),
            "body",
        ),
        "colliding-texts",
    )
    return found.unionByName(colliding.join(_groups(colliding).where("group_size > 1"), ["hash", "body"], "left"))


def without_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns."""
    key, kept_id = free_name(docs, "content_sha256"), free_name(docs, "kept_id")
    marks = exact_duplicates(docs.select("doc_id", "text"))
    kept = marks.where("kept").select(F.col("text_sha256").alias(key), F.col("doc_id").alias(kept_id))
    found = docs.withColumn(key, F.sha2(normalised(F.col("text")).cast("binary"), 256))
    stays = found.join(kept, [key]).where(F.col("doc_id").eqNullSafe(F.col(kept_id)))
    return stays.dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])
