"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when these end, not when the driver happens to collect its garbage.

    For rows that are read from their written copy afterwards: nothing reads those files again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    with _shuffles_let_go(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame has the settings of when it was made


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a fresh Parquet table in the shared folder, read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_let_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    return base if base.lower() not in taken else f"{base}_{uuid.uuid4().hex}"


def fold(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def sha256_of_joined(strings: Column) -> Column:
    """Lowercase hex SHA-256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(strings, ",").cast("binary"), 256)
