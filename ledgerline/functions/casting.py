"""Force a DataFrame onto a declared schema (one projection, no per-column loop
of ``withColumn``, which would grow the plan one Project per field)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast every declared column and select them in declared order.

    ``try_cast`` turns a malformed value into NULL instead of failing the job
    (Spark 4 runs with ANSI casts); ``cast_losses`` counts such values.
    """
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def lost_in_cast(name: str, schema: StructType) -> Column:
    """Whether a non-NULL raw value becomes NULL."""
    return F.col(name).isNotNull() & F.col(name).try_cast(schema[name].dataType).isNull()


def cast_losses(raw: DataFrame, schema: StructType) -> DataFrame:
    """One row: per declared column, how many non-NULL raw values became NULL."""
    return raw.agg(*[F.count(F.when(lost_in_cast(name, schema), F.lit(1))).alias(name) for name in schema.names])
