"""Reading the generic result envelope ``(query_id, run_ts, row_json)`` back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

READ_BACK_DECIMAL = DecimalType(38, 10)


def latest_rows(envelope: DataFrame, query_id: str, n: int = 50) -> DataFrame:
    """The newest ``n`` rows stored for ``query_id`` (JSON text only).

    The limit is the feature here (a "last page" view).  A ``query_id``
    filter prunes partitions when the envelope is stored partitioned by it.
    Rows of one run share ``run_ts``; their JSON text decides which come first.
    """
    return (
        envelope.where(F.col("query_id") == F.lit(query_id))
        .orderBy(F.desc("run_ts"), "row_json")
        .limit(n)
        .select("row_json")
    )


def unpack_rows(envelope: DataFrame, query_id: str, fields) -> DataFrame:
    """Typed columns from the JSON rows of one query.

    ``fields`` is a sequence of ``(name, type or None)``; every value is first
    taken as JSON text (an absent key -- a NULL at write time -- reads as
    NULL) and then cast, so numbers keep the exact text that was written.
    """
    schema = ", ".join(f"`{name}` STRING" for name, _ in fields)
    parsed = envelope.where(F.col("query_id") == F.lit(query_id)).select(
        F.from_json("row_json", schema).alias("r")
    )
    cols = []
    for name, dtype in fields:
        c = F.col(f"r.`{name}`")
        cols.append((c.cast(dtype) if dtype is not None else c).alias(name))
    return parsed.select(*cols)


def unpack_q1a(envelope: DataFrame) -> DataFrame:
    """q1a rows back as (customer_id text, account_type, total_balance decimal),
    largest total first (NULL totals last), ties by customer and type."""
    return unpack_rows(
        envelope,
        "q1a",
        [("customer_id", None), ("account_type", None), ("total_balance", READ_BACK_DECIMAL)],
    ).orderBy(F.desc_nulls_last("total_balance"), "customer_id", "account_type")
