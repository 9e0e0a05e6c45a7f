"""Date bounds relative to one explicit ``as_of`` date per run.

The bounds are inclusive lower bounds with no upper bound: rows dated after
``as_of`` stay in.  A literal ``as_of`` constant-folds, so the bound reaches
the Parquet scan as a pushed filter.  ``add_months`` clamps to the month end
(2024-08-31 minus 6 months is 2024-02-29).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(as_of=None) -> Column:
    """``None`` means today (``current_date()``, fixed once per query)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_before(as_of, n: int) -> Column:
    return F.date_sub(as_of_column(as_of), n)


def months_before(as_of, n: int) -> Column:
    return F.add_months(as_of_column(as_of), -n)


def years_before(as_of, n: int) -> Column:
    return months_before(as_of, 12 * n)


def since(transactions: DataFrame, bound: Column) -> Column:
    """Transactions dated on or after ``bound``.

    A store that is partitioned by ``month`` (yyyymm) is also bounded on that column, so
    older months' folders are neither listed nor opened.  A NULL date is not after any bound.
    """
    dated = F.col("transaction_date") >= bound
    if "month" not in transactions.columns:
        return dated
    return dated & (F.col("month") >= F.year(bound) * 100 + F.month(bound))
