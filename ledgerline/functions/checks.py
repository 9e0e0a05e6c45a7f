"""Null / blank predicates and the missing-field list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c) -> Column:
    """NULL, empty, or spaces only (trim removes spaces, like SQL BTRIM)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == F.lit(""))


def missing_list(checks) -> Column:
    """Comma list of the names whose predicate holds, in the given order.

    ``checks`` is a sequence of ``(name, predicate)``.  ``concat_ws`` skips
    NULLs, so a row with nothing missing gets the empty string.
    """
    return F.concat_ws(",", *[F.when(pred, F.lit(name)) for name, pred in checks])
