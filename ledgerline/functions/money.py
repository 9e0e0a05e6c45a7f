"""Exact money arithmetic.

Money is stored as DOUBLE, but a sum of doubles depends on the order in which
partial sums meet -- and that order changes with partitioning, AQE and task
retries.  Every sum is therefore taken in ``DECIMAL(28,6)`` (Spark widens the
aggregate to ``DECIMAL(38,6)``) and only the final value is cast back to
double.  Averages are ``double(exact sum) / double(count)`` so they round once.

Limits: amounts finer than 1e-6 are rounded to 6 places; NaN, Infinity and
amounts of more than 22 integer digits have no exact value: they count as
missing (NULL), in sums and in the counts that averages divide by; sums above
32 integer digits overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerline.functions.domain import DEPOSIT, OUTFLOW_TYPES

MONEY = DecimalType(28, 6)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    """A money column as an exact decimal; NULL where there is none."""
    return _col(c).try_cast(MONEY)


def money_sum(c) -> Column:
    """Exact SUM of a double money column; the result stays decimal."""
    return F.sum(to_money(c))


def money_count(c) -> Column:
    """How many values ``money_sum`` adds up."""
    return F.count(to_money(c))


def as_double(c) -> Column:
    return _col(c).cast("double")


def mean_of(total, count) -> Column:
    """``total / count`` rounded once; NULL when nothing was counted."""
    return F.when(_col(count) > 0, as_double(total) / _col(count).cast("double"))


def signed_amount(type_col="transaction_type", amount_col="amount") -> Column:
    """Deposits count positive, withdrawals/payments/transfers negative, all else 0."""
    t = _col(type_col)
    amount = to_money(amount_col)
    return (
        F.when(t == F.lit(DEPOSIT), amount)
        .when(t.isin(*OUTFLOW_TYPES), -amount)
        .otherwise(F.lit(0).cast(MONEY))
    )
