"""Column-level building blocks shared by the queries."""

from ledgerline.functions.casting import cast_losses, cast_to_schema
from ledgerline.functions.checks import is_blank, missing_list
from ledgerline.functions.dates import as_of_column, days_before, months_before, since, years_before
from ledgerline.functions.money import (
    MONEY,
    as_double,
    mean_of,
    money_count,
    money_sum,
    signed_amount,
    to_money,
)

__all__ = [
    "MONEY",
    "as_double",
    "as_of_column",
    "cast_losses",
    "cast_to_schema",
    "days_before",
    "is_blank",
    "mean_of",
    "missing_list",
    "money_count",
    "money_sum",
    "months_before",
    "signed_amount",
    "since",
    "to_money",
    "years_before",
]
