"""The three input relations every banking query reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class BankTables:
    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame

    def map(self, fn) -> "BankTables":
        """Apply ``fn(name, df)`` to each table (e.g. a cast or a persist)."""
        return BankTables(
            customers=fn("customers", self.customers),
            accounts=fn("accounts", self.accounts),
            transactions=fn("transactions", self.transactions),
        )

    def items(self):
        return (
            ("customers", self.customers),
            ("accounts", self.accounts),
            ("transactions", self.transactions),
        )
