"""The banking queries and job-level operators.

Each query is ``fn(tables: BankTables, as_of=None) -> DataFrame`` and is lazy.
"""

from ledgerline.operators.activity import average_transaction_and_balance, most_active_customers
from ledgerline.operators.basic import recent_accounts, top_customers_by_balance, total_balance_by_type
from ledgerline.operators.checks import check_constraints
from ledgerline.operators.envelope import latest_rows, unpack_q1a, unpack_rows
from ledgerline.operators.movements import (
    deposits_per_customer,
    large_withdrawals,
    running_balances,
)
from ledgerline.operators.quality import (
    balance_mismatches,
    duplicate_account_types,
    invalid_transaction_types,
    missing_customer_fields,
    negative_non_credit_balances,
)
from ledgerline.operators.text import word_count

# The 13 result queries under their published keys.
BANKING_QUERIES = {
    "q1a": total_balance_by_type,
    "q1b": recent_accounts,
    "q1c": top_customers_by_balance,
    "q2a": large_withdrawals,
    "q2b": deposits_per_customer,
    "q2c": running_balances,
    "q3a": average_transaction_and_balance,
    "q3b": most_active_customers,
    "q4a": balance_mismatches,
    "q4b": missing_customer_fields,
    "q4c": duplicate_account_types,
    "q4d": invalid_transaction_types,
    "q4e": negative_non_credit_balances,
}

__all__ = [
    "BANKING_QUERIES",
    "average_transaction_and_balance",
    "balance_mismatches",
    "check_constraints",
    "deposits_per_customer",
    "duplicate_account_types",
    "invalid_transaction_types",
    "large_withdrawals",
    "latest_rows",
    "missing_customer_fields",
    "most_active_customers",
    "negative_non_credit_balances",
    "recent_accounts",
    "running_balances",
    "top_customers_by_balance",
    "total_balance_by_type",
    "unpack_q1a",
    "unpack_rows",
    "word_count",
]
