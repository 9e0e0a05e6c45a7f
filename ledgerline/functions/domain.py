"""Domain values the queries match on.  Matching is exact and case-sensitive."""

# --- fixed values (must equal the source job's literals) -------------------
DEPOSIT = "Deposit"
OUTFLOW_TYPES = ("Withdrawal", "Payment", "Transfer")
VALID_TRANSACTION_TYPES = ("Deposit", "Withdrawal", "Payment", "Transfer")
WITHDRAWAL = "Withdrawal"
CREDIT = "Credit"
LARGE_WITHDRAWAL = 500
# ---------------------------------------------------------------------------
