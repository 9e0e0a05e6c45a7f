"""Declared layouts of the banking tables and of the result envelope.

Ids are 64-bit.  The source declares INTEGER keys, but at the target scale
(and already in the derived test data, where transaction ids reach 6e13)
keys exceed 2^31, so every id column is widened to ``LongType``.  Money
stays ``DoubleType`` on storage; sums are taken exactly in decimal
(see ``ledgerline.functions.money``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CUSTOMERS = StructType(
    [
        StructField("customer_id", LongType(), False),
        StructField("first_name", StringType(), True),
        StructField("last_name", StringType(), True),
        StructField("date_of_birth", DateType(), True),
        StructField("address", StringType(), True),
        StructField("city", StringType(), True),
        StructField("state", StringType(), True),
        StructField("zip", StringType(), True),
    ]
)

ACCOUNTS = StructType(
    [
        StructField("account_id", LongType(), False),
        StructField("customer_id", LongType(), False),
        StructField("account_type", StringType(), True),
        StructField("opening_date", DateType(), True),
        StructField("balance", DoubleType(), True),
    ]
)

TRANSACTIONS = StructType(
    [
        StructField("transaction_id", LongType(), False),
        StructField("account_id", LongType(), False),
        StructField("transaction_date", DateType(), True),
        StructField("transaction_type", StringType(), True),
        StructField("amount", DoubleType(), True),
        StructField("description", StringType(), True),
    ]
)

# One row per result row of any query: (query_id, run_ts, row_json).
ENVELOPE = StructType(
    [
        StructField("query_id", StringType(), False),
        StructField("run_ts", TimestampType(), False),
        StructField("row_json", StringType(), False),
    ]
)

TABLE_SCHEMAS = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
}

# Primary keys and foreign keys (child column -> parent table, parent column).
PRIMARY_KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
}
NOT_NULL = {
    "accounts": ("customer_id",),
    "transactions": ("account_id",),
}
FOREIGN_KEYS = {
    "accounts": ("customer_id", "customers", "customer_id"),
    "transactions": ("account_id", "accounts", "account_id"),
}

# Parents before children: the order in which tables are loaded and appended.
LOAD_ORDER = ("customers", "accounts", "transactions")

# Write order of each stored table (none: as it comes).
CLUSTER_KEYS = {"transactions": ("transaction_date", "transaction_id")}
