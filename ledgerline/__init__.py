"""ledgerline: retail-banking analytics as lazy Spark DataFrame jobs.

Layout
------
``schemas``      declared table layouts (customers, accounts, transactions, results)
``functions``    column-level building blocks: money sums, date bounds, null checks, casts
``sources``      CSV / JDBC / Parquet readers and the test-data derivation
``operators``    the 13 banking queries, constraint checks, envelope read-back, word count
``sinks``        Parquet result directories, the JSON-row envelope, idempotent appends
``plans``        query registry, the end-to-end pipeline, plan-inspection helpers
``streaming``    incremental (exactly-once) CSV ingest with Structured Streaming

Every query is a pure function ``(tables, as_of) -> DataFrame``: no action, no
session state, no collect.  Catalyst/AQE choose the physical plan.
"""

from ledgerline.tables import BankTables

__all__ = ["BankTables"]
