"""Writers: result folders (E5), the JSON-row envelope (E6), the table store (E2)."""

from ledgerline.sinks.csv import write_csv_table
from ledgerline.sinks.results import append_jdbc, to_envelope, write_result_envelope, write_result_parquet
from ledgerline.sinks.tables import append_table, append_tables

__all__ = [
    "append_jdbc",
    "append_table",
    "append_tables",
    "to_envelope",
    "write_csv_table",
    "write_result_envelope",
    "write_result_parquet",
]
