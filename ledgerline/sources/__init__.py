"""Readers: CSV (E1), JDBC (E3), staged Parquet, and the test-data derivation."""

from ledgerline.sources.csv import read_csv_raw, read_csv_table, read_csv_tables
from ledgerline.sources.jdbc import read_jdbc_table, read_jdbc_tables
from ledgerline.sources.parquet import read_envelope, read_parquet_tables
from ledgerline.sources.testdata import TESTDATA_AS_OF, bank_tables_from_testdata, documents_text

__all__ = [
    "TESTDATA_AS_OF",
    "bank_tables_from_testdata",
    "documents_text",
    "read_csv_raw",
    "read_csv_table",
    "read_csv_tables",
    "read_envelope",
    "read_jdbc_table",
    "read_jdbc_tables",
    "read_parquet_tables",
]
