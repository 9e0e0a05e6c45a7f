"""Tables as headed CSV, in the layout the CSV reader ingests.

NULL is written as an empty field and an empty string as ``""``, and
whitespace is kept, so text such as ``"   "`` or ``""`` survives a round trip
through ``ledgerline.sources.csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

CSV_WRITE_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": '""',
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
}


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
    return path
