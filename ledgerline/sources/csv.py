"""Headed CSV files -> typed tables.

Columns are bound by their names in the header, in any order; a missing
column fails, and so does a file whose header differs from the first one's.
Quoted text follows the usual form: a quote inside is doubled, a backslash is
an ordinary character.  Every field is read as text and then cast with ``try_cast`` (``ledgerline.functions.casting``).  So a zip such as
``01234`` stays text, an empty field is NULL, and a malformed date becomes
NULL and is counted by the ``cast_loss`` check instead of failing the job.
Only empty fields are NULL: tokens like ``NA`` or ``N/A`` are kept as text.

A record with more or fewer fields than its header, or one that cannot be parsed, is malformed.
It is not cut or padded into the table: ``read_csv_raw`` and ``read_csv_table`` leave it out, and
``read_csv_rejects`` returns it with its file, the reason and its text.  ``read_csv_with_rejects`` gives
both from one frame, which the daily job and the stream land, load and count.

Files are read line by line (``multiLine`` off), so large uncompressed or
splittable-compressed files are split across tasks.  Files with line breaks
inside quotes need ``multiLine=True``, at the price of one task for each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions.casting import cast_to_schema
from ledgerline.schemas import LOAD_ORDER, TABLE_SCHEMAS
from ledgerline.tables import BankTables

# A quoted empty field ("") is read as this marker and turned back into the
# empty string, so that it is not confused with an unquoted empty field (NULL).
_EMPTY_MARKER = "\u0000empty\u0000"

# Text of a record that does not fit its header; NULL for the others.
MALFORMED = "_malformed_record"
REJECTED = "rejected"
REJECT_COLUMNS = ("file", "reason", "n_fields", "record")

CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "false",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",
    "nullValue": "",
    "emptyValue": _EMPTY_MARKER,
    # Every field is parsed even where few are asked for: else a record's field count goes unnoticed.
    "columnPruning": "false",
    "columnNameOfCorruptRecord": MALFORMED,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def text_schema(schema: StructType, malformed: bool = False) -> StructType:
    """The declared column names, every column as nullable text (and one for malformed records)."""
    names = [f.name for f in schema.fields] + ([MALFORMED] if malformed else [])
    return StructType([StructField(name, StringType(), True) for name in names])


def restore_empty_strings(raw: DataFrame, schema: StructType, *others: str) -> DataFrame:
    """Turn the quoted-empty marker back into ``""`` (NULL stays NULL)."""
    return raw.select(
        *[
            F.when(F.col(f.name) == F.lit(_EMPTY_MARKER), F.lit("")).otherwise(F.col(f.name)).alias(f.name)
            for f in schema.fields
        ],
        *others,
    )


def reject_struct(header: list[str]) -> Column:
    """``file, reason, n_fields, record`` of a malformed record, NULL for a sound one.

    Fields are counted as commas outside quotes; a record with the right number is
    malformed in another way (such as a quote that is never closed).
    """
    record, expected = F.col(MALFORMED), len(header)
    # Spark refuses a scan of the malformed text alone: a field is always read, too (no length is negative).
    malformed = record.isNotNull() | (F.length(F.concat_ws("", F.col(f"`{header[0]}`"))) < 0)
    n_fields = F.length(F.regexp_replace(F.regexp_replace(record, '"([^"]|"")*"', ""), "[^,]", "")) + 1
    reason = (
        F.when(n_fields < expected, "too_few_fields").when(n_fields > expected, "too_many_fields").otherwise("unreadable")
    )
    return F.when(
        malformed,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            reason.alias("reason"),
            n_fields.cast("long").alias("n_fields"),
            record.alias("record"),
        ),
    )


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Every record: the declared columns as text, by their names in the header, and ``rejected``
    (``file, reason, n_fields, record``; NULL for a sound record)."""
    opts = dict(CSV_READ_OPTIONS)
    opts.update({k: str(v) for k, v in options.items()})
    header = spark.read.options(**(opts | {"inferSchema": "false"})).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    as_text = StructType([StructField(name, StringType(), True) for name in [*header, MALFORMED]])
    read = spark.read.schema(as_text).options(**opts).csv(path)
    return restore_empty_strings(read.withColumn(REJECTED, reject_struct(header)), schema, REJECTED)


def sound(records: DataFrame) -> DataFrame:
    """The sound records of ``read_csv_with_rejects``, without its last column."""
    return records.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejects(records: DataFrame) -> DataFrame:
    """The malformed records of ``read_csv_with_rejects``: ``file, reason, n_fields, record``."""
    return records.where(F.col(REJECTED).isNotNull()).select(*[F.col(f"{REJECTED}.{c}") for c in REJECT_COLUMNS])


def read_csv_raw(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The sound records with every declared column as text, taken by its name in the header."""
    return sound(read_csv_with_rejects(spark, path, schema, **options))


def read_csv_rejects(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The malformed records: ``file, reason, n_fields, record``."""
    return rejects(read_csv_with_rejects(spark, path, schema, **options))


def read_csv_table(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    return cast_to_schema(read_csv_raw(spark, path, schema, **options), schema)


def csv_paths(base: str) -> dict[str, str]:
    base = base.rstrip("/")
    return {name: f"{base}/{name}.csv" for name in LOAD_ORDER}


def read_csv_tables(
    spark: SparkSession, base: str, raw: bool = False, with_rejects: bool = False, **options
) -> BankTables:
    """``{base}/customers.csv``, ``accounts.csv``, ``transactions.csv`` (each a
    file or a folder of part files), parents first; ``with_rejects`` keeps malformed records (``rejected``)."""
    reader = read_csv_with_rejects if with_rejects else read_csv_raw if raw else read_csv_table
    paths = csv_paths(base)
    frames = {name: reader(spark, paths[name], TABLE_SCHEMAS[name], **options) for name in LOAD_ORDER}
    return BankTables(**frames)
