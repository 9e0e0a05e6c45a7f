"""Declared constraints, checked instead of enforced.

Parquet and Spark do not enforce primary keys, NOT NULL or foreign keys, so
the constraints of the table layout become a report: one row per
``(table_name, check_name, column_name)`` with the number of violating rows.

* ``primary_key_duplicate`` -- rows beyond the first per key value
* ``primary_key_null``      -- rows with a NULL key
* ``not_null``              -- NULLs in a NOT NULL column
* ``foreign_key_orphan``    -- non-NULL references to a missing parent row
* ``cast_loss``             -- non-NULL raw values that became NULL in the cast
                               (only when the raw tables, or counted losses, are given)

The daily job adds what its load counted: ``malformed_record`` (records that do not fit
their header) and ``row_new``, ``row_changed``, ``row_equal`` and ``row_without_key``
against the stored rows.

Every check pre-aggregates before it shuffles: one ``groupBy`` on the key per
table (partial aggregation folds a repeated key, however hot, map-side) and,
for foreign keys, a count per referenced value that is anti-joined with the
parent keys -- the join sees one row per distinct reference, never the
child rows themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casting import cast_losses
from ledgerline.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, TABLE_SCHEMAS
from ledgerline.tables import BankTables

REPORT_COLUMNS = ("table_name", "check_name", "column_name", "violations")


def _rows(df_one_row: DataFrame, table: str, checks) -> list[DataFrame]:
    """Unpivot a one-row aggregate into report rows; ``checks`` maps
    (check_name, column_name) -> aggregate column name."""
    stack = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(check).alias("check_name"),
                    F.lit(column).alias("column_name"),
                    F.coalesce(F.col(agg_col), F.lit(0)).cast("long").alias("violations"),
                )
                for (check, column), agg_col in checks
            ]
        )
    )
    return [df_one_row.select(stack)]


def _key_checks(table: str, df: DataFrame) -> list[DataFrame]:
    pk = PRIMARY_KEYS[table]
    not_null = NOT_NULL.get(table, ())
    per_key = df.groupBy(pk).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"null_{c}") for c in not_null],
    )
    summary = per_key.agg(
        F.sum(F.when(F.col(pk).isNotNull() & (F.col("n") > 1), F.col("n") - 1)).alias("dup"),
        F.sum(F.when(F.col(pk).isNull(), F.col("n"))).alias("pk_null"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in not_null],
    )
    checks = [(("primary_key_duplicate", pk), "dup"), (("primary_key_null", pk), "pk_null")]
    checks += [(("not_null", c), f"null_{c}") for c in not_null]
    return _rows(summary, table, checks)


def _orphan_check(table: str, tables: dict) -> list[DataFrame]:
    if table not in FOREIGN_KEYS:
        return []
    column, parent, parent_key = FOREIGN_KEYS[table]
    refs = (
        tables[table]
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = tables[parent].select(F.col(parent_key).alias(column)).where(F.col(column).isNotNull())
    orphans = refs.join(parents, column, "left_anti").agg(F.sum("n").alias("orphans"))
    return _rows(orphans, table, [(("foreign_key_orphan", column), "orphans")])


def _cast_checks(table: str, raw: DataFrame) -> list[DataFrame]:
    schema = TABLE_SCHEMAS[table]
    losses = cast_losses(raw, schema)
    return _rows(losses, table, [(("cast_loss", f.name), f.name) for f in schema.fields])


def counted_rows(spark: SparkSession, counts: list[tuple[str, str, str | None, int]]) -> DataFrame:
    """Report rows from numbers that are known already."""
    return spark.createDataFrame(
        counts, "table_name string, check_name string, column_name string, violations bigint"
    )


def check_constraints(
    t: BankTables, raw: BankTables | None = None, losses: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """The constraint report for the typed tables (and their raw inputs).

    ``losses`` are cast losses that were counted while the rows landed, by table and
    column; they take the place of a pass over ``raw``.
    """
    tables = dict(t.items())
    parts: list[DataFrame] = []
    for name in ("customers", "accounts", "transactions"):
        parts += _key_checks(name, tables[name])
        parts += _orphan_check(name, tables)
        if losses is not None:
            spark = tables[name].sparkSession
            parts.append(counted_rows(spark, [(name, "cast_loss", c, n) for c, n in losses[name].items()]))
        elif raw is not None:
            parts += _cast_checks(name, dict(raw.items())[name])
    report = reduce(DataFrame.unionByName, parts)
    return report.select(*REPORT_COLUMNS)
