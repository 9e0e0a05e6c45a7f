"""The table store as published batches: versions of rows, replay-safe, pruned by month.

    {store}/{table}/batch=<id>/...                 rows of one batch
    {store}/transactions/batch=<id>/month=YYYYMM/  transactions also by month of their date
    {store}/_replaced/{table}/batch=<id>/          (key, batch) of the versions that <id> replaces
    {store}/_rejected/{table}/batch=<id>/          malformed records, with file and reason
    {store}/_daily/batch=<id>/month=YYYYMM/        what the batch adds to the daily sums of transactions
    {store}/_batches/<number>                      one small JSON marker for each published batch

**Publishing.**  A batch writes the folders named after its id, overwriting what an
ended run left there, and then one marker.  Readers open the folders that a marker names
and no others, so a batch of several tables becomes visible as a whole or not at all.  A batch
whose id has a marker is done: publishing it again changes nothing and
returns the counts that the marker holds.  The marker's number is taken with a rename that
fails if another batch took it meanwhile.

**Versions.**  The delivered rows of a table are compared with its current rows by all
columns.  A key of which some delivered row is not among them is new or changed: all the delivered
rows of the key are written, and its current ones are listed as replaced.  Keys that bring
nothing else than what is stored write nothing.  A row without a key cannot be
compared, it is written.  So a key's current rows are those of the last batch that
changed it; rows that repeat a key inside one batch stay together, and the key check reports them.

**Reading.**  A table is the union of its published batches, less the replaced
(key, batch) pairs.  Only keys that ever changed are in that list, so the anti join is
by a small side, and a table without a changed key is read with no join at all.
Transactions carry ``month`` (yyyymm of their date, NULL without one), a partition column: a
filter on it never lists or opens the other months' folders (``ledgerline.functions.dates.since``).

Only stored rows in the range of the delivered keys are compared (pushed to the scan; ids
grow with time).  Nothing is broadcast by hint, and no row passes through the driver:
it sees the markers, one for each batch.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ledgerline.files import file_system, path_exists, remove_path
from ledgerline.operators.rollup import KEYS, MEASURES, daily_rollup, merged
from ledgerline.schemas import CLUSTER_KEYS, LOAD_ORDER, PRIMARY_KEYS, TABLE_SCHEMAS
from ledgerline.session import scratch_path
from ledgerline.tables import BankTables

MARKERS = "_batches"
REPLACED = "_replaced"
QUARANTINE = "_rejected"
DAILY = "_daily"
# Rows whose daily sums go to one file of a month at most.
DAILY_ROWS = 20_000_000
# Partition columns below batch=<id>, and how they follow from a row.
MONTH = {"transactions": ("month", "transaction_date")}
COUNTS = ("delivered", "new", "changed", "equal", "no_key", "replaced", "malformed")
# The write order of each table: files and row groups of a batch cover narrow ranges.
_ORDER = {"transactions": ("month", *CLUSTER_KEYS["transactions"])}


def month_of(date: Column) -> Column:
    """yyyymm of a date; NULL without one."""
    return F.year(date) * 100 + F.month(date)


def is_batch_store(spark: SparkSession, store: str) -> bool:
    return path_exists(spark, f"{store.rstrip('/')}/{MARKERS}")


def published(spark: SparkSession, store: str) -> list[dict]:
    """The markers in order: ``{"number", "batch", "tables": {table: {count: n}}}``."""
    folder = f"{store.rstrip('/')}/{MARKERS}"
    if not path_exists(spark, folder):
        return []
    lines = spark.read.text(folder).collect()
    return sorted((json.loads(r.value) for r in lines), key=lambda m: m["number"])


def _publish_marker(spark: SparkSession, store: str, marker: dict) -> None:
    folder = f"{store.rstrip('/')}/{MARKERS}"
    fs, target = file_system(spark, f"{folder}/{marker['number']:010d}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    pending = path(f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(pending, True)
    out.write(bytearray(json.dumps(marker).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(pending, target):
        fs.delete(pending, False)
        raise RuntimeError(f"another batch was published as number {marker['number']}; run {marker['batch']} again")


def _stored_schema(table: str) -> StructType:
    fields = [*TABLE_SCHEMAS[table].fields, StructField("batch", StringType())]
    if table in MONTH:
        fields.append(StructField(MONTH[table][0], IntegerType()))
    return StructType(fields)


def _written_in(table: str, markers: list[dict]) -> list[dict]:
    """The batches whose folders hold the rows of ``table`` after ``markers``."""
    since = max((i for i, m in enumerate(markers) if m.get("compacts")), default=0)
    return [m for m in markers[since:] if m["tables"].get(table, {}).get("written")]


def _rows_of(spark: SparkSession, store: str, table: str, markers: list[dict]) -> DataFrame:
    """The current rows of ``table`` after ``markers``, with ``batch`` (and ``month``)."""
    base = f"{store.rstrip('/')}/{table}"
    own = _written_in(table, markers)
    schema = _stored_schema(table)
    if not own:
        return spark.createDataFrame([], schema)

    def stored(some: list[dict]) -> DataFrame:
        return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/batch={m['batch']}" for m in some])

    replacing = [m for m in own if m["tables"][table]["replaced"]]
    if not replacing:
        return stored(own)
    gone_base = f"{store.rstrip('/')}/{REPLACED}/{table}"
    gone = (
        spark.read.schema("gone_key bigint, gone_batch string, batch string")
        .option("basePath", gone_base)
        .parquet(*[f"{gone_base}/batch={m['batch']}" for m in replacing])
        .select("gone_key", "gone_batch")
    )
    # A batch replaces rows of earlier ones, so those from the last such batch on meet no join.
    last, pk = own.index(replacing[-1]), PRIMARY_KEYS[table]
    rows = stored(own[:last])
    kept = rows.join(gone, (rows[pk] == gone["gone_key"]) & (rows["batch"] == gone["gone_batch"]), "left_anti")
    return kept.unionByName(stored(own[last:]))


def read_store(spark: SparkSession, store: str, upto: str | None = None) -> BankTables:
    """The current tables (or as they were after the batch ``upto``); transactions with ``month``."""
    markers = published(spark, store)
    if upto is not None:
        at = [i for i, m in enumerate(markers) if m["batch"] == upto]
        if not at:
            raise ValueError(f"batch {upto} is not published in {store}")
        markers = markers[: at[0] + 1]
    return BankTables(**{name: _rows_of(spark, store, name, markers).drop("batch") for name in LOAD_ORDER})


def _write_table(spark: SparkSession, delivered: DataFrame, store: str, table: str, batch: str, markers: list[dict]) -> dict:
    """Writes one table's part of a batch; returns its counts."""
    columns, pk = [f.name for f in TABLE_SCHEMAS[table].fields], PRIMARY_KEYS[table]
    delivered = delivered.select(*columns)
    path = f"{store.rstrip('/')}/{table}/batch={batch}"
    gone_path = f"{store.rstrip('/')}/{REPLACED}/{table}/batch={batch}"
    if not _written_in(table, markers):
        return _write_first(spark, delivered, store, table, batch)
    read = delivered.agg(F.min(pk).alias("low"), F.max(pk).alias("high"), F.count(F.lit(1)).alias("n")).first()
    current = _rows_of(spark, store, table, markers)
    met = current.where(F.col(pk).between(read.low, read.high)) if read.low is not None else current.limit(0)

    # What the batch writes and what it replaces, from one exchange of both sides by key.
    decided_path = scratch_path(spark, "decided-rows")
    _decided(delivered, met.select(*columns, "batch"), columns, pk).write.parquet(decided_path)
    schema = StructType([*TABLE_SCHEMAS[table].fields, StructField("old_batch", StringType()), StructField("known", BooleanType())])
    decided = spark.read.schema(schema).parquet(decided_path)
    own, old = F.col("old_batch").isNull(), F.col("old_batch").isNotNull()
    decided.where(old).select(F.col(pk).alias("gone_key"), F.col("old_batch").alias("gone_batch")).distinct().write.mode(
        "overwrite"
    ).parquet(gone_path)
    replaced = spark.read.schema("gone_key bigint, gone_batch string").parquet(gone_path).count()
    _write_rows(decided.where(own).select(*columns), path, table)
    n = decided.agg(
        F.count_if(own).alias("written"),
        F.count_if(own & F.col(pk).isNotNull()).alias("keyed"),
        F.count_if(own & F.col("known")).alias("changed"),
        F.count(F.lit(1)).alias("all"),
    ).first()
    if table == "transactions":
        _write_daily(decided.withColumn("sign", F.when(own, 1).otherwise(-1)), n["all"], store, batch)
    remove_path(spark, decided_path)
    return {
        "delivered": read.n,
        "new": n.keyed - n.changed,
        "changed": n.changed,
        "equal": read.n - n.written,
        "no_key": n.written - n.keyed,
        "replaced": replaced,
        "written": n.written,
    }


def _write_first(spark: SparkSession, delivered: DataFrame, store: str, table: str, batch: str) -> dict:
    """A table's part of a batch that meets no stored row: all of its rows are new."""
    path = f"{store.rstrip('/')}/{table}/batch={batch}"
    remove_path(spark, f"{store.rstrip('/')}/{REPLACED}/{table}/batch={batch}")  # of a run that ended before its marker
    _write_rows(delivered, path, table)
    made = spark.read.schema(TABLE_SCHEMAS[table]).parquet(path)
    n = made.agg(F.count(F.lit(1)).alias("written"), F.count(PRIMARY_KEYS[table]).alias("keyed")).first()
    if table == "transactions":
        _write_daily(made.withColumn("sign", F.lit(1)), n.written, store, batch)
    return dict.fromkeys(COUNTS[:-1], 0) | {
        "delivered": n.written, "new": n.keyed, "no_key": n.written - n.keyed, "written": n.written,
    }


def _decided(delivered: DataFrame, current: DataFrame, columns: list[str], pk: str) -> DataFrame:
    """The delivered rows to write (``old_batch`` NULL) and the current rows that they replace, with
    ``known``: whether the row's key has a current row.

    A key is written if some delivered row of it is not among its current ones.  Both windows take the
    order by key and values that one exchange by key leaves; rows of one key are never compared in pairs.
    """
    both = (
        delivered.where(F.col(pk).isNotNull()).withColumn("old_batch", F.lit(None).cast("string"))
        .unionByName(current.withColumnRenamed("batch", "old_batch"))
        .repartition(pk)
    )
    old = F.col("old_batch").isNotNull()
    among = both.withColumn("among", F.max(old).over(Window.partitionBy(pk, *[c for c in columns if c != pk])))
    of_key = Window.partitionBy(pk)
    keys = among.withColumns({"touched": F.max(~old & ~F.col("among")).over(of_key), "known": F.max(old).over(of_key)})
    keyless = delivered.where(F.col(pk).isNull()).withColumns({"old_batch": F.lit(None).cast("string"), "known": F.lit(False)})
    return keys.where("touched").select(*columns, "old_batch", "known").unionByName(keyless)


def _write_daily(rows: DataFrame, n_rows: int, store: str, batch: str) -> None:
    """The daily sums of ``rows``, whose ``sign`` is -1 where they are taken off."""
    # A month's sums of a batch go to few files, and its largest months to several: one exchange by
    # month and a part of the accounts serves the sums and the files.
    spread = F.pmod(F.xxhash64("account_id"), F.lit(1 + n_rows // DAILY_ROWS))
    dealt = rows.select(*KEYS, "amount", "sign", month_of(F.col("transaction_date")).alias("month"), spread.alias("spread"))
    sums = daily_rollup(dealt.repartition("month", "spread"), F.col("sign"), "month", "spread").drop("spread")
    sums.write.mode("overwrite").partitionBy("month").parquet(f"{store.rstrip('/')}/{DAILY}/batch={batch}")


def read_daily(spark: SparkSession, store: str) -> DataFrame:
    """The daily sums of the current transactions (``ledgerline.operators.rollup``), with ``month``."""
    base = f"{store.rstrip('/')}/{DAILY}"
    markers = published(spark, store)
    since = max((i for i, m in enumerate(markers) if m.get("compacts")), default=0)
    paths = [f"{base}/batch={m['batch']}" for m in markers[since:] if m["tables"].get("transactions", {}).get("written")]
    schema = (
        "account_id bigint, transaction_date date, transaction_type string, n_rows bigint, n_amounts bigint, "
        "amount_sum decimal(38,6), month int"
    )
    if not paths:
        return spark.createDataFrame([], schema)
    parts = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*KEYS, *MEASURES, "month")
    return merged(parts) if len(paths) > 1 else parts


def _write_rows(rows: DataFrame, path: str, table: str) -> None:
    if table in MONTH:
        name, date = MONTH[table]
        rows = rows.withColumn(name, month_of(F.col(date)))
    if table in _ORDER:
        order = [F.asc_nulls_first(k) for k in _ORDER[table]]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out = rows.write.mode("overwrite")
    (out.partitionBy(MONTH[table][0]) if table in MONTH else out).parquet(path)


def publish_batch(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    store: str,
    batch: str,
    rejected: dict[str, DataFrame] | None = None,
) -> dict[str, dict]:
    """Publishes typed rows of some or all tables as one batch, parents first.

    Returns for each table the numbers of delivered, new, changed, equal and key-less
    rows, of replaced versions and of malformed records (``rejected``, which go to the
    quarantine).  ``batch`` names the batch and is a folder name.
    """
    if not batch or any(c in batch for c in "/=%\\:*?\"<>|{}[]") or batch != batch.strip():
        raise ValueError(f"not a folder name: {batch!r}")
    markers = published(spark, store)
    for marker in markers:
        if marker["batch"] == batch:
            return marker["tables"]
    counts = {
        name: _write_table(spark, tables[name], store, name, batch, markers)
        | {"malformed": _write_rejected(spark, (rejected or {}).get(name), store, name, batch)}
        for name in LOAD_ORDER
        if name in tables
    }
    number = markers[-1]["number"] + 1 if markers else 1
    _publish_marker(spark, store, {"number": number, "batch": batch, "tables": counts})
    return counts


def _write_rejected(spark: SparkSession, rejected: DataFrame | None, store: str, table: str, batch: str) -> int:
    path = f"{store.rstrip('/')}/{QUARANTINE}/{table}/batch={batch}"
    if rejected is None:
        remove_path(spark, path)  # of a run that ended before its marker
        return 0
    rejected.write.mode("overwrite").parquet(path)
    return spark.read.schema(rejected.schema).parquet(path).count()


def read_rejected(spark: SparkSession, store: str, table: str) -> DataFrame:
    """The malformed records of all published batches: ``batch, file, reason, n_fields, record``."""
    base = f"{store.rstrip('/')}/{QUARANTINE}/{table}"
    schema = "file string, reason string, n_fields bigint, record string, batch string"
    paths = [f"{base}/batch={m['batch']}" for m in published(spark, store) if m["tables"].get(table, {}).get("malformed")]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def row_checksum(df: DataFrame) -> list:
    """Aggregates that name a frame's rows whatever their order: count, and two exact sums of row hashes."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("first"),
        F.sum(F.xxhash64(F.lit("second"), *columns).cast("decimal(20,0)")).alias("second"),
    ]


def batch_name(day, sums: dict[str, dict]) -> str:
    """A batch id from the day and the checksums of the delivered tables: a retry gives the same."""
    text = json.dumps({name: {k: str(v) for k, v in s.items()} for name, s in sorted(sums.items())}, sort_keys=True)
    return f"{day}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def compact_store(spark: SparkSession, store: str, batch: str) -> dict[str, dict]:
    """Writes the current tables as one batch that stands for all earlier ones.

    Many small batches become few large files.  The earlier folders stay, for readers that
    have begun and for ``read_store(upto=...)``, until ``drop_compacted``.
    """
    markers = published(spark, store)
    for marker in markers:
        if marker["batch"] == batch:
            return marker["tables"]
    counts = {}
    for name in LOAD_ORDER:
        path = f"{store.rstrip('/')}/{name}/batch={batch}"
        _write_rows(_rows_of(spark, store, name, markers).select(*[f.name for f in TABLE_SCHEMAS[name].fields]), path, name)
        made = spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)
        n = made.count()
        if name == "transactions":
            _write_daily(made.withColumn("sign", F.lit(1)), n, store, batch)
        counts[name] = dict.fromkeys(COUNTS, 0) | {"delivered": n, "equal": n, "written": n}
    number = markers[-1]["number"] + 1 if markers else 1
    _publish_marker(spark, store, {"number": number, "batch": batch, "tables": counts, "compacts": True})
    return counts


def drop_compacted(spark: SparkSession, store: str) -> list[str]:
    """Deletes the folders of the batches before the last compaction; returns their ids."""
    markers = published(spark, store)
    at = max((i for i, m in enumerate(markers) if m.get("compacts")), default=0)
    for marker in markers[:at]:
        remove_path(spark, f"{store.rstrip('/')}/{DAILY}/batch={marker['batch']}")
        for name in LOAD_ORDER:
            for base in (store.rstrip("/"), f"{store.rstrip('/')}/{REPLACED}"):
                remove_path(spark, f"{base}/{name}/batch={marker['batch']}")
    return [m["batch"] for m in markers[:at]]
