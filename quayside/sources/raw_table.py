"""The raw table: append-only Parquet, all strings plus audit columns.

Partitioned by the UTC load day (``_load_date``), so a day's run reads one partition,
and below it by landing batch (``_batch``): every landing write fills its own batch
partition with a dynamic partition overwrite, so replaying a batch (a stream restart
after a crash) rewrites that batch instead of landing its rows twice."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.checks import as_date_lit
from quayside.plans.observed import observed_metrics
from quayside.schema import LOAD_DATE, RAW_SCHEMA
from quayside.session import drops_shuffles, path_exists, scratch_path, session_conf
from quayside.sources.fixture import fixture_raw_orders, with_load_date

BATCH = "_batch"
RAW_TABLE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [T.StructField(LOAD_DATE, T.DateType(), True), T.StructField(BATCH, T.StringType(), True)]
)

# Rows per output file; keeps files of a large day at a sensible size.
MAX_RECORDS_PER_FILE = 5_000_000
# Load days whose files a landing task holds open before it sorts its rows by day.
OPEN_DAYS = 3


@drops_shuffles
def append_raw(rows: DataFrame, raw_path: str, batch_id: str | None = None) -> str:
    """Land raw rows (19 columns) as one batch, in one write job; returns the batch id.

    A new batch id appends; a batch id written before is replaced (idempotent
    replay): all its partitions go, also those of load days that the batch no longer
    has. No shuffle and no sort: a batch covers one or two load days, so each task writes a
    file per day it holds, all open at once (``OPEN_DAYS``; beyond that they are sorted). An empty batch writes nothing. Last, the batch's row count, taken
    from the write, goes to the table of counts (``raw_counts``).
    """
    fs, old = None, []
    if batch_id is None:
        batch_id = uuid.uuid4().hex
    else:
        fs, old = _batch_files(rows.sparkSession, raw_path, batch_id)
    out = with_load_date(rows.select(*RAW_SCHEMA.fieldNames())).withColumn(BATCH, F.lit(batch_id))
    obs = Observation("raw-rows")
    with session_conf(rows.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_DAYS)}):
        (
            out.observe(obs, F.count(F.lit(1)).alias("n"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy(LOAD_DATE, BATCH)
            .parquet(raw_path)
        )
    for path in old:  # what the write did not replace; only now, as the rows may have been read from there
        fs.delete(path, False)
    n = int(observed_metrics(obs).get("n", 0))
    replace_batch(rows.sparkSession.createDataFrame([(n,)], "n_rows long").coalesce(1), counts_path(raw_path), batch_id)
    return batch_id


def counts_path(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_counts"


def raw_row_count(spark: SparkSession, raw_path: str) -> int:
    """Rows of the raw table by the counts of its batches: no file of raw is opened or listed."""
    counts = _read_or_empty(spark, counts_path(raw_path), T.StructType([T.StructField("n_rows", T.LongType(), True)]))
    return int(counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).head()[0])


def _batch_files(spark: SparkSession, raw_path: str, batch_id: str):
    """(file system, files) of a batch's partitions under any load day."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    table = path(raw_path)
    fs = table.getFileSystem(sc._jsc.hadoopConfiguration())
    name = sc._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)
    folders = [path(d.getPath(), f"{BATCH}={name}") for d in fs.listStatus(table)] if fs.exists(table) else []
    return fs, [f.getPath() for d in folders if fs.exists(d) for f in fs.listStatus(d)]


def batch_loaded_at(spark: SparkSession, raw_path: str, batch_id: str) -> str | None:
    """The load time of a batch that has landed before; None if it has not, or had no rows."""
    _, files = _batch_files(spark, raw_path, batch_id)
    folders = sorted({f.getParent().toString() for f in files})
    if not folders:
        return None
    landed = spark.read.schema(RAW_SCHEMA).parquet(*folders)
    return landed.agg(F.max("_loaded_at").cast("string")).first()[0]


REJECTS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("path", "reason", BATCH)]
)

#: The ledger of landed files: a row per file and batch that met it.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("n_rows", T.LongType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampType(), True),
        T.StructField(BATCH, T.StringType(), True),
    ]
)


def batch_folder(spark: SparkSession, table: str, batch_id: str) -> str:
    """A batch's partition folder of a table that is partitioned by batch alone."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)
    return f"{table.rstrip('/')}/{BATCH}={name}"


def replace_batch(rows: DataFrame, table: str, batch_id: str) -> None:
    """Write a batch's rows of a small table, in place of what an earlier run of the batch left."""
    rows.write.mode("overwrite").parquet(batch_folder(rows.sparkSession, table, batch_id))


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, _batch) of files that could not be landed (empty if there are none)."""
    return _read_or_empty(spark, path, REJECTS_SCHEMA)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of landed files (empty before the first batch)."""
    return _read_or_empty(spark, path, LEDGER_SCHEMA)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table (empty with the right schema if nothing has landed yet)."""
    return _read_or_empty(spark, raw_path, RAW_TABLE_SCHEMA)


def read_raw_day(spark: SparkSession, raw_path: str, as_of: dt.date | str) -> DataFrame:
    """The run day's raw rows, listing only that day's partition folder.

    Equivalent to ``raw_day(read_raw(...), as_of)``, but the file index never lists the
    other days (years of daily batch folders on a long-lived table).
    """
    day = as_of.isoformat() if isinstance(as_of, dt.date) else str(as_of)
    folder = f"{raw_path.rstrip('/')}/{LOAD_DATE}={day}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], RAW_TABLE_SCHEMA)
    return raw_day(spark.read.schema(RAW_TABLE_SCHEMA).option("basePath", raw_path).parquet(folder), day)


def read_raw_batches(spark: SparkSession, raw_path: str, as_of: dt.date | str, batches: list[str]) -> DataFrame:
    """The run day's raw rows of these batches; no other batch's folder is listed."""
    day = as_of.isoformat() if isinstance(as_of, dt.date) else str(as_of)
    folders = [batch_folder(spark, f"{raw_path.rstrip('/')}/{LOAD_DATE}={day}", b) for b in batches]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], RAW_TABLE_SCHEMA)
    return raw_day(spark.read.schema(RAW_TABLE_SCHEMA).option("basePath", raw_path).parquet(*folders), day)


def raw_day(raw: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Rows loaded on the run day: a filter on the partition column (partition pruning)."""
    return raw.where(F.col(LOAD_DATE) == as_date_lit(as_of))


_LANDED: dict[tuple[str, str], str] = {}


def land_fixture(spark: SparkSession, sf_dir: str) -> str:
    """Land the fixture's raw rows once per application; returns the raw table path.

    The tasks of the adapter's last join write it, as many as the rows need (and, by the
    session's default, no fewer than the cluster has cores), so rows are not shuffled again to
    land and no task's share grows with the table.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LANDED:
        path = scratch_path(spark, "fixture-raw")
        append_raw(fixture_raw_orders(spark, sf_dir), path)
        _LANDED[key] = path
    return _LANDED[key]


def fixture_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed fixture raw table (a Parquet scan, so row ids are stable)."""
    return read_raw(spark, land_fixture(spark, sf_dir))


__all__ = [
    "BATCH",
    "LEDGER_SCHEMA",
    "RAW_TABLE_SCHEMA",
    "batch_folder",
    "raw_row_count",
    "read_ledger",
    "read_rejects",
    "replace_batch",
    "append_raw",
    "read_raw",
    "raw_day",
    "read_raw_batches",
    "read_raw_day",
    "land_fixture",
    "fixture_raw_table",
]
