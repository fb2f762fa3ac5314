"""Writers and readers of the gold, quarantine and check-log tables (Parquet).

* gold: append-only, partitioned by order_date, rows sorted by (order_date,
  store_name, category) inside each file for min/max pruning. A REBALANCE on
  order_date puts each day in one task and lets AQE split a hot day.
* quarantine: partitioned by the run day; a run replaces only its own day.
* check log: partitioned by run_date; a run replaces only its own day.
* numbering: partitioned by load day, the first row per order id of the day's run. It lets
  a run over new rows alone extend the day (``plans.gold_increment``).

Below that, every table has a folder per run. A run's rows count once its **commit** is
there: one small record in ``run_commits`` beside the tables, written last, with the run's
counts. Readers take gold of committed runs, the check log of each day's last committed run, and its
quarantine with that of the runs it extends, so a run that breaks off anywhere is never seen, and one commit shows all
three tables at once. The commits (one row per run) are read by the driver; they become a
partition filter. Gold's total is their sum: no file of gold is opened for it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.schema import (
    CHECK_LOG_SCHEMA,
    GOLD_SCHEMA,
    QUARANTINE_COLUMNS,
    LOAD_DATE,
    QUARANTINE_DATE,
    RAW_SCHEMA,
    RUN,
)
from quayside.session import drops_shuffles, hadoop_path, path_exists, session_conf
from quayside.functions.text import PART, pack_texts, unpacked_texts
from quayside.operators.checks import DEDUPE_ORDER
from quayside.sinks.members import drop_members, folder_names, write_members, written_rows

GOLD_CLUSTER = ("order_date", "store_name", "category")

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.TimestampType() if c in ("_loaded_at", "_quarantine_at") else T.StringType(), True)
        for c in QUARANTINE_COLUMNS
    ]
    + [T.StructField(QUARANTINE_DATE, T.DateType(), True)]
)

NUMBERING_SCHEMA = T.StructType([RAW_SCHEMA[c] for c in ("order_id", *DEDUPE_ORDER)])


COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), True),
        T.StructField("as_of", T.DateType(), True),
        T.StructField("gold_appended", T.LongType(), True),
        T.StructField("quarantined", T.LongType(), True),
        T.StructField("raw_state", T.StringType(), True),
        T.StructField("replaces", T.ArrayType(T.StringType()), True),
        T.StructField("extends", T.StringType(), True),
        T.StructField(RUN, T.StringType(), True),
    ]
)


# ---- commits -----------------------------------------------------------------------------


def commits_path(table: str) -> str:
    """Where the commits of the runs of a gold, quarantine or check-log table are."""
    return f"{table.rstrip('/').rsplit('/', 1)[0]}/run_commits"


def read_commits(spark: SparkSession, table: str) -> list[Row]:
    """The committed runs in their order: a row per run, so a few thousand in ten years of days."""
    path = commits_path(table)
    if not path_exists(spark, path):
        return []
    return sorted(spark.read.schema(COMMIT_SCHEMA).parquet(path).collect(), key=lambda c: c.seq)


def new_run(day: dt.date) -> str:
    return f"{day.isoformat()}-{uuid.uuid4().hex[:12]}"


def commit_run(
    spark: SparkSession,
    table: str,
    run: str,
    day: dt.date | None,
    gold_appended: int,
    quarantined: int,
    raw_state: str = "",
    replaces: list[str] | None = None,
    extends: str | None = None,
) -> None:
    """Make a run's rows count, and gold rows of the runs it replaces no longer.

    With ``extends`` the run covers only rows that came after that run of its day. One writer at a time, as the day's schedule has.
    """
    seq = 1 + max((c.seq for c in read_commits(spark, table)), default=0)
    row = spark.createDataFrame([(seq, day, gold_appended, quarantined, raw_state, replaces or [], extends, run)], COMMIT_SCHEMA)
    row.drop(RUN).coalesce(1).write.mode("overwrite").parquet(f"{commits_path(table)}/{RUN}={run}")


def last_runs(commits: list[Row]) -> list[str]:
    """Each day's last committed run."""
    return list({c.as_of: c[RUN] for c in commits if c.as_of is not None}.values())


def day_runs(commits: list[Row], day: dt.date | None) -> list[Row]:
    """The day's last run over all its rows and the runs that extended it since, in their order."""
    runs: list[Row] = []
    for c in commits:
        if c.as_of == day:
            runs = [*runs, c] if c.extends else [c]
    return runs


def quarantine_runs(commits: list[Row]) -> list[str]:
    """The runs whose quarantine counts."""
    days = {c.as_of for c in commits if c.as_of is not None}
    return [c[RUN] for d in sorted(days) for c in day_runs(commits, d)]


def gold_runs(commits: list[Row]) -> list[str]:
    """The runs whose gold rows count: committed, and not compacted into another."""
    replaced = {r for c in commits for r in c.replaces or []}
    return [c[RUN] for c in commits if c[RUN] not in replaced]


# ---- writers -----------------------------------------------------------------------------


def pack_rows(rows: DataFrame) -> DataFrame:
    """Gold rows as a shuffle moves them in three fifths of the bytes; ``unpack_rows`` gives them back.

    The texts go as one (``pack_texts``), hex row hashes as their bytes; hashes in another form keep theirs.
    """
    texts, others = _text_columns()
    code = F.unhex("_row_hash")
    hexed = F.lower(F.hex(code)) == F.col("_row_hash")
    return rows.select(
        *others,
        *pack_texts(texts),
        F.when(hexed, code).alias("_code"),
        F.when(~F.coalesce(hexed, F.lit(False)), F.col("_row_hash")).alias("_other_hash"),
    )


def unpack_rows(packed: DataFrame) -> DataFrame:
    texts, others = _text_columns()
    parts = packed.withColumn("_parts", F.split("_texts", PART, -1))
    row_hash = F.coalesce(F.lower(F.hex("_code")), F.col("_other_hash")).alias("_row_hash")
    return parts.select(*others, *unpacked_texts(texts), row_hash).select(*GOLD_SCHEMA.fieldNames())


def _text_columns() -> tuple[list[str], list[str]]:
    """Gold's text columns but for the row hash, and its columns of other types."""
    texts = [f.name for f in GOLD_SCHEMA.fields if isinstance(f.dataType, T.StringType) and f.name != "_row_hash"]
    return texts, [c for c in GOLD_SCHEMA.fieldNames() if c not in (*texts, "_row_hash")]


@drops_shuffles
def write_gold(rows: DataFrame, path: str, run: str) -> None:
    """Append a run's gold rows, one folder per order_date, clustered by store and category.

    The rebalance hashes rows by order_date, so every date lands in one task (one
    file per date) and AQE splits only a hot date over several tasks. They are shuffled
    packed (``pack_rows``). Coalescing is
    off for this write: merging partitions never lowers the file count here (each
    date is in one partition either way), it only serialises the writing.
    """
    with session_conf(rows.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        (
            unpack_rows(pack_rows(rows).hint("rebalance", "order_date"))
            .withColumn(RUN, F.lit(run))
            .sortWithinPartitions(*GOLD_CLUSTER)
            .write.mode("append")
            .partitionBy("order_date", RUN)
            .parquet(path)
        )


def day_folder(path: str, column: str, day: dt.date) -> str:
    return f"{path}/{column}={day.isoformat()}"


@drops_shuffles
def write_quarantine(rows: DataFrame, path: str, day: dt.date, run: str) -> None:
    """Write a run's quarantine of its day; once committed it takes the place of earlier runs' (also if empty)."""
    rows.drop(QUARANTINE_DATE).write.mode("overwrite").parquet(f"{day_folder(path, QUARANTINE_DATE, day)}/{RUN}={run}")


def write_check_log(rows: DataFrame, path: str, day: dt.date, run: str) -> None:
    """Write a run's check-log rows: at most nine (eight checks + reconciliation), so one file."""
    rows.drop("run_date").coalesce(1).write.mode("overwrite").parquet(f"{day_folder(path, 'run_date', day)}/{RUN}={run}")


def write_numbering(staged: DataFrame, path: str, day: dt.date, run: str) -> None:
    """Write the first row per order id of a run's staged rows: the id and what rows are ordered by."""
    firsts = staged.where(~F.col("duplicate_order_id")).select(*NUMBERING_SCHEMA.fieldNames())
    firsts.write.mode("overwrite").parquet(f"{day_folder(path, LOAD_DATE, day)}/{RUN}={run}")


def drop_replaced(spark: SparkSession, path: str, column: str, day: dt.date, runs: Collection[str]) -> None:
    """Remove what runs other than these left in a day's folder of the quarantine, the check log or the numbering."""
    keep = {f"{RUN}={r}" for r in runs}
    fs, folder = hadoop_path(spark, day_folder(path, column, day))
    for f in fs.listStatus(folder) if fs.exists(folder) else []:
        if f.getPath().getName() not in keep:
            fs.delete(f.getPath(), True)


@drops_shuffles
def compact_gold(spark: SparkSession, path: str) -> int:
    """Rewrite the gold rows of all runs as one run; returns the number of runs that it replaces.

    A date that many runs wrote a file for ends in one sorted file (a hot date in a few). The
    new files count from the one commit that also ends the old ones, so a reader sees all old
    or all new; then the old ones go. It is run again if it breaks off.
    """
    runs = gold_runs(read_commits(spark, path))
    gold = read_gold(spark, path)
    if gold is not None and len(runs) > 1:
        run = f"compact-{uuid.uuid4().hex[:12]}"
        write_gold(gold, path, run)
        write_members(written_rows(spark, path, run), path, run)
        commit_run(spark, path, run, None, 0, 0, replaces=runs)
    drop_uncounted(spark, path)
    return len(runs) if gold is not None and len(runs) > 1 else 0


def drop_uncounted(spark: SparkSession, path: str) -> None:
    """Remove gold files and summaries of runs that do not count: broken off, or compacted into another. No run may be under way."""
    live = {f"{RUN}={r}" for r in gold_runs(read_commits(spark, path))}
    fs, folders = hadoop_path(spark, f"{path}/order_date=*/{RUN}=*")
    for f in fs.globStatus(folders) or []:
        if f.getPath().getName() not in live:
            fs.delete(f.getPath(), True)
    drop_members(spark, path, {name.removeprefix(f"{RUN}=") for name in live})


# ---- readers -----------------------------------------------------------------------------


def _read(spark: SparkSession, path: str, schema: T.StructType, runs: list[str]) -> DataFrame | None:
    """The rows of these runs; None if there are none or nothing was ever written."""
    if not runs or not path_exists(spark, path):
        return None
    stored = T.StructType([*schema.fields, T.StructField(RUN, T.StringType(), True)])
    return spark.read.schema(stored).parquet(path).where(F.col(RUN).isin(runs)).select(*schema.fieldNames())


def read_gold(spark: SparkSession, path: str) -> DataFrame | None:
    """The gold rows of committed runs, or None before the first."""
    return _read(spark, path, GOLD_SCHEMA, gold_runs(read_commits(spark, path)))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame | None:
    return _read(spark, path, QUARANTINE_SCHEMA, quarantine_runs(read_commits(spark, path)))


def read_check_log(spark: SparkSession, path: str) -> DataFrame | None:
    return _read(spark, path, CHECK_LOG_SCHEMA, last_runs(read_commits(spark, path)))


def read_numbering(spark: SparkSession, path: str, day: dt.date, runs: list[str]) -> DataFrame | None:
    """The first row per order id that these runs of a day found; None if one of them kept none."""
    folder = day_folder(path, LOAD_DATE, day)
    names = [f"{RUN}={r}" for r in runs]
    if not names or not set(names) <= folder_names(spark, folder):
        return None
    return spark.read.schema(NUMBERING_SCHEMA).parquet(*[f"{folder}/{n}" for n in names])


def or_empty(spark: SparkSession, df: DataFrame | None, schema: T.StructType) -> DataFrame:
    return df if df is not None else spark.createDataFrame([], schema)


__all__ = [
    "session_conf",
    "GOLD_CLUSTER",
    "QUARANTINE_SCHEMA",
    "write_gold",
    "write_quarantine",
    "RUN",
    "commit_run",
    "commits_path",
    "compact_gold",
    "day_runs",
    "drop_replaced",
    "drop_uncounted",
    "gold_runs",
    "last_runs",
    "new_run",
    "read_commits",
    "write_check_log",
    "write_numbering",
    "read_gold",
    "read_numbering",
    "read_quarantine",
    "read_check_log",
    "or_empty",
    "pack_rows",
    "unpack_rows",
]
