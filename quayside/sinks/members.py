"""Membership summaries of gold: which rows may be there, asked before gold is opened.

A run stores, beside its commit, a blocked Bloom filter of the row hashes of its valid rows for
every order date: one row per (order date, block) with eight 64-bit words. A row hash picks
its block by one 64-bit hash and a bit in each of the eight words by another. A date has the power
of two of blocks that leaves up to ``ROWS_PER_BLOCK`` rows a block on average (four to eight
bytes a row, a false hit in about 10^5 rows), so no block grows with the table. The exponent,
``level``, is part of the key: filters of runs with other sizes are asked side by side.

Summaries have a folder per run, sorted by date, so asking them lists a folder per run where
gold has one per date and run. A hit is only possible, never certain: the exact anti join follows, over
the rows with a possible hit and the gold folders of their dates alone. Rows without one are new.

Defined results: a null hash or date is never a member; repeated rows set the same bits; a run
without rows has a summary without rows; a run without a summary (``None``) means that gold itself must be asked.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.hashing import hash_bytes, hash_text
from quayside.schema import GOLD_SCHEMA, RUN
from quayside.session import drop_folder, hadoop_path

ROWS_PER_BLOCK = 16
WORDS = [f"w{i}" for i in range(8)]
KEY = ["order_date", "level", "block"]

MEMBERS_SCHEMA = T.StructType(
    [T.StructField("order_date", T.DateType(), True), T.StructField("level", T.IntegerType(), True)]
    + [T.StructField(c, T.LongType(), True) for c in ("block", *WORDS)]
)


def members_path(gold: str) -> str:
    """Where the summaries of the runs of a gold table are."""
    return f"{gold.rstrip('/').rsplit('/', 1)[0]}/gold_members"


def folder_names(spark: SparkSession, path: str) -> set[str]:
    """Names right below a folder, by one listing."""
    fs, root = hadoop_path(spark, path)
    return {f.getPath().getName() for f in fs.listStatus(root)} if fs.exists(root) else set()


def _block(row_hash: Column | str, level: Column | str) -> Column:
    return F.xxhash64(row_hash).bitwiseAND(F.expr(f"shiftleft(1L, {level}) - 1L"))


def _second(row_hash: str) -> Column:
    return F.xxhash64(F.lit("bits"), F.col(row_hash))


def _bits(second: Column) -> list[Column]:
    """The row's bit in each of the eight words, by its second hash."""
    shift = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(len(WORDS))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), s) for s in shift]


def summary(rows: DataFrame) -> DataFrame:
    """The filter of ``rows`` (order_date, _row_hash): a row per date and block.

    A row's block and second hash are shuffled by date and block, so a hot date is spread
    over its blocks; their eight words are made behind the shuffle. The counts that size them are a
    row per date (bounded by the calendar), broadcast to the rows.
    """
    known = rows.select("order_date", "_row_hash").where(F.col("_row_hash").isNotNull() & F.col("order_date").isNotNull())
    level = F.ceil(F.log2(F.greatest(F.col("n") / ROWS_PER_BLOCK, F.lit(1.0)))).cast("int")
    sizes = known.groupBy("order_date").agg(F.count(F.lit(1)).alias("n")).select("order_date", level.alias("level"))
    keyed = known.join(F.broadcast(sizes), "order_date").select(
        "order_date", "level", _block("_row_hash", "level").alias("block"), _second("_row_hash").alias("second")
    )
    words = [F.bit_or(b).alias(w) for w, b in zip(WORDS, _bits(F.col("second")))]
    return keyed.repartition(*KEY).groupBy(*KEY).agg(*words).select(*MEMBERS_SCHEMA.fieldNames())


def write_members(rows: DataFrame, gold: str, run: str) -> None:
    """Store the summary of a run's rows, which are read twice; it counts with the run's commit."""
    found = summary(rows).hint("rebalance", "order_date").sortWithinPartitions(*KEY)
    found.write.mode("overwrite").parquet(f"{members_path(gold)}/{RUN}={run}")


def written_rows(spark: SparkSession, gold: str, run: str, dates: list[dt.date] | None = None) -> DataFrame:
    """(order_date, _row_hash) of the gold files that a run wrote, committed or not; ``dates``, if known, are all its order dates."""
    if dates is None:
        names = [n.removeprefix("order_date=") for n in folder_names(spark, gold) if n.startswith("order_date=")]
        dates = [dt.date.fromisoformat(n) for n in names if n[:1].isdigit()]  # rows without a date are never members
    rows = read_gold_dates(spark, gold, dates, [run])
    if rows is None:
        return spark.createDataFrame([], "order_date date, _row_hash string")
    return rows.select("order_date", "_row_hash")


def read_members(spark: SparkSession, gold: str, runs: list[str]) -> DataFrame | None:
    """The summaries of these runs; None if one of them has none."""
    base = members_path(gold)
    names = [f"{RUN}={r}" for r in runs]
    if not names or not set(names) <= folder_names(spark, base):
        return None
    paths = [f"{base}/{n}" for n in names]
    return spark.read.schema(MEMBERS_SCHEMA).option("basePath", base).parquet(*paths).select(*MEMBERS_SCHEMA.fieldNames())


def possible(rows: DataFrame, members: DataFrame, dates: list[dt.date], keep: Sequence[str] = ()) -> DataFrame:
    """(order_date, _row_hash) of the rows that may be in gold; with ``keep`` these columns, too, and a row once per level that has it.

    ``dates`` are the rows' order dates (bounded by the calendar); they prune the summaries' row
    groups. A row goes once to every level that its date has a filter of: the levels, a few per
    date, are broadcast, and the one shuffle, by date and block, has hashes as their bytes.
    """
    asked = members.where(F.col("order_date").isin(dates))
    levels = asked.select("order_date", "level").distinct()
    code = hash_bytes("_row_hash")
    keyed = (
        rows.select("order_date", "_row_hash", *keep)
        .where(F.col("_row_hash").isNotNull())
        .join(F.broadcast(levels), "order_date")
        .select(
            *KEY[:2], _block("_row_hash", "level").alias("block"), code.alias("_code"), F.when(code.isNull(), F.col("_row_hash")).alias("_other"), *keep
        )
    )
    text = F.coalesce(hash_text("_code"), "_other")
    hit = F.lit(True)
    for w, b in zip(WORDS, _bits(_second("_row_hash"))):
        hit = hit & (F.col(w).bitwiseAND(b) != 0)
    met = keyed.join(asked, KEY).select(*KEY, text.alias("_row_hash"), *keep, *WORDS).where(hit)
    if not keep:
        return met.select("order_date", "_row_hash").distinct()
    # By block, too, as the rows lie behind the join: runs of one level share a task, so nothing is shuffled again.
    return met.select(*KEY, "_row_hash", *keep).distinct().select("order_date", "_row_hash", *keep)


def read_gold_dates(spark: SparkSession, gold: str, dates: list[dt.date], runs: list[str]) -> DataFrame | None:
    """Gold rows of these runs and order dates; no folder of another date is listed. None if there are none."""
    there = folder_names(spark, gold)
    names = [f"order_date={d.isoformat()}" for d in dates]
    paths = [f"{gold}/{n}" for n in names if n in there]
    if not paths or not runs:
        return None
    stored = T.StructType([*GOLD_SCHEMA.fields, T.StructField(RUN, T.StringType(), True)])
    rows = spark.read.schema(stored).option("basePath", gold).parquet(*paths)
    return rows.where(F.col(RUN).isin(runs)).select(*GOLD_SCHEMA.fieldNames())


def drop_members(spark: SparkSession, gold: str, live: set[str]) -> None:
    """Remove the summaries of runs that do not count."""
    base = members_path(gold)
    for name in folder_names(spark, base):
        if name.removeprefix(f"{RUN}=") not in live:
            drop_folder(spark, f"{base}/{name}")


__all__ = [
    "MEMBERS_SCHEMA",
    "ROWS_PER_BLOCK",
    "drop_members",
    "members_path",
    "possible",
    "read_gold_dates",
    "read_members",
    "summary",
    "write_members",
    "written_rows",
]
