"""The daily gold run: stage a load day, then quarantine, gold, the check log and the commit.

1. Stage the day's raw partition (casts, duplicate marking, eight checks): the first row of
   every order id is written as bitmaps to a folder of this run, so the numbering shuffle
   runs once and a lost executor never changes which row won; steps 2-4 read raw with
   these bitmaps and type and check the columns that they use, so no row of raw is written a second
   time (but where the bitmaps are too large to be broadcast: there the staged rows are). The
   folder goes when the run ends, also if it fails. On a day that ran before over other raw files, the rows of the
   day that are in gold keep their place: a file landed since then cannot put a second row of
   their order id into gold.
2. Quarantine: the day's rejected rows, in place of those of the day's last run.
3. Gold: append valid rows whose row hash is not in gold yet. Membership summaries tell which
   rows may be there (``sinks.members``); only the gold folders of those rows' dates are listed
   and read. If the day ran before over the very files that raw has now, all its rows are
   there: gold is neither read nor written.
4. Check log: the run day's rows (one aggregate over the staged rows, and the counts that
   gold's commits and raw's batches keep; ``recount`` counts both tables anew).
5. Commit: one record, which makes the rows of 2-4 count (see ``sinks.tables``). A run that
   breaks off before it leaves nothing that a reader sees, and is simply run again.

``as_of`` (the run day) and ``run_ts`` (the run's timestamp) are parameters, never
clock reads, so any day can be re-run or back-filled.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.operators.checklog import check_log
from quayside.operators.checks import DEDUPE_ORDER, stage
from quayside.operators.dedupe import ROW_ID_COLUMNS, bitmaps_fit, first_row_bitmaps, rows_in, with_row_ids
from quayside.operators.route import candidate_dates, gold_projection, gold_rows, quarantine_rows, skip_already_loaded, ts_lit
from quayside.plans.metrics import write_metrics
from quayside.plans.observed import observed_metrics
from quayside.schema import GOLD_SCHEMA, LOAD_DATE, QUARANTINE_DATE
from quayside.session import Lakehouse, drop_folder, drops_shuffles, path_exists
from quayside.sinks.members import possible, read_gold_dates, read_members, write_members, written_rows
from quayside.sinks.tables import (
    RUN,
    commit_run,
    drop_replaced,
    gold_runs,
    new_run,
    or_empty,
    read_commits,
    read_gold,
    write_check_log,
    write_gold,
    write_numbering,
    write_quarantine,
)
from quayside.sources.raw_table import raw_day, raw_row_count, read_raw, read_raw_day


@dataclass
class GoldRunResult:
    as_of: dt.date
    staged_rows: int
    gold_appended: int
    quarantined: int


def observed_rows(obs: Observation) -> int:
    """Observed row count; an empty plan that AQE removed reports no metric, which is 0."""
    return int(observed_metrics(obs).get("n", 0))


def _day(as_of: dt.date | str) -> dt.date:
    return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))


def raw_state(files: Iterable[str]) -> str:
    """A digest of the raw files of a day: equal only if no batch was added, replaced or removed."""
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def chosen_before(gold: DataFrame, day: dt.date) -> DataFrame:
    """The numbering columns of gold rows loaded on the day.

    The load-time filter reaches the Parquet scan: files of other days' runs are skipped
    by their statistics.
    """
    start, end = (ts_lit(f"{d.isoformat()} 00:00:00") for d in (day, day + dt.timedelta(days=1)))
    return gold.where((F.col("_loaded_at") >= start) & (F.col("_loaded_at") < end)).select(*DEDUPE_ORDER)


def staging_folder(lake: Lakehouse, day: dt.date, run: str) -> str:
    return f"{lake.staging}/run_date={day.isoformat()}/{run}"


def stage_to_storage(
    spark: SparkSession,
    raw: DataFrame,
    lake: Lakehouse,
    as_of: dt.date | str,
    kept: DataFrame | None = None,
    run: str | None = None,
) -> DataFrame:
    """Stage the run day over first rows that are stored in a folder of its own under the staging folder."""
    day = _day(as_of)
    folder = staging_folder(lake, day, run or new_run(day))
    return stored_staged(stage(raw_day(raw, day), day, kept=kept, path=first_rows_path(folder)), folder)


def first_rows_path(folder: str) -> str:
    return f"{folder}/first_rows"


def stored_staged(staged: DataFrame, folder: str) -> DataFrame:
    """Staged rows that can be read often: as they are if the stored first rows are broadcast to them, else a copy.

    Without the broadcast every reading would shuffle the rows to their bitmaps.
    """
    spark = staged.sparkSession
    if bitmaps_fit(spark, first_rows_path(folder)):
        return staged
    path = f"{folder}/rows"
    staged.drop(*ROW_ID_COLUMNS).write.parquet(path)
    return with_row_ids(spark.read.option("basePath", path).parquet(path))


def observe_staged(staged: DataFrame, observation: Observation) -> DataFrame:
    """``observation`` gets the row count (n) and the order dates of valid rows (dates), a
    set bounded by the calendar: they are no later than the run day, with four-digit years.
    """
    dates = F.collect_set(F.when(F.col("is_valid"), F.col("order_date_cast")))
    return staged.observe(observation, F.count(F.lit(1)).alias("n"), dates.alias("dates"))


def gold_day(spark: SparkSession, lake: Lakehouse, before: list, runs: list[str]) -> DataFrame | None:
    """Gold that can hold rows of a day's earlier runs: the dates in their summaries, or all of it
    if one of these runs was compacted into another or has no summary."""
    mine = [c[RUN] for c in before]
    members = read_members(spark, lake.gold, mine) if set(mine) <= set(runs) else None
    if members is None:
        return read_gold(spark, lake.gold)
    dates = sorted(r[0] for r in members.select("order_date").distinct().collect())
    return read_gold_dates(spark, lake.gold, dates, mine)


def new_in_gold(
    spark: SparkSession, staged: DataFrame, lake: Lakehouse, runs: list[str], dates: list[dt.date], run_ts: dt.datetime | str, path: str
) -> DataFrame:
    """The gold rows of valid staged rows that are not in gold yet, told by the runs' summaries and then, where a row may be there, by gold.

    The possible hits are written below ``path`` once, with their row ids: their dates (bounded by the calendar) pick the
    gold folders, and only they go into the exact join with gold. Those that are there become bitmaps, by
    which the rows are left out in their own scan: no row is shuffled to be told from gold.
    """
    valid = staged.where(F.col("is_valid"))
    if not runs or not dates:
        return gold_projection(valid, run_ts)
    members = read_members(spark, lake.gold, runs)
    if members is None:
        return skip_already_loaded(gold_projection(valid, run_ts), read_gold(spark, lake.gold), dates)
    asked = valid.select(F.col("order_date_cast").alias("order_date"), "_row_hash", *ROW_ID_COLUMNS)
    possible(asked, members, dates, ROW_ID_COLUMNS).write.parquet(hit_rows(path))
    hits = spark.read.schema(asked.schema).parquet(hit_rows(path))
    gold = read_gold_dates(spark, lake.gold, candidate_dates(hits), runs)
    if gold is None:
        return gold_projection(valid, run_ts)
    known = hits.join(gold.select("order_date", "_row_hash"), ["order_date", "_row_hash"], "left_semi")
    marks = first_row_bitmaps(known.select(*ROW_ID_COLUMNS), f"{path}/known")
    return gold_projection(rows_in(valid, marks, "_known").where(~F.col("_known")), run_ts)


def hit_rows(path: str) -> str:
    return f"{path}/rows"


def write_rejected(
    staged: DataFrame, lake: Lakehouse, day: dt.date, run: str, run_ts: dt.datetime | str, observation: Observation
) -> int:
    """Write the run's quarantine; returns its rows. ``observation`` is that of all staged rows, made on the way."""
    obs = Observation("quarantine")
    rejected = quarantine_rows(observe_staged(staged, observation), run_ts, day)
    write_quarantine(rejected.observe(obs, F.count(F.lit(1)).alias("n")), lake.quarantine, day, run)
    return observed_rows(obs)


def write_valid(
    spark: SparkSession,
    staged: DataFrame,
    lake: Lakehouse,
    runs: list[str],
    dates: list[dt.date],
    run: str,
    run_ts: dt.datetime | str,
    hits_path: str,
) -> int:
    """Append the valid rows that are not in gold yet, and the run's summary; returns the rows appended."""
    obs, valid = Observation("gold"), gold_rows(staged, run_ts)
    new_gold = new_in_gold(spark, staged, lake, runs, dates, run_ts, hits_path)
    write_gold(new_gold.observe(obs, F.count(F.lit(1)).alias("n")), lake.gold, run)
    # Of all valid rows: those that are in gold by another run are members by right. They are the rows
    # just written and the possible hits (a row in filters of several levels counts as often in the size); only
    # where gold was asked as a whole are they staged anew.
    if path_exists(spark, hit_rows(hits_path)):
        hits = spark.read.schema("order_date date, _row_hash string").parquet(hit_rows(hits_path))
        valid = written_rows(spark, lake.gold, run, dates).unionByName(hits)
    elif not runs or not dates:
        valid = written_rows(spark, lake.gold, run, dates)
    write_members(valid, lake.gold, run)
    return observed_rows(obs)


@drops_shuffles
def run_gold(
    spark: SparkSession,
    lake: Lakehouse,
    as_of: dt.date | str,
    run_ts: dt.datetime | str,
    *,
    all_eight: bool = False,
    recount: bool = False,
    keep_numbering: bool = False,
) -> GoldRunResult:
    """Run the gold pipeline for one load day (idempotent; see module docstring).

    With ``keep_numbering`` the first row per order id is stored, so that runs over new rows
    alone can extend the day (``plans.gold_increment``).
    """
    day = _day(as_of)
    commits = read_commits(spark, lake.gold)
    raw = read_raw_day(spark, lake.raw, day)
    state = raw_state(raw.inputFiles())
    before = [c for c in commits if c.as_of == day]
    # The same files as when the day first ran: its numbering needs no gold, and gold has its rows.
    unchanged = bool(before) and all(c.raw_state == state for c in before)
    runs = gold_runs(commits)
    gold = gold_day(spark, lake, before, runs) if before and not unchanged else None
    kept = chosen_before(gold, day) if gold is not None else None

    run = new_run(day)
    hits_path = f"{lake.staging}/possible_hits/{run}"
    staged_obs = Observation("staged")
    try:
        # Only the run day's raw folder is listed for staging.
        st = stage_to_storage(spark, raw, lake, day, kept, run)

        quarantined = write_rejected(st, lake, day, run, run_ts, staged_obs)
        appended = 0
        if not unchanged:
            dates = sorted(observed_metrics(staged_obs).get("dates") or [])
            appended = write_valid(spark, st, lake, runs, dates, run, run_ts, hits_path)
        else:
            write_members(gold_rows(st, run_ts).limit(0), lake.gold, run)
        if keep_numbering:
            write_numbering(st, lake.numbering, day, run)

        if recount:
            mine = spark.range(appended).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD_SCHEMA.fields])
            gold_now = mine.unionByName(or_empty(spark, read_gold(spark, lake.gold), GOLD_SCHEMA))
            log = check_log(st, gold_now, read_raw(spark, lake.raw), day, run_ts, all_eight)
        else:
            known = (sum(c.gold_appended for c in commits) + appended, raw_row_count(spark, lake.raw))
            log = check_log(st, None, None, day, run_ts, all_eight, known)
        write_check_log(log, lake.check_log, day, run)
    finally:
        drop_folder(spark, staging_folder(lake, day, run))
        drop_folder(spark, hits_path)

    result = GoldRunResult(as_of=day, staged_rows=observed_rows(staged_obs), gold_appended=appended, quarantined=quarantined)
    commit_run(spark, lake.gold, run, day, appended, result.quarantined, state)
    drop_replaced(spark, lake.quarantine, QUARANTINE_DATE, day, [run])
    drop_replaced(spark, lake.check_log, "run_date", day, [run])
    drop_replaced(spark, lake.numbering, LOAD_DATE, day, [run])
    values = {"staged_rows": result.staged_rows, "gold_appended": appended, "quarantined": result.quarantined}
    write_metrics(spark, lake.run_metrics, "gold", f"gold-{day.isoformat()}", run_ts, values)
    return result


__all__ = ["GoldRunResult", "chosen_before", "gold_day", "new_in_gold", "raw_state", "stage_to_storage", "stored_staged", "run_gold"]
