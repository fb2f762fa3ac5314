"""The data-quality check log: one row per check per run day, plus reconciliation.

All counts of a run day's log come from ONE aggregate (a count and one count_if per
check over the staged rows, plus the all-time gold and raw counts), turned into rows
with ``stack``; the warehouse form needs five quarantine scans and nineteen scalar
subqueries for the same numbers.
"""

from __future__ import annotations

import datetime as dt

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.checks import as_date_lit
from quayside.operators.route import ts_lit
from quayside.schema import (
    CHECK_LOG_COLUMNS,
    EXTRA_CHECKS,
    FAIL,
    LOGGED_CHECKS,
    PASS,
    RECONCILIATION_CHECK,
    RECONCILIATION_TOLERANCE,
)


def round_pct(part: str, whole: str) -> Column:
    """ROUND(part * 100 / NULLIF(whole, 0), 2), rounded half up exactly in integers.

    Both counts are integers, so (part*20000 + whole) div (2*whole) is the percentage
    in hundredths rounded half up; one final division by 100.0 gives the double.
    """
    hundredths = F.expr(f"({part} * 20000 + {whole}) div (2 * {whole})")
    return F.when(F.col(whole) > 0, hundredths.cast("double") / F.lit(100.0))


def checks_for(all_eight: bool) -> tuple[tuple[str, str], ...]:
    return LOGGED_CHECKS + (EXTRA_CHECKS if all_eight else ())


def check_log(
    staged: DataFrame,
    gold: DataFrame | None,
    raw: DataFrame | None,
    as_of: dt.date | str,
    run_ts: dt.datetime | str,
    all_eight: bool = False,
    known: tuple[int, int] | None = None,
) -> DataFrame:
    """The run day's log rows (the checks, then the reconciliation) from ONE aggregate.

    The staged rows, the gold table and the raw table are tagged and unioned, and a
    single aggregate yields the day total, every check's failing count and both
    all-time table counts; ``stack`` turns that one row into the log rows. Gold and
    raw contribute no columns, so their scans read file footers only. With ``gold``
    None the gold count is the day's valid rows (gold right after a first run), so
    the staged rows are read once. With ``known``, the all-time counts of gold and raw that
    the tables keep, neither table is read at all.
    """
    checks = checks_for(all_eight)
    zero, one = F.lit(0), F.lit(1)
    flags = [F.col(flag).alias(f"_f{i}") for i, (_, flag) in enumerate(checks)]
    no_flags = [F.lit(False).alias(f"_f{i}") for i in range(len(checks))]
    day_gold = F.col("is_valid").cast("int") if gold is None and known is None else zero
    parts = [staged.select(one.alias("_s"), day_gold.alias("_g"), zero.alias("_r"), *flags)]
    if gold is not None and known is None:
        parts.append(gold.select(zero.alias("_s"), one.alias("_g"), zero.alias("_r"), *no_flags))
    if known is None:
        parts.append(raw.select(zero.alias("_s"), zero.alias("_g"), one.alias("_r"), *no_flags))
    tagged = reduce(DataFrame.unionByName, parts)

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    agg = tagged.agg(
        total("_s").alias("_total"),
        (total("_g") if known is None else F.lit(known[0]).cast("bigint")).alias("_gold"),
        (total("_r") if known is None else F.lit(known[1]).cast("bigint")).alias("_raw"),
        *[F.count_if(F.col(f"_f{i}")).cast("bigint").alias(f"_n{i}") for i in range(len(checks))],
    )
    arms = [f"'{name}', _n{i}, _total" for i, (name, _) in enumerate(checks)]
    arms.append(f"'{RECONCILIATION_CHECK}', abs(_gold - _raw), _raw")
    long = agg.select(
        F.expr(f"stack({len(arms)}, {', '.join(arms)}) AS (check_name, failing_rows, total_rows)")
    )
    return _log_rows(long, as_of, run_ts)


def add_to_log(log: DataFrame, earlier: DataFrame, as_of: dt.date | str, run_ts: dt.datetime | str) -> DataFrame:
    """The run day's log over the rows of ``log`` and of ``earlier``, logs of disjoint rows of the day.

    The checks' counts add up; the reconciliation, of all-time counts, is that of ``log``.
    """
    counts = log.unionByName(earlier.select(*log.columns)).where(F.col("check_name") != RECONCILIATION_CHECK)
    counts = counts.groupBy("check_name").agg(F.sum("failing_rows").alias("failing_rows"), F.sum("total_rows").alias("total_rows"))
    reconciled = log.where(F.col("check_name") == RECONCILIATION_CHECK).select(*counts.columns)
    return _log_rows(counts.unionByName(reconciled), as_of, run_ts)


def _log_rows(long: DataFrame, as_of: dt.date | str, run_ts: dt.datetime | str) -> DataFrame:
    """Log rows of (check_name, failing_rows, total_rows)."""
    failing, whole = F.col("failing_rows"), F.col("total_rows")
    part, of = RECONCILIATION_TOLERANCE
    within = (whole > 0) & (failing * of < whole * part)
    status = F.when(
        F.col("check_name") == F.lit(RECONCILIATION_CHECK), F.when(within, F.lit(PASS)).otherwise(F.lit(FAIL))
    ).otherwise(F.when(failing == 0, F.lit(PASS)).otherwise(F.lit(FAIL)))
    return long.select(
        as_date_lit(as_of).alias("run_date"),
        "check_name",
        status.alias("status"),
        whole.cast("bigint").alias("total_rows"),
        failing.cast("bigint").alias("failing_rows"),
        round_pct("failing_rows", "total_rows").alias("pct_failed"),
        ts_lit(run_ts).alias("checked_at"),
    ).select(*CHECK_LOG_COLUMNS)


__all__ = ["add_to_log", "round_pct", "check_log", "checks_for"]
