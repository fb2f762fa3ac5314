"""Staging: typing, duplicate marking and the eight row checks of a day's raw rows.

``stage`` is the chain raw day -> cast -> number -> check as one DataFrame plan:
six non-failing casts, the duplicate flag, eight boolean check flags, the reason
string (all failing codes, fixed order, ", "-joined) and the validity flag.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.casts import safe_bigint, safe_date, safe_double
from quayside.functions.text import is_blank
from quayside.operators.dedupe import mark_later_rows, with_row_ids
from quayside.schema import CAST_COLUMNS, REASON_CODES, REASON_SEPARATOR

# W1 order: load time first; source file and row hash break the ties of one file.
DEDUPE_ORDER = ("_loaded_at", "_source_file", "_row_hash")


def as_date_lit(as_of: dt.date | str) -> Column:
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))


def add_casts(df: DataFrame) -> DataFrame:
    """The six typed columns next to their raw text (order_date_cast, ...)."""
    casters = {
        "order_date": safe_date,
        "ship_date": safe_date,
        "quantity": safe_bigint,
        "unit_price": safe_double,
        "discount_pct": safe_double,
        "revenue": safe_double,
    }
    return df.withColumns({CAST_COLUMNS[c]: fn(F.col(c)) for c, fn in casters.items()})


def check_conditions(as_of: dt.date | str) -> dict[str, Column]:
    """The eight row checks as never-NULL boolean columns (duplicate flag precomputed); a NULL compares as false."""
    od, sd = F.col("order_date_cast"), F.col("ship_date_cast")
    qty, rev = F.col("quantity_cast"), F.col("revenue_cast")
    conds = {
        "missing_order_id": is_blank("order_id"),
        "duplicate_order_id": F.col("duplicate_order_id"),
        "invalid_order_date": od.isNull(),
        "future_order_date": od > as_date_lit(as_of),
        "ship_before_order_date": sd < od,
        "zero_revenue_with_qty": (qty > 0) & (rev <= 0),
        "missing_store_name": is_blank("store_name"),
        "missing_order_date_string": is_blank("order_date"),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in conds.items()}


def add_checks(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Eight flags, the reason string and is_valid. Expects casts and the duplicate flag."""
    flagged = df.withColumns(check_conditions(as_of))
    reasons = F.concat_ws(REASON_SEPARATOR, *[F.when(F.col(flag), F.lit(code)) for flag, code in REASON_CODES])
    # Valid is no reason at all, told by the flags, and the two of the order date in one test: a
    # filter by it, which takes in all it rests on, is short enough to be compiled.
    dated = F.coalesce(F.col("order_date_cast") <= as_date_lit(as_of), F.lit(False))
    others = [F.col(flag) for flag, _ in REASON_CODES if flag not in ("invalid_order_date", "future_order_date")]
    return flagged.withColumn("failure_reasons", reasons).withColumn("is_valid", dated & ~reduce(Column.__or__, others))


def stage(
    raw_day: DataFrame,
    as_of: dt.date | str,
    dedupe_method: str = "aggregate",
    kept: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """A day's raw rows, numbered, typed and checked (one row out per row in).

    Numbering comes first so its join moves only the raw columns; the casts are computed
    after it (numbering never depends on them). ``kept`` names rows that an earlier run
    of the day chose, ``path`` is where the first rows are stored (see ``mark_later_rows``).
    """
    numbered = mark_later_rows(
        with_row_ids(raw_day), "order_id", DEDUPE_ORDER, "duplicate_order_id", method=dedupe_method, kept=kept, path=path
    )
    return add_checks(add_casts(numbered), as_of)


__all__ = ["DEDUPE_ORDER", "add_casts", "check_conditions", "add_checks", "stage", "as_date_lit"]
