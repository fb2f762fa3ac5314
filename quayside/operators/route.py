"""Routing of staged rows: gold projection, quarantine projection, already-loaded skip.

Every staged row goes to exactly one of gold (is_valid) or quarantine (not is_valid).
``skip_already_loaded`` drops gold candidates whose row hash is already in gold; it
runs after numbering and checks, so a rerun never promotes a quarantined copy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import normalise_product, normalise_store, nullif_blank, ws_trim
from quayside.operators.checks import as_date_lit
from quayside.schema import BUSINESS_COLUMNS, GOLD_COLUMNS, QUARANTINE_COLUMNS, QUARANTINE_DATE


def ts_lit(ts: dt.datetime | str) -> Column:
    """A TIMESTAMP literal read in the session time zone (UTC)."""
    text = ts.isoformat(sep=" ") if isinstance(ts, dt.datetime) else str(ts)
    return F.to_timestamp(F.lit(text))


def gold_projection(valid: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Typed, cleaned gold columns of valid staged rows."""
    exprs = {
        "order_id": ws_trim("order_id"),
        "order_date": F.col("order_date_cast"),
        "ship_date": F.col("ship_date_cast"),
        "customer_name": ws_trim("customer_name"),
        "customer_email": nullif_blank("customer_email"),
        "customer_state": ws_trim("customer_state"),
        "product_name": normalise_product("product_name"),
        "category": ws_trim("category"),
        "quantity": F.col("quantity_cast"),
        "unit_price": F.col("unit_price_cast"),
        "discount_pct": F.coalesce(F.col("discount_pct_cast"), F.lit(0.0)),
        "revenue": F.abs(F.col("revenue_cast")),
        "store_name": normalise_store("store_name"),
        "shipping_method": ws_trim("shipping_method"),
        "payment_method": ws_trim("payment_method"),
        "order_status": ws_trim("order_status"),
        "_source_file": F.col("_source_file"),
        "_row_hash": F.col("_row_hash"),
        "_loaded_at": F.col("_loaded_at"),
        "_gold_created_at": ts_lit(run_ts),
    }
    return valid.select(*[exprs[c].alias(c) for c in GOLD_COLUMNS])


def gold_rows(staged: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    return gold_projection(staged.where(F.col("is_valid")), run_ts)


def quarantine_rows(staged: DataFrame, run_ts: dt.datetime | str, as_of: dt.date | str | None = None) -> DataFrame:
    """Rejected rows with their raw text, the reason list and the rejection time.

    With ``as_of`` the run day is added as the partition column ``_quarantine_date``.
    """
    out = staged.where(~F.col("is_valid")).select(
        *BUSINESS_COLUMNS,
        "_source_file",
        "_row_hash",
        "_loaded_at",
        strip_trailing_comma("failure_reasons").alias("_failure_reason"),
        ts_lit(run_ts).alias("_quarantine_at"),
    )
    if as_of is not None:
        out = out.withColumn(QUARANTINE_DATE, as_date_lit(as_of))
    return out.select(*QUARANTINE_COLUMNS, *([QUARANTINE_DATE] if as_of is not None else []))


def strip_trailing_comma(c: Column | str) -> Column:
    """Reason clean-up of the warehouse form ('A, B,' -> 'A, B'); a no-op on our reasons."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r",\s*$", "")


def candidate_dates(candidates: DataFrame) -> list[dt.date]:
    """Distinct order dates of gold candidates (a calendar-bounded set, see below)."""
    return sorted(r[0] for r in candidates.select("order_date").distinct().collect())


def skip_already_loaded(
    candidates: DataFrame, gold: DataFrame | None, dates: list[dt.date] | None = None
) -> DataFrame:
    """Gold candidates whose _row_hash is not yet in gold.

    Equal hashes mean equal business columns, hence the same order_date, so the anti
    join is on (order_date, _row_hash), and only gold partitions of the candidates'
    order dates can hold a match. Those dates are fetched first (one column scan of
    the staged rows): valid dates are no later than the run day and have four-digit
    years, so the set is bounded by the calendar (a few thousand in practice) and
    becomes a partition filter on the gold scan; gold partitions of other days are
    never listed or read. The anti join shuffles on the near-unique hash, so it does
    not skew. NULL hashes never match.
    """
    if gold is None:
        return candidates
    if dates is None:
        dates = candidate_dates(candidates)
    if not dates:
        return candidates
    known = gold.where(F.col("order_date").isin(dates)).select("order_date", "_row_hash")
    return candidates.join(known, ["order_date", "_row_hash"], "left_anti")


__all__ = [
    "ts_lit",
    "gold_projection",
    "gold_rows",
    "quarantine_rows",
    "strip_trailing_comma",
    "candidate_dates",
    "skip_already_loaded",
]
