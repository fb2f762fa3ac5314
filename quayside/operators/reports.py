"""Reporting queries over the pipeline tables, and the raw-data defect profile.

Reports are grouped counts (partial + final hash aggregate) with the ORDER BY of the
warehouse queries; the defect profile is one single-pass aggregate over raw.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.casts import safe_date, safe_double
from quayside.functions.text import ws_trim
from quayside.operators.checks import as_date_lit
from quayside.schema import BUSINESS_COLUMNS, REASON_CODES

# Destination labels of the row-split report.
GOLD_LABEL, QUARANTINE_LABEL = "gold", "quarantine"


def destination_counts(gold: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows per destination table (Q1)."""
    return gold.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(GOLD_LABEL).alias("destination"), "row_count"
    ).unionByName(
        quarantine.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(QUARANTINE_LABEL).alias("destination"), "row_count"
        )
    )


def staged_destination_counts(staged: DataFrame) -> DataFrame:
    """The same for the staged rows of a day, in one aggregate."""
    counts = staged.agg(F.count_if("is_valid").alias("g"), F.count_if(~F.col("is_valid")).alias("q"))
    return counts.select(F.expr(f"stack(2, '{GOLD_LABEL}', g, '{QUARANTINE_LABEL}', q) AS (destination, row_count)"))


def quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    """Rejected rows per full reason string, most frequent first (Q2)."""
    return quarantine.groupBy("_failure_reason").agg(F.count(F.lit(1)).alias("rejected_rows")).orderBy(
        F.desc("rejected_rows"), F.asc("_failure_reason")
    )


def rejects_by_code(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows whose reason text contains each code (one aggregate, one row).

    The reason-text form of the per-check counts (a LIKE '%CODE%' per check); codes
    are matched as plain substrings, so '_' in a code is not a wildcard.
    """
    reason = F.col("_failure_reason")
    return quarantine.agg(
        *[F.count_if(reason.contains(code)).alias(code.lower()) for _, code in REASON_CODES]
    )


def check_log_history(log: DataFrame) -> DataFrame:
    """The check log, newest day first, then by check name (Q3)."""
    return log.select("run_date", "check_name", "status", "total_rows", "failing_rows", "pct_failed").orderBy(
        F.desc("run_date"), F.asc("check_name")
    )


def orders_by_store(gold: DataFrame) -> DataFrame:
    """Gold orders per normalised store name (Q4)."""
    return gold.groupBy("store_name").agg(F.count(F.lit(1)).alias("orders")).orderBy(F.desc("orders"), "store_name")


def orders_by_product(gold: DataFrame) -> DataFrame:
    """Gold orders per normalised product name (Q5)."""
    return gold.groupBy("product_name").agg(F.count(F.lit(1)).alias("orders")).orderBy(
        F.desc("orders"), "product_name"
    )


def raw_landing_count(raw: DataFrame) -> DataFrame:
    """Rows landed in raw (Q6)."""
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"))


def raw_profile(raw: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Defect totals of raw orders in one pass (the generator's printed summary).

    duplicate_order_ids counts rows beyond the first per id, NULL counting as a value;
    future dates are strictly after the run day; zero revenue is revenue == 0 with no
    quantity test; names with surrounding whitespace count NULL names too.
    """
    od, sd = safe_date("order_date"), safe_date("ship_date")
    rev = safe_double("revenue")
    p = F.col("product_name")
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(BUSINESS_COLUMNS)).alias("n_columns"),
        (
            F.count(F.lit(1))
            - F.count_distinct("order_id")
            - F.coalesce(F.max(F.col("order_id").isNull().cast("int")), F.lit(0)).cast("bigint")
        ).alias("duplicate_order_ids"),
        F.count_if(od > as_date_lit(as_of)).alias("future_order_dates"),
        F.count_if(rev == 0).alias("zero_revenue"),
        F.count_if(F.col("store_name").isNull()).alias("missing_store_name"),
        F.count_if(F.col("customer_email").isNull()).alias("missing_customer_email"),
        F.count_if(sd < od).alias("ship_before_order"),
        F.count_if(p.isNull() | (p != ws_trim(p))).alias("dirty_product_names"),
        F.count_if(p.isNull() | (F.lower(p) != F.lower(ws_trim(p)))).alias("dirty_product_names_casefold"),
    )


def raw_preview(raw: DataFrame, n: int = 3) -> DataFrame:
    """First n raw rows in a total order (load time, file, hash): a top-n, not a sort."""
    return raw.orderBy("_loaded_at", "_source_file", "_row_hash").limit(n)


__all__ = [
    "GOLD_LABEL",
    "QUARANTINE_LABEL",
    "destination_counts",
    "quarantine_by_reason",
    "rejects_by_code",
    "check_log_history",
    "orders_by_store",
    "orders_by_product",
    "raw_landing_count",
    "raw_profile",
    "raw_preview",
]
