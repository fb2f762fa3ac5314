"""Table schemas and the fixed values the pipeline's results depend on.

Everything in the "fixed values" blocks below must stay exactly as written: reason
codes, check names, NULL tokens and the store lookup decide which rows reach gold
and what the check log says.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Business columns of a raw order, in landing order.
# --------------------------------------------------------------------------------------
BUSINESS_COLUMNS: tuple[str, ...] = (
    "order_id",
    "order_date",
    "ship_date",
    "customer_name",
    "customer_email",
    "customer_state",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "discount_pct",
    "revenue",
    "store_name",
    "shipping_method",
    "payment_method",
    "order_status",
)

AUDIT_COLUMNS: tuple[str, ...] = ("_loaded_at", "_source_file", "_row_hash")

# Raw table partition column (derived from _loaded_at in UTC).
LOAD_DATE = "_load_date"

# --------------------------------------------------------------------------------------
# Exact, case-sensitive, untrimmed tokens that ingestion turns into NULL.
# --------------------------------------------------------------------------------------
NULL_TOKENS: tuple[str, ...] = ("", "NA", "N/A", "null", "NULL")

# --------------------------------------------------------------------------------------
# Row-check reason codes, in the order they are listed in a reason string.
# --------------------------------------------------------------------------------------
REASON_CODES: tuple[tuple[str, str], ...] = (
    ("missing_order_id", "MISSING_ORDER_ID"),
    ("duplicate_order_id", "DUPLICATE_ORDER_ID"),
    ("invalid_order_date", "INVALID_ORDER_DATE"),
    ("future_order_date", "FUTURE_ORDER_DATE"),
    ("ship_before_order_date", "SHIP_BEFORE_ORDER_DATE"),
    ("zero_revenue_with_qty", "ZERO_REVENUE_WITH_QTY"),
    ("missing_store_name", "MISSING_STORE_NAME"),
    ("missing_order_date_string", "MISSING_ORDER_DATE_STRING"),
)
CHECK_FLAGS: tuple[str, ...] = tuple(flag for flag, _ in REASON_CODES)
REASON_SEPARATOR = ", "

# --------------------------------------------------------------------------------------
# Check-log rows (check name -> row-check flag), in log order.
# The first five are the logged checks; the last three are the unlogged row checks,
# added only when the "all eight" option is on.
# --------------------------------------------------------------------------------------
LOGGED_CHECKS: tuple[tuple[str, str], ...] = (
    ("no_duplicate_order_ids", "duplicate_order_id"),
    ("no_future_order_dates", "future_order_date"),
    ("ship_date_after_order_date", "ship_before_order_date"),
    ("no_zero_revenue_with_quantity", "zero_revenue_with_qty"),
    ("store_name_not_missing", "missing_store_name"),
)
EXTRA_CHECKS: tuple[tuple[str, str], ...] = (
    ("order_id_not_missing", "missing_order_id"),
    ("order_date_parseable", "invalid_order_date"),
    ("order_date_string_not_missing", "missing_order_date_string"),
)
RECONCILIATION_CHECK = "gold_vs_raw_row_count_check"
# Gold may differ from raw by less than this fraction of raw (all time).
RECONCILIATION_TOLERANCE = (1, 10)  # 0.10 as a fraction, for exact comparison in integers
PASS, FAIL = "PASS", "FAIL"

# --------------------------------------------------------------------------------------
# Canonical store names. Lower-cased, trimmed raw names in each list map
# to the canonical name; any other name is title-cased.
# --------------------------------------------------------------------------------------
STORE_LOOKUP: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Garden Grove Store", ("garden grove store", "garden grove")),
    ("Pacific Coast Store", ("pacific coast store", "pacific coast")),
    ("Lakeside Outlet", ("lakeside outlet", "lakeside")),
    ("Mountain View Store", ("mountain view", "mountain view store")),
    ("Prairie Home Store", ("prairie home", "prairie home store")),
)

# --------------------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------------------
_S, _TS = T.StringType(), T.TimestampType()

RAW_SCHEMA = T.StructType(
    [T.StructField(c, _S, True) for c in BUSINESS_COLUMNS]
    + [
        T.StructField("_loaded_at", _TS, True),
        T.StructField("_source_file", _S, True),
        T.StructField("_row_hash", _S, True),
    ]
)

GOLD_TYPES = {
    "order_date": T.DateType(),
    "ship_date": T.DateType(),
    "quantity": T.LongType(),
    "unit_price": T.DoubleType(),
    "discount_pct": T.DoubleType(),
    "revenue": T.DoubleType(),
}
GOLD_SCHEMA = T.StructType(
    [T.StructField(c, GOLD_TYPES.get(c, _S), c != "order_id") for c in BUSINESS_COLUMNS]
    + [
        T.StructField("_source_file", _S, True),
        T.StructField("_row_hash", _S, True),
        T.StructField("_loaded_at", _TS, True),
        T.StructField("_gold_created_at", _TS, True),
    ]
)
GOLD_COLUMNS: tuple[str, ...] = tuple(GOLD_SCHEMA.fieldNames())

QUARANTINE_COLUMNS: tuple[str, ...] = BUSINESS_COLUMNS + (
    "_source_file",
    "_row_hash",
    "_loaded_at",
    "_failure_reason",
    "_quarantine_at",
)
QUARANTINE_DATE = "_quarantine_date"

#: Partition column that tells a run's files.
RUN = "_run"

CHECK_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_date", T.DateType(), True),
        T.StructField("check_name", _S, True),
        T.StructField("status", _S, True),
        T.StructField("total_rows", T.LongType(), True),
        T.StructField("failing_rows", T.LongType(), True),
        T.StructField("pct_failed", T.DoubleType(), True),
        T.StructField("checked_at", _TS, True),
    ]
)
CHECK_LOG_COLUMNS: tuple[str, ...] = tuple(CHECK_LOG_SCHEMA.fieldNames())

# Cast columns added while staging, keyed by the raw column they come from.
CAST_COLUMNS = {
    "order_date": "order_date_cast",
    "ship_date": "ship_date_cast",
    "quantity": "quantity_cast",
    "unit_price": "unit_price_cast",
    "discount_pct": "discount_pct_cast",
    "revenue": "revenue_cast",
}
