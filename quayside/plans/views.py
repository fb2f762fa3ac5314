"""SQL access: the pipeline tables as temporary views, and the verification reports
as Spark SQL text (the same results as the DataFrame functions in operators.reports).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.schema import GOLD_SCHEMA
from quayside.session import Lakehouse
from quayside.sinks.tables import QUARANTINE_SCHEMA, or_empty, read_check_log, read_gold, read_quarantine
from quayside.schema import CHECK_LOG_SCHEMA
from quayside.sources.raw_table import read_raw

VIEW_NAMES = {
    "raw": "raw_orders",
    "gold": "gold_orders",
    "quarantine": "orders_quarantine",
    "check_log": "dq_run_log",
}

# Verification reports over the views (ordinals in GROUP BY / ORDER BY are Spark SQL too).
REPORT_SQL = {
    "destination_counts": """
        SELECT 'gold' AS destination, COUNT(*) AS row_count FROM gold_orders
        UNION ALL
        SELECT 'quarantine', COUNT(*) FROM orders_quarantine""",
    "quarantine_by_reason": """
        SELECT _failure_reason, COUNT(*) AS rejected_rows
        FROM orders_quarantine GROUP BY 1 ORDER BY 2 DESC, 1""",
    "check_log_history": """
        SELECT run_date, check_name, status, total_rows, failing_rows, pct_failed
        FROM dq_run_log ORDER BY run_date DESC, check_name""",
    "orders_by_store": """
        SELECT store_name, COUNT(*) AS orders FROM gold_orders GROUP BY store_name ORDER BY orders DESC, store_name""",
    "orders_by_product": """
        SELECT product_name, COUNT(*) AS orders FROM gold_orders GROUP BY product_name ORDER BY orders DESC, product_name""",
    "raw_landing_count": "SELECT COUNT(*) AS raw_rows FROM raw_orders",
}


def register_views(spark: SparkSession, lake: Lakehouse) -> dict[str, DataFrame]:
    """Register the four tables as temporary views (empty views for tables not yet written)."""
    frames = {
        "raw": read_raw(spark, lake.raw),
        "gold": or_empty(spark, read_gold(spark, lake.gold), GOLD_SCHEMA),
        "quarantine": or_empty(spark, read_quarantine(spark, lake.quarantine), QUARANTINE_SCHEMA),
        "check_log": or_empty(spark, read_check_log(spark, lake.check_log), CHECK_LOG_SCHEMA),
    }
    for key, df in frames.items():
        df.createOrReplaceTempView(VIEW_NAMES[key])
    return frames


def report(spark: SparkSession, name: str) -> DataFrame:
    """Run one verification report over the registered views."""
    return spark.sql(REPORT_SQL[name])


__all__ = ["VIEW_NAMES", "REPORT_SQL", "register_views", "report"]
