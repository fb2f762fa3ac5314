"""Stored run metrics: one row per metric of a landing batch or a gold run.

The values come from observations of the writes themselves and from the table of files, so
storing them reads no data again. A run that is done again replaces its own rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.route import ts_lit
from quayside.sources.raw_table import BATCH, _read_or_empty, replace_batch

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType(), True),
        T.StructField("metric", T.StringType(), True),
        T.StructField("value", T.LongType(), True),
        T.StructField("run_at", T.TimestampType(), True),
        T.StructField(BATCH, T.StringType(), True),
    ]
)


def write_metrics(
    spark: SparkSession, path: str, kind: str, run: str, run_at: dt.datetime | str, values: dict[str, int]
) -> None:
    """Store a run's metrics (a handful of rows, in one file)."""
    rows = spark.createDataFrame([(kind, k, int(v)) for k, v in values.items()], "kind string, metric string, value long")
    replace_batch(rows.withColumn("run_at", ts_lit(run_at)).coalesce(1), path, run)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(kind, metric, value, run_at, run) of every run."""
    return _read_or_empty(spark, path, METRICS_SCHEMA).withColumnRenamed(BATCH, "run").select(
        "kind", "run", "metric", "value", F.col("run_at")
    )


__all__ = ["METRICS_SCHEMA", "read_metrics", "write_metrics"]
