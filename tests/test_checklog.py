"""Check-log arithmetic and the row-id fallback for inputs that are not file scans."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators.checklog import check_log, round_pct
from quayside.operators.checks import stage
from quayside.schema import RAW_SCHEMA

from helpers import DAY, TS, raw_row


def test_round_pct_half_up_exact(spark):
    cases = [(1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 200, 0.5), (1, 160, 0.63), (0, 5, 0.0),
             (5, 5, 100.0), (1, 0, None), (11019, 44807, 24.59), (30278, 60000, 50.46)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a bigint, b bigint")
    got = [r[0] for r in df.select(round_pct("a", "b")).collect()]
    assert got == [want for _, _, want in cases]


def test_reconciliation_edges(spark):
    """The rule that runs: gold rows against raw rows in the check log."""
    none = spark.createDataFrame([raw_row()], RAW_SCHEMA).withColumn("_load_date", F.to_date("_loaded_at"))
    staged = stage(none, DAY).limit(0)
    for gold, raw, want in (
        (0, 0, ("FAIL", 0, None)),
        (95, 100, ("PASS", 5, 5.0)),
        (90, 100, ("FAIL", 10, 10.0)),  # exactly 10 % is not < 10 %
        (89, 100, ("FAIL", 11, 11.0)),
    ):
        log = check_log(staged, spark.range(gold), spark.range(raw), DAY, "2024-03-11 07:00:00")
        (r,) = log.where("check_name = 'gold_vs_raw_row_count_check'").collect()
        assert (r["status"], r["failing_rows"], r["pct_failed"]) == want


def test_stage_on_a_non_file_input_uses_checkpointed_row_ids(spark):
    rows = [raw_row(order_id="K", row_hash="same")] * 3 + [raw_row(order_id=None, row_hash=f"n{i}") for i in range(4)]
    df = spark.createDataFrame(rows, RAW_SCHEMA).withColumn("_load_date", F.to_date("_loaded_at"))
    st = stage(df, DAY)
    firsts = {r["order_id"]: r["n"] for r in st.where(~F.col("duplicate_order_id")).groupBy("order_id")
              .agg(F.count("*").alias("n")).collect()}
    assert firsts == {"K": 1, None: 1}
    assert st.count() == 7
    assert st.select("_rid_file").distinct().first()[0] == "checkpoint"


def test_loaded_at_type_is_timestamp(spark):
    assert dict((f.name, f.dataType.simpleString()) for f in RAW_SCHEMA.fields)["_loaded_at"] == "timestamp"
    assert isinstance(TS, dt.datetime)
