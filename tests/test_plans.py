"""Plan-shape checks for the scale properties (captured from DataFrame.explain)."""

import contextlib
import io

from quayside.operators.checks import stage
from quayside.operators.route import gold_rows, skip_already_loaded
from quayside.plans.gold_run import run_gold, stage_to_storage
from quayside.sinks.tables import read_gold
from quayside.sources.raw_table import raw_day, read_raw, read_raw_day

from helpers import DAY, land, raw_row

RUN_TS = "2024-03-11 07:00:00"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_numbering_is_an_aggregate_not_a_window(spark):
    _, raw = land(spark, [raw_row(order_id=None, row_hash="a"), raw_row(order_id=None, row_hash="b")])
    p = plan_of(stage(raw_day(raw, DAY), DAY))
    assert "Window" not in p
    assert "partial_min" in p
    assert "_load_date" in p and "PartitionFilters" in p
    assert "Window" in plan_of(stage(raw_day(raw, DAY), DAY, dedupe_method="window"))


def test_day_read_lists_only_the_day(spark):
    lake, _ = land(spark, [raw_row(row_hash="a")])
    p = plan_of(read_raw_day(spark, lake.raw, DAY))
    assert f"_load_date={DAY}" in p


def test_already_loaded_skip_prunes_gold_partitions(spark):
    lake, _ = land(spark, [raw_row(order_id="a", row_hash="ha"), raw_row(order_id="b", row_hash="hb")])
    run_gold(spark, lake, DAY, RUN_TS)
    st = stage_to_storage(spark, read_raw(spark, lake.raw), lake, DAY)
    p = plan_of(skip_already_loaded(gold_rows(st, RUN_TS), read_gold(spark, lake.gold)))
    gold_scan = [line for line in p.splitlines() if "PartitionFilters" in line and "order_date" in line]
    # One candidate date is planned as "order_date = d", several as IN / INSET.
    assert gold_scan and any(op in line for line in gold_scan for op in (" = ", " IN ", "INSET"))
