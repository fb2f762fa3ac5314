"""Shuffle files, copies and repeated staging that large inputs have no room or time for."""

import datetime as dt
import re

from helpers import DAY, TS, land, raw_row
from quayside.plans import gold_run
from quayside.plans.gold_run import new_in_gold, run_gold, stage_to_storage
from quayside.schema import RAW_SCHEMA
from quayside.session import Lakehouse, scratch_path, session_conf
from quayside.sinks import tables
from quayside.sinks.members import possible, read_members, summary
from quayside.sinks.tables import compact_gold, gold_runs, read_commits, read_gold
from quayside.sources.raw_table import append_raw


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark) -> set[str]:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_writes_leave_no_shuffle_files(spark):
    rows = spark.createDataFrame([raw_row(order_id=str(i), row_hash=f"h{i}") for i in range(50)], RAW_SCHEMA)
    lake, before = Lakehouse.fresh(spark, "disk"), _shuffle_files(spark)
    append_raw(rows.repartition(3, "order_id"), lake.raw)
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    assert _shuffle_files(spark) <= before
    assert read_gold(spark, lake.gold).count() == 50


def test_a_runs_summary_is_that_of_its_valid_rows_and_read_from_gold(spark, monkeypatch):
    asked = []
    keep = gold_run.write_members
    monkeypatch.setattr(gold_run, "write_members", lambda rows, *a: (asked.append(rows.inputFiles()), keep(rows, *a))[1])
    rows = [raw_row(order_id=str(i), row_hash=f"h{i}", order_date=f"2024-03-0{i % 3 + 1}") for i in range(30)]
    lake, _ = land(spark, rows)
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    next_day = "2024-03-11"
    again = [raw_row(TS + dt.timedelta(days=1), "f2.csv", f"h{i}", order_id=str(i), order_date=f"2024-03-0{i % 3 + 1}") for i in range(20, 40)]
    land(spark, again, lake)
    run_gold(spark, lake, next_day, "2024-03-12 07:00:00")
    assert all("/raw/orders/" not in f for files in asked for f in files)
    runs = gold_runs(read_commits(spark, lake.gold))
    valid = spark.createDataFrame([(dt.date(2024, 3, i % 3 + 1), f"h{i}") for i in range(20, 40)], "order_date date, _row_hash string")
    assert sorted(read_members(spark, lake.gold, runs[1:]).collect()) == sorted(summary(valid).collect())
    assert read_gold(spark, lake.gold).count() == 40

    compacted = []
    monkeypatch.setattr(tables, "write_members", lambda rows, gold, run: (compacted.append((run, _plan(rows), rows.count())), keep(rows, gold, run))[1])
    compact_gold(spark, lake.gold)
    ((run, plan, n),) = compacted
    assert run in plan
    assert n == 40


def test_rows_known_to_gold_are_left_out_without_a_shuffle(spark):
    lake, _ = land(spark, [raw_row(order_id=str(i), row_hash=f"{i:032x}") for i in range(30)])
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    later = TS + dt.timedelta(days=1)
    again = [raw_row(later, "f2.csv", f"{i:032x}", order_id=str(i)) for i in range(20, 40)] + [raw_row(later, "f2.csv", None, order_id="n")]
    _, raw = land(spark, again, lake)
    st = stage_to_storage(spark, raw, lake, "2024-03-11")
    runs = gold_runs(read_commits(spark, lake.gold))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        new = new_in_gold(spark, st, lake, runs, [dt.date(2024, 3, 1)], "2024-03-12 07:00:00", scratch_path(spark, "hits"))
        assert "Exchange hashpartitioning" not in _plan(new)
        assert sorted(r.order_id for r in new.collect()) == sorted([*map(str, range(30, 40)), "n"])


def test_a_row_in_several_runs_of_one_level_is_one_hit(spark):
    day = dt.date(2024, 3, 9)
    rows = spark.createDataFrame([(day, f"{i:032x}", i) for i in range(10)], "order_date date, _row_hash string, id int")
    path = scratch_path(spark, "members")
    summary(rows).unionByName(summary(rows)).write.parquet(path)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        hits = possible(rows, spark.read.parquet(path), [day], ["id"])
        moved = re.findall(r"hashpartitioning\((.*?)\)", _plan(hits))
        assert sorted(r.id for r in hits.collect()) == list(range(10))
    assert sum("block" in by for by in moved) == 2  # the two sides of the one join
    assert not any("_row_hash" in by for by in moved)
