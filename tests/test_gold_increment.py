"""Runs extended by new batches against runs over the whole day; re-uploads within and beyond the stream's horizon."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.checks import stage
from quayside.plans import gold_increment
from quayside.plans.gold_increment import extend_gold, stage_increment
from quayside.plans.gold_run import run_gold
from quayside.schema import RAW_SCHEMA
from quayside.session import Lakehouse, scratch_path
from quayside.sinks.tables import day_runs, read_check_log, read_commits, read_gold, read_quarantine
from quayside.sources.raw_table import append_raw
from quayside.streaming.unique_rows import start_unique_stream

from helpers import DAY, TS, raw_row

RUN_TS = "2024-03-11 07:00:00"
DATE = dt.date.fromisoformat(DAY)


def land_batch(spark, lake, rows, batch):
    append_raw(spark.createDataFrame(rows, RAW_SCHEMA), lake.raw, batch)


def tables(spark, lake):
    gold = sorted((r["order_id"], r["_row_hash"]) for r in read_gold(spark, lake.gold).collect())
    bad = sorted((r["_row_hash"], r["_failure_reason"]) for r in read_quarantine(spark, lake.quarantine).collect())
    return gold, bad, sorted(tuple(r) for r in read_check_log(spark, lake.check_log).collect())


def random_batches(seed, n_batches=4, n=30):
    rnd = random.Random(seed)
    ids = [None, "", " ", *[f"o{k}" for k in range(25)]]
    return [
        [
            raw_row(
                loaded_at=TS + dt.timedelta(minutes=b), source=f"f{b}.csv", row_hash=f"h{b}-{k}", order_id=rnd.choice(ids),
                store_name=rnd.choice(["Lakeside", None]), order_date=rnd.choice(["2024-03-01", "x", None, "2024-05-01"]),
            )
            for k in range(n)
        ]
        for b in range(n_batches)
    ]


def extended(spark, monkeypatch, batches, **kw):
    """(tables, whole runs made) of extending the day batch by batch."""
    whole = []
    monkeypatch.setattr(gold_increment, "run_gold", lambda *a, **k: (whole.append(a[2]), run_gold(*a, **k))[1])
    lake = Lakehouse.fresh(spark, "increments")
    for b, rows in enumerate(batches):
        land_batch(spark, lake, rows, f"b{b}")
        extend_gold(spark, lake, DAY, RUN_TS, [f"b{b}"], **kw)
    return lake, len(whole)


def at_once(spark, batches, **kw):
    lake = Lakehouse.fresh(spark, "whole")
    for b, rows in enumerate(batches):
        land_batch(spark, lake, rows, f"b{b}")
    run_gold(spark, lake, DAY, RUN_TS, **kw)
    return lake


def test_batches_end_as_one_run(spark, monkeypatch):
    batches = random_batches(1)
    lake, whole = extended(spark, monkeypatch, batches, all_eight=True)
    assert whole == 1  # the first batch; the others only staged their own rows
    assert [bool(c.extends) for c in day_runs(read_commits(spark, lake.gold), DATE)] == [False, True, True, True]
    assert tables(spark, lake) == tables(spark, at_once(spark, batches, all_eight=True))


def test_a_whole_run_after_increments_changes_nothing(spark, monkeypatch):
    lake, _ = extended(spark, monkeypatch, random_batches(2, 3))
    before = tables(spark, lake)
    run_gold(spark, lake, DAY, RUN_TS)
    assert tables(spark, lake) == before
    assert len(day_runs(read_commits(spark, lake.gold), DATE)) == 1


def test_earlier_row_of_a_known_id_runs_the_whole_day(spark, monkeypatch):
    first = [raw_row(order_id="a", row_hash="a1", store_name=None), raw_row(order_id="b", row_hash="b1")]
    early = TS - dt.timedelta(hours=1)
    second = [raw_row(early, "f0.csv", "a0", order_id="a"), raw_row(early, "f0.csv", "b0", order_id="b")]
    lake, whole = extended(spark, monkeypatch, [first, second])
    assert whole == 2
    gold, bad, _ = tables(spark, lake)
    assert gold == [("a", "a0"), ("b", "b1")]  # a row that is in gold keeps its place
    assert [h for h, _ in bad] == ["a1", "b0"] and all("DUPLICATE_ORDER_ID" in r for _, r in bad)


def test_replayed_batch_other_changes_and_empty_batches(spark, monkeypatch):
    batches = random_batches(3, 2)
    lake, whole = extended(spark, monkeypatch, batches)
    land_batch(spark, lake, batches[1], "b1")  # a replay of the landed batch
    extend_gold(spark, lake, DAY, RUN_TS, ["b1"])
    assert tables(spark, lake) == tables(spark, at_once(spark, batches))
    extra = random_batches(4, 4)[2:]
    land_batch(spark, lake, extra[0], "unnamed")
    land_batch(spark, lake, extra[1], "named")
    extend_gold(spark, lake, DAY, RUN_TS, ["named"])  # a batch that nobody named is not lost
    assert tables(spark, lake) == tables(spark, at_once(spark, batches + extra))
    assert extend_gold(spark, lake, DAY, RUN_TS, ["nothing landed"]).staged_rows == 0
    assert tables(spark, lake) == tables(spark, at_once(spark, batches + extra))


def test_long_chains_are_run_whole(spark, monkeypatch):
    monkeypatch.setattr(gold_increment, "MAX_CHAIN", 2)
    batches = random_batches(5, 4, 8)
    lake, whole = extended(spark, monkeypatch, batches)
    assert whole == 2
    assert tables(spark, lake) == tables(spark, at_once(spark, batches))


@pytest.mark.parametrize("rows", [[], [raw_row(order_id=None, row_hash=None)]])
def test_increment_of_no_rows_and_of_null_ids(spark, rows):
    new = spark.createDataFrame(rows, RAW_SCHEMA)
    none = spark.createDataFrame([], "key string, settled boolean")
    got = stage_increment(new, DAY, none).select("order_id", "failure_reasons").collect()
    assert got == stage(new, DAY).select("order_id", "failure_reasons").collect()
    null = spark.createDataFrame([(None, True)], "key string, settled boolean")
    assert all(r["duplicate_order_id"] for r in stage_increment(new, DAY, null).collect())


def test_stream_state_is_bounded_by_the_horizon(spark):
    lake, out, ckpt = Lakehouse.fresh(spark, "unique"), scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    rows = []
    for k, day in enumerate((0, 1, 10, 11, 12)):
        file = "x" if k in (0, 1, 4) else f"y{k}"
        at = TS + dt.timedelta(days=day)
        land_batch(spark, lake, [raw_row(at, f"u{k}.csv", f"{file}{i}") for i in range(50)] + [raw_row(at, "n.csv", f"{file}0")], f"u{k}")
        q = start_unique_stream(spark, lake.raw, out, ckpt, dt.timedelta(days=2))
        q.awaitTermination()
        rows.append(max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators))
    kept = {(r["_loaded_at"], r["n"]) for r in spark.read.parquet(out).groupBy("_loaded_at").agg(F.count("*").alias("n")).collect()}
    assert kept == {(TS + dt.timedelta(days=d), 50) for d in (0, 10, 11, 12)}  # day 1: within the horizon of day 0
    assert max(rows) <= 150 and spark.read.parquet(out).count() == 200
