"""The daily run through real writes: idempotence, crash recovery, log, reports, stream."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quayside.operators import reports
from quayside.plans.gold_run import run_gold, stage_to_storage
from quayside.operators.route import gold_rows, quarantine_rows, skip_already_loaded
from quayside.schema import RAW_SCHEMA
from quayside.session import Lakehouse, hadoop_path, local_path, scratch_path
from quayside.sinks.tables import read_check_log, read_gold, read_quarantine, write_gold
from quayside.sources.raw_table import append_raw, read_raw
from quayside.streaming.ingest_stream import start_ingest_stream

from helpers import DAY, TS, land, raw_row

RUN_TS = "2024-03-11 07:00:00"


def day_rows():
    return [
        raw_row(order_id="a", row_hash="ha"),
        raw_row(order_id="b", row_hash="hb"),
        raw_row(order_id="b", loaded_at=TS + dt.timedelta(hours=1), row_hash="hb2"),  # duplicate
        raw_row(order_id="c", store_name=None, row_hash="hc"),  # missing store
        raw_row(order_id="d", order_date="2024-04-01", ship_date="2024-04-02", row_hash="hd"),  # future
    ]


def snapshot(spark, lake):
    g = sorted((r["order_id"], r["_row_hash"]) for r in read_gold(spark, lake.gold).collect())
    q = sorted((r["_row_hash"], r["_failure_reason"]) for r in read_quarantine(spark, lake.quarantine).collect())
    log = sorted(tuple(r) for r in read_check_log(spark, lake.check_log).drop("checked_at").collect())
    return g, q, log


def test_run_and_rerun_is_idempotent(spark):
    lake, _ = land(spark, day_rows())
    res = run_gold(spark, lake, DAY, RUN_TS)
    assert (res.staged_rows, res.gold_appended, res.quarantined) == (5, 2, 3)
    first = snapshot(spark, lake)
    assert first[0] == [("a", "ha"), ("b", "hb")]
    assert [r[1] for r in first[1]] == ["DUPLICATE_ORDER_ID", "MISSING_STORE_NAME", "FUTURE_ORDER_DATE"]
    run_gold(spark, lake, DAY, "2024-03-12 07:00:00")
    assert snapshot(spark, lake) == first


def test_check_log_values(spark):
    lake, _ = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    log = {r["check_name"]: r for r in read_check_log(spark, lake.check_log).collect()}
    assert log["no_duplicate_order_ids"]["failing_rows"] == 1
    assert log["no_duplicate_order_ids"]["status"] == "FAIL"
    assert log["no_duplicate_order_ids"]["pct_failed"] == 20.0
    assert log["ship_date_after_order_date"]["status"] == "PASS"
    assert log["no_future_order_dates"]["failing_rows"] == 1
    rec = log["gold_vs_raw_row_count_check"]
    assert (rec["total_rows"], rec["failing_rows"], rec["pct_failed"], rec["status"]) == (5, 3, 60.0, "FAIL")
    assert all(r["run_date"] == dt.date.fromisoformat(DAY) for r in log.values())
    assert all(str(r["checked_at"]) == RUN_TS for r in log.values())


def test_crash_after_gold_write_then_rerun(spark):
    # Simulate a run that appended gold and died before quarantine, log and commit: nobody sees it.
    lake, raw = land(spark, day_rows())
    st = stage_to_storage(spark, raw, lake, DAY)
    write_gold(skip_already_loaded(gold_rows(st, RUN_TS), read_gold(spark, lake.gold)), lake.gold, "broken")
    assert read_gold(spark, lake.gold) is None
    run_gold(spark, lake, DAY, RUN_TS)
    lake2, _ = land(spark, day_rows())
    run_gold(spark, lake2, DAY, RUN_TS)
    assert snapshot(spark, lake) == snapshot(spark, lake2)


def test_backfill_two_days_and_history(spark):
    rows = day_rows() + [raw_row(order_id="p", loaded_at=TS - dt.timedelta(days=1), row_hash="hp")]
    lake, _ = land(spark, rows)
    run_gold(spark, lake, DAY, RUN_TS)
    run_gold(spark, lake, "2024-03-09", "2024-03-11 08:00:00")  # back-fill the earlier day afterwards
    hist = reports.check_log_history(read_check_log(spark, lake.check_log)).collect()
    assert [r["run_date"].isoformat() for r in hist][:1] == [DAY]
    assert len(hist) == 12
    assert sorted(r["order_id"] for r in read_gold(spark, lake.gold).collect()) == ["a", "b", "p"]


def test_relanded_rows_are_not_inserted_twice(spark):
    lake, _ = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    # The same rows land again the next day under a new file name.
    again = [raw_row(order_id="a", loaded_at=TS + dt.timedelta(days=1), source="re.csv", row_hash="ha")]
    append_raw(spark.createDataFrame(again, read_raw(spark, lake.raw).drop("_load_date", "_batch").schema), lake.raw)
    res = run_gold(spark, lake, "2024-03-11", "2024-03-12 07:00:00")
    assert res.gold_appended == 0 and res.staged_rows == 1
    assert read_gold(spark, lake.gold).count() == 2


def test_reports(spark):
    lake, _ = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    g, q = read_gold(spark, lake.gold), read_quarantine(spark, lake.quarantine)
    dest = {r["destination"]: r["row_count"] for r in reports.destination_counts(g, q).collect()}
    assert dest == {"gold": 2, "quarantine": 3}
    by_reason = reports.quarantine_by_reason(q).collect()
    assert sum(r["rejected_rows"] for r in by_reason) == 3
    assert [tuple(r) for r in reports.orders_by_store(g).collect()] == [("Lakeside Outlet", 2)]
    assert [tuple(r) for r in reports.orders_by_product(g).collect()] == [("Patio Chair", 2)]
    prof = reports.raw_profile(read_raw(spark, lake.raw), DAY).first()
    assert prof["total_rows"] == 5 and prof["duplicate_order_ids"] == 1 and prof["future_order_dates"] == 1
    assert prof["missing_store_name"] == 1 and prof["n_columns"] == 16


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_stream_takes_each_file_once_and_replay_is_idempotent(spark):
    landing = scratch_path(spark, "t-landing")
    lake = Lakehouse.fresh(spark, "t-lake")
    ckpt = scratch_path(spark, "t-ckpt")
    local = local_path(landing)
    _write(local, "one.csv", "order_id,order_date,store_name\n1,2024-03-01,Lakeside\n2,2024-03-01,Lakeside\n")
    _write(local, "skip.txt", "order_id\n9\n")
    q = start_ingest_stream(spark, landing, lake, ckpt, loaded_at=lambda b: "2024-03-10 07:00:00")
    q.awaitTermination()
    _write(local, "two.csv", "store_name,order_id\nPrairie Home,3\n")
    q = start_ingest_stream(spark, landing, lake, ckpt, loaded_at=lambda b: "2024-03-10 08:00:00")
    q.awaitTermination()
    raw = read_raw(spark, lake.raw)
    assert sorted(r["order_id"] for r in raw.collect()) == ["1", "2", "3"]
    assert raw.select("_batch").distinct().count() == 2
    # Replaying a batch id rewrites that batch instead of adding rows.
    first = min(r[0] for r in raw.select("_batch").distinct().collect())
    append_raw(raw.where(F.col("_batch") == first).drop("_load_date", "_batch"), lake.raw, batch_id=first)
    assert read_raw(spark, lake.raw).count() == 3


def test_stream_runs_gold_for_landed_day(spark):
    landing = scratch_path(spark, "t-landing")
    lake = Lakehouse.fresh(spark, "t-lake")
    ckpt = scratch_path(spark, "t-ckpt")
    _write(local_path(landing), "one.csv",
           "order_id,order_date,ship_date,store_name,quantity,revenue\n1,2024-03-01,2024-03-02,Lakeside,1,5\n"
           "1,2024-03-01,2024-03-02,Lakeside,1,5\n")
    start_ingest_stream(spark, landing, lake, ckpt, loaded_at=lambda b: "2024-03-10 07:00:00",
                        run_gold_after=True, run_ts=lambda b, d: RUN_TS).awaitTermination()
    assert read_gold(spark, lake.gold).count() == 1
    assert read_quarantine(spark, lake.quarantine).count() == 1
    assert read_check_log(spark, lake.check_log).count() == 6


def test_sql_views_match_dataframe_reports(spark):
    from quayside.plans.views import REPORT_SQL, register_views, report

    lake, _ = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    t = register_views(spark, lake)
    expected = {
        "destination_counts": reports.destination_counts(t["gold"], t["quarantine"]),
        "quarantine_by_reason": reports.quarantine_by_reason(t["quarantine"]),
        "check_log_history": reports.check_log_history(t["check_log"]),
        "orders_by_store": reports.orders_by_store(t["gold"]),
        "orders_by_product": reports.orders_by_product(t["gold"]),
        "raw_landing_count": reports.raw_landing_count(t["raw"]),
    }
    for name in REPORT_SQL:
        got = [tuple(r) for r in report(spark, name).collect()]
        want = [tuple(r) for r in expected[name].collect()]
        assert got == want, name


def test_reason_text_counts_agree_with_check_log(spark):
    from quayside.schema import LOGGED_CHECKS, REASON_CODES

    lake, _ = land(spark, day_rows() + [raw_row(order_id=None, store_name=" ", row_hash="hz")])
    run_gold(spark, lake, DAY, RUN_TS)
    by_code = reports.rejects_by_code(read_quarantine(spark, lake.quarantine)).first().asDict()
    code_of = dict(REASON_CODES)
    log = {r["check_name"]: r["failing_rows"] for r in read_check_log(spark, lake.check_log).collect()}
    for name, flag in LOGGED_CHECKS:
        assert log[name] == by_code[code_of[flag].lower()], name
    assert by_code["missing_order_id"] == 1


def test_a_rerun_without_rejects_empties_the_days_quarantine(spark):
    from quayside.sinks.tables import read_quarantine
    from quayside.sources.raw_table import append_raw

    lake = Lakehouse.fresh(spark, "test-lake")
    append_raw(spark.createDataFrame([raw_row(order_date="junk")], RAW_SCHEMA), lake.raw, "b1")
    assert run_gold(spark, lake, DAY, "2024-03-11 07:00:00").quarantined == 1
    append_raw(spark.createDataFrame([raw_row()], RAW_SCHEMA), lake.raw, "b1")
    again = run_gold(spark, lake, DAY, "2024-03-11 08:00:00")
    assert (again.quarantined, again.gold_appended) == (0, 1)
    assert read_quarantine(spark, lake.quarantine).count() == 0


def test_a_late_file_does_not_unseat_a_row_in_gold(spark):
    lake = Lakehouse.fresh(spark, "test-lake")
    append_raw(spark.createDataFrame([raw_row(order_id="A", row_hash="h1")], RAW_SCHEMA), lake.raw, "b1")
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    late = [
        raw_row(order_id="A", revenue="99.00", loaded_at=TS - dt.timedelta(hours=2), source="late.csv", row_hash="h0"),
        raw_row(order_id="B", loaded_at=TS - dt.timedelta(hours=2), source="late.csv", row_hash="hb"),
    ]
    append_raw(spark.createDataFrame(late, RAW_SCHEMA), lake.raw, "b2")
    for hour in (8, 9):
        run_gold(spark, lake, DAY, f"2024-03-11 {hour:02}:00:00")
        g, q, _ = snapshot(spark, lake)
        assert g == [("A", "h1"), ("B", "hb")]
        assert q == [("h0", "DUPLICATE_ORDER_ID")]
    fs, staging = hadoop_path(spark, f"{lake.staging}/run_date={DAY}")
    assert len(fs.listStatus(staging)) == 0


def test_a_replayed_batch_keeps_its_load_time(spark):
    from quayside.plans.ingest import ingest_csv

    landing, lake = scratch_path(spark, "t-landing"), Lakehouse.fresh(spark, "t-lake")
    _write(local_path(landing), "one.csv", "order_id\n1\n")
    ingest_csv(spark, landing, lake.raw, batch_id="b1")
    first = read_raw(spark, lake.raw).collect()
    ingest_csv(spark, landing, lake.raw, batch_id="b1")
    assert read_raw(spark, lake.raw).collect() == first


def test_a_batch_id_used_again_replaces_other_load_days_and_may_be_empty(spark):
    import datetime as dt

    from quayside.sources.raw_table import append_raw, read_raw

    lake = Lakehouse.fresh(spark, "test-lake")
    append_raw(spark.createDataFrame([raw_row()], RAW_SCHEMA), lake.raw, "b1")
    append_raw(spark.createDataFrame([raw_row()], RAW_SCHEMA), lake.raw, "b2")
    append_raw(spark.createDataFrame([raw_row(loaded_at=TS + dt.timedelta(days=3))], RAW_SCHEMA), lake.raw, "b1")
    assert sorted(r["_batch"] for r in read_raw(spark, lake.raw).collect()) == ["b1", "b2"]
    append_raw(spark.createDataFrame([], RAW_SCHEMA), lake.raw, "b1")
    assert [r["_batch"] for r in read_raw(spark, lake.raw).collect()] == ["b2"]


def test_a_run_without_commit_is_never_seen(spark):
    from quayside.sinks.tables import drop_uncounted, write_check_log, write_quarantine

    lake, raw = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    before = snapshot(spark, lake)
    st = stage_to_storage(spark, raw, lake, DAY)
    day = dt.date.fromisoformat(DAY)
    write_quarantine(quarantine_rows(st, RUN_TS, DAY).limit(1), lake.quarantine, day, "broken")
    write_gold(gold_rows(st, RUN_TS), lake.gold, "broken")
    write_check_log(read_check_log(spark, lake.check_log).limit(1), lake.check_log, day, "broken")
    assert snapshot(spark, lake) == before
    run_gold(spark, lake, DAY, "2024-03-11 09:00:00")
    assert snapshot(spark, lake) == before
    fs, folder = hadoop_path(spark, f"{lake.gold}/order_date=*/_run=broken")
    assert len(fs.globStatus(folder)) > 0
    drop_uncounted(spark, lake.gold)
    assert len(fs.globStatus(folder)) == 0 and snapshot(spark, lake) == before


def test_an_unchanged_day_reads_and_writes_no_gold(spark, monkeypatch):
    from quayside.plans import gold_run

    lake, _ = land(spark, day_rows())
    run_gold(spark, lake, DAY, RUN_TS)
    before = snapshot(spark, lake)
    with monkeypatch.context() as m:
        for name in ("read_gold", "write_gold", "read_raw"):
            m.setattr(gold_run, name, None)  # not even called: the counts are kept beside the tables
        assert run_gold(spark, lake, DAY, "2024-03-11 08:00:00").gold_appended == 0
    assert snapshot(spark, lake) == before
    append_raw(spark.createDataFrame([raw_row(order_id="new", row_hash="hn")], RAW_SCHEMA), lake.raw)
    assert run_gold(spark, lake, DAY, "2024-03-11 09:00:00").gold_appended == 1


def test_counts_kept_equal_counts_taken(spark):
    lake, _ = land(spark, day_rows())
    append_raw(spark.createDataFrame([raw_row(order_id="x", row_hash="hx", loaded_at=TS - dt.timedelta(days=1))], RAW_SCHEMA), lake.raw, "b")
    append_raw(spark.createDataFrame([], RAW_SCHEMA), lake.raw, "b")  # the batch is replaced by nothing
    logs = []
    for recount in (False, True, False):
        run_gold(spark, lake, DAY, RUN_TS, recount=recount)
        logs.append(sorted(tuple(r) for r in read_check_log(spark, lake.check_log).collect()))
    assert logs[0] == logs[1] == logs[2]


def test_compaction_swaps_runs_and_keeps_rows(spark):
    from quayside.sinks.tables import compact_gold

    rows = day_rows() + [raw_row(order_id="p", loaded_at=TS - dt.timedelta(days=1), row_hash="hp")]
    lake, _ = land(spark, rows)
    run_gold(spark, lake, "2024-03-09", RUN_TS)
    run_gold(spark, lake, DAY, RUN_TS)
    before = snapshot(spark, lake)
    old = read_gold(spark, lake.gold)
    assert len(old.inputFiles()) > 1
    assert compact_gold(spark, lake.gold) == 2 and compact_gold(spark, lake.gold) == 0
    assert snapshot(spark, lake) == before
    assert len(read_gold(spark, lake.gold).inputFiles()) == read_gold(spark, lake.gold).select("order_date").distinct().count()
    # A day run again after a compaction finds its rows there; new ones join them.
    append_raw(spark.createDataFrame([raw_row(order_id="new", row_hash="hn")], RAW_SCHEMA), lake.raw)
    run_gold(spark, lake, DAY, RUN_TS)
    assert read_gold(spark, lake.gold).count() == len(before[0]) + 1
    log = read_check_log(spark, lake.check_log).where("check_name = 'gold_vs_raw_row_count_check'")
    (rec,) = log.where(F.col("run_date") == F.lit(dt.date.fromisoformat(DAY))).collect()
    assert rec["total_rows"] == read_raw(spark, lake.raw).count() and rec["failing_rows"] == 7 - 4
