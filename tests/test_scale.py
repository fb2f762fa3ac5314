"""What keeps time, shuffle and memory in step with the input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, SF_SMALL, TS, land, raw_row
from quayside.operators import dedupe
from quayside.operators.dedupe import BITMAP_ROWS, mark_later_rows, with_row_ids
from quayside.operators.route import gold_rows
from quayside.plans.gold_run import stage_to_storage
from quayside.schema import GOLD_SCHEMA
from quayside.sinks.tables import pack_rows, unpack_rows
from quayside.sources.csv_files import file_table, read_lines, read_order_csvs, stage_lines
from quayside.session import hadoop_path, scratch_path, session_conf
from quayside.sinks.members import possible, summary
from quayside.sources.fixture import fixture_raw_orders


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _landing(spark, tmp_landing):
    for name, text in {"a.csv": "order_id,store_name\nO-1,A\n", "b.csv": "store_name,order_id,store_name\nx,O-2,B\nx,O-3,C\n"}.items():
        with open(f"{tmp_landing}/{name}", "w") as f:
            f.write(text)
    return tmp_landing


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_headers_are_found_without_a_shuffle_of_the_lines(spark, tmp_landing):
    folder = scratch_path(spark, "landing")
    staged = stage_lines(read_lines(spark, _landing(spark, tmp_landing)), f"{folder}/lines")
    files = file_table(staged, f"{folder}/places")
    assert "Exchange hashpartitioning" not in _plan(files)
    assert sorted(r.n_rows for r in files.collect()) == [1, 2]


def test_places_of_columns_are_told_per_file(spark, tmp_landing):
    batch = read_order_csvs(spark, _landing(spark, tmp_landing), "2024-03-10 07:00:00")
    rows = {r.order_id: r.store_name for r in batch.rows.collect()}
    assert rows == {"O-1": "A", "O-2": "B", "O-3": "C"}
    above_join = _plan(batch.rows).split("BroadcastHashJoin")[0]
    assert "array_position" not in above_join
    batch.close()


def test_landed_rows_are_not_shuffled_behind_the_joins(spark):
    plan = _plan(fixture_raw_orders(spark, SF_SMALL))
    above_join, below = plan.split("SortMergeJoin", 1)
    assert "Exchange" not in above_join
    assert "l_orderkey" in below.splitlines()[0]


def test_numbering_shuffles_no_rows_and_is_that_of_a_window(spark):
    path = scratch_path(spark, "rows")
    key = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") * 31 % 50_021).cast("string"))
    rows = spark.range(2 * BITMAP_ROWS + 500).select(key.alias("k"), (F.col("id") % 11).alias("t"), F.hash("id").alias("h"))
    rows.repartition(2, "h").write.parquet(path)
    df = with_row_ids(spark.read.parquet(path))
    marked = mark_later_rows(df, "k", ["t", "h"], "later")
    assert "Exchange hashpartitioning" not in _plan(marked)
    expected = mark_later_rows(df, "k", ["t", "h"], "later", method="window")
    assert marked.where(~F.col("later")).count() == rows.select("k").distinct().count()
    assert marked.exceptAll(expected).isEmpty() and expected.exceptAll(marked).isEmpty()


def test_a_days_rows_are_staged_without_a_second_copy(spark):
    lake, raw = land(spark, [raw_row(order_id=k, row_hash=f"{k}{i}") for i, k in enumerate("abca")])
    st = stage_to_storage(spark, raw, lake, DAY)
    assert sorted((r.order_id, r.duplicate_order_id) for r in st.collect()) == [("a", False), ("a", True), ("b", False), ("c", False)]
    assert all("/raw/orders/" in f for f in st.inputFiles() if "/first_rows/" not in f)
    plan = _plan(gold_rows(st, "2024-03-11 07:00:00"))
    assert "Exchange hashpartitioning" not in plan and "SortAggregate" not in plan
    fs, folders = hadoop_path(spark, f"{lake.staging}/run_date={DAY}/*/*")
    assert [f.getPath().getName() for f in fs.globStatus(folders)] == ["first_rows"]


def test_bitmaps_too_large_to_broadcast_leave_a_staged_copy(spark, monkeypatch):
    lake, raw = land(spark, [raw_row(order_id=k, row_hash=f"{k}{i}") for i, k in enumerate("abca")])
    monkeypatch.setattr(dedupe, "BROADCAST_BYTES", 0)
    st = stage_to_storage(spark, raw, lake, DAY)
    assert all("/_staging/" in f and "/rows/" in f for f in st.inputFiles())
    assert sorted((r.order_id, r.duplicate_order_id) for r in st.collect()) == [("a", False), ("a", True), ("b", False), ("c", False)]


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_rows_of_taken_keys_are_all_later_ones(spark, method):
    path = scratch_path(spark, "rows")
    spark.sql("select k, t from values ('a', 1), ('a', 2), (null, 1), (null, 2), ('b', 2), ('b', 1), ('c', 1) as v(k, t)").write.parquet(path)
    taken = spark.sql("select * from values ('a'), (cast(null as string)), ('x'), ('a') as v(key)")
    marked = mark_later_rows(with_row_ids(spark.read.parquet(path)), "k", ["t"], "later", method=method, taken=taken)
    assert sorted((r.k, r.t) for r in marked.where(~F.col("later")).collect()) == [("b", 1), ("c", 1)]
    assert marked.count() == 7


def test_gold_rows_come_back_from_their_packed_form(spark):
    hashes = ["0123456789abcdef" * 2, "ABCDEF", "abc", "", None, "h-1", "ab"]
    texts = ["plain", "", None, "a\x01b", "\x02", "é \x00", "x\x01"]
    rows = []
    for i, (h, t) in enumerate(zip(hashes, texts)):
        row = {f.name: None for f in GOLD_SCHEMA.fields}
        row |= {"order_id": f"O{i}", "customer_name": t, "category": texts[-i], "order_status": t, "_row_hash": h, "quantity": i, "revenue": i / 3}
        row |= {"order_date": dt.date(2024, 3, 1 + i), "_gold_created_at": TS}
        rows.append(tuple(row[c] for c in GOLD_SCHEMA.fieldNames()))
    df = spark.createDataFrame(rows, GOLD_SCHEMA)
    back = unpack_rows(pack_rows(df).repartition(3, "order_date"))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    packed = pack_rows(df).collect()
    assert [r["_code"] is not None for r in packed].count(True) == 3
    assert [r["_odd"] is None for r in packed].count(True) == sum(not {"\x01", "\x02"} & set("".join(v for v in r if isinstance(v, str))) for r in rows)


def test_valid_rows_are_filtered_in_compiled_code(spark):
    lake, raw = land(spark, [raw_row(order_id=k, row_hash=k) for k in "abc"])
    valid = gold_rows(stage_to_storage(spark, raw, lake, DAY), "2024-03-11 07:00:00").select("order_date", "_row_hash")
    assert len(valid.collect()) == 3  # the plan that ran, stages and all
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(valid._jdf.queryExecution().executedPlan())
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= 8000


@pytest.mark.parametrize("odd", [None, "", "!", "F" * 32, "3f", "3g" * 16, "a" * 33, "zz", "é" * 32])
def test_hashes_of_any_form_order_rows_as_texts_do(spark, odd):
    hexed = ["3e" * 16, "3f" * 16, "a" * 32]
    rows = [("O-1", 1, h) for h in [*hexed, odd]] + [("O-2", 1, odd), ("O-2", 0, hexed[2]), (None, 1, hexed[0])]
    df = spark.createDataFrame(rows, "k string, t int, _row_hash string").repartition(3)
    marked = mark_later_rows(with_row_ids(df), "k", ["t", "_row_hash"], "later").where(~F.col("later"))
    first = min([*hexed, odd], key=lambda h: (h is not None, (h or "").encode()))
    assert {tuple(r) for r in marked.select("k", "t", "_row_hash").collect()} == {
        ("O-1", 1, first), ("O-2", 0, hexed[2]), (None, 1, hexed[0])
    }


def test_numbering_shuffles_hashes_as_bytes(spark):
    df = spark.createDataFrame([("O-1", "ab" * 16)], "k string, _row_hash string")
    shuffled, below = _plan(dedupe.first_rows(df, "k", ["_row_hash"])).split("partial_min", 1)
    assert "Exchange" in shuffled and "unhex(_row_hash" in below and "unhex" not in shuffled


def test_rows_asked_of_the_summaries_are_shuffled_once_and_as_bytes(spark):
    day = dt.date(2024, 3, 9)
    rows = spark.createDataFrame([(day, h) for h in ("ab" * 16, "odd", "AB" * 16, None)], "order_date date, _row_hash string")
    path = scratch_path(spark, "members")
    summary(rows.where("_row_hash <> 'odd'")).write.parquet(path)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        hits = possible(rows, spark.read.parquet(path), [day])
        plan = _plan(hits)
        assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in plan and "unhex(_row_hash" in plan
        found = {(r.order_date, r._row_hash) for r in hits.collect()}
    assert {(day, "ab" * 16), (day, "AB" * 16)} <= found <= {(day, h) for h in ("ab" * 16, "AB" * 16, "odd")}
