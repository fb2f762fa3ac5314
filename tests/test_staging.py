"""Casts, numbering and the eight row checks (FIXTURES.md section 5)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from quayside.functions.text import initcap_words, normalise_store, ws_trim
from quayside.operators.checks import stage
from quayside.operators.route import gold_rows, quarantine_rows
from quayside.sources.raw_table import raw_day

from helpers import DAY, TS, land, raw_row

RUN_TS = "2024-03-11 07:00:00"


def staged_rows(spark, rows, method="aggregate"):
    _, raw = land(spark, rows)
    st = stage(raw_day(raw, DAY), DAY, method)
    return st, {r["_row_hash"]: r.asDict() for r in st.collect()}


def test_date_shapes(spark):
    cases = {"2025-02-30": None, "2024-1-5": dt.date(2024, 1, 5), "2024-01-05 10:00": None, "24-01-05": None,
             " 2024-01-05\t": dt.date(2024, 1, 5), "12024-01-05": None, "2025-99-99": None}
    rows = [raw_row(order_id=f"d{i}", order_date=v, row_hash=f"d{i}") for i, v in enumerate(cases)]
    _, out = staged_rows(spark, rows)
    for i, (v, want) in enumerate(cases.items()):
        assert out[f"d{i}"]["order_date_cast"] == want, v


def test_number_shapes(spark):
    qty = {"3.0": None, " 12 ": 12, "1e3": None, "9223372036854775808": None, "+5": 5, "abc": None}
    rev = {"1d": None, "NaN": "nan", "-5": -5.0, "1e3": 1000.0, " 7.5 ": 7.5, ".5": 0.5}
    rows = [raw_row(order_id=f"q{i}", quantity=v, row_hash=f"q{i}") for i, v in enumerate(qty)]
    rows += [raw_row(order_id=f"r{i}", revenue=v, row_hash=f"r{i}") for i, v in enumerate(rev)]
    _, out = staged_rows(spark, rows)
    for i, (v, want) in enumerate(qty.items()):
        assert out[f"q{i}"]["quantity_cast"] == want, v
    for i, (v, want) in enumerate(rev.items()):
        got = out[f"r{i}"]["revenue_cast"]
        assert (math.isnan(got) if want == "nan" else got == want), v


def test_revenue_checks_and_abs_path(spark):
    rows = [
        raw_row(order_id="neg-qty0", quantity="0", revenue="-5", row_hash="a"),
        raw_row(order_id="neg-qty2", quantity="2", revenue="-5", row_hash="b"),
        raw_row(order_id="nan", quantity="2", revenue="NaN", row_hash="c"),
        raw_row(order_id="zero", quantity="2", revenue="0.00", row_hash="d"),
    ]
    st, out = staged_rows(spark, rows)
    assert out["a"]["is_valid"] and not out["a"]["zero_revenue_with_qty"]
    assert out["b"]["failure_reasons"] == "ZERO_REVENUE_WITH_QTY"
    assert out["c"]["is_valid"]  # NaN <= 0 is false
    assert out["d"]["failure_reasons"] == "ZERO_REVENUE_WITH_QTY"
    gold = {r["order_id"]: r for r in gold_rows(st, RUN_TS).collect()}
    assert gold["neg-qty0"]["revenue"] == 5.0


def test_ids_blank_null_and_trim_collision(spark):
    rows = [
        raw_row(order_id="A", row_hash="a1"),
        raw_row(order_id="A ", row_hash="a2"),
        raw_row(order_id=None, row_hash="n1"),
        raw_row(order_id=None, row_hash="n2"),
        raw_row(order_id="  ", row_hash="s1"),
    ]
    st, out = staged_rows(spark, rows)
    assert out["a1"]["is_valid"] and out["a2"]["is_valid"]
    assert out["n1"]["failure_reasons"] == "MISSING_ORDER_ID"
    assert out["n2"]["failure_reasons"] == "MISSING_ORDER_ID, DUPLICATE_ORDER_ID"
    assert out["s1"]["failure_reasons"] == "MISSING_ORDER_ID"
    assert sorted(r["order_id"] for r in gold_rows(st, RUN_TS).collect()) == ["A", "A"]


def test_invalid_first_copy_blocks_valid_second(spark):
    rows = [
        raw_row(order_id="X", order_date="bad", loaded_at=TS, row_hash="x1"),
        raw_row(order_id="X", loaded_at=TS + dt.timedelta(hours=1), row_hash="x2"),
    ]
    st, out = staged_rows(spark, rows)
    assert out["x1"]["failure_reasons"] == "INVALID_ORDER_DATE"
    assert out["x2"]["failure_reasons"] == "DUPLICATE_ORDER_ID"
    assert gold_rows(st, RUN_TS).count() == 0


def test_byte_identical_rows_one_first(spark):
    rows = [raw_row(order_id="Z", row_hash="same")] * 3
    st, _ = staged_rows(spark, rows)
    flags = sorted(r["duplicate_order_id"] for r in st.collect())
    assert flags == [False, True, True]


def test_all_reasons_in_order_and_quarantine_text(spark):
    rows = [raw_row(order_id=None, order_date=" ", ship_date="2024-01-01", store_name="\t", row_hash="all")]
    st, out = staged_rows(spark, rows)
    assert out["all"]["failure_reasons"] == "MISSING_ORDER_ID, INVALID_ORDER_DATE, MISSING_STORE_NAME, MISSING_ORDER_DATE_STRING"
    (q,) = quarantine_rows(st, RUN_TS, DAY).collect()
    assert q["_failure_reason"] == out["all"]["failure_reasons"]
    assert q["order_date"] == " " and q["store_name"] == "\t"
    assert q["_quarantine_date"] == dt.date.fromisoformat(DAY)


def test_future_and_ship_before(spark):
    rows = [
        raw_row(order_id="f", order_date="2024-03-11", ship_date="2024-03-12", row_hash="f"),
        raw_row(order_id="t", order_date="2024-03-10", ship_date="2024-03-12", row_hash="t"),
        raw_row(order_id="s", order_date="2024-03-05", ship_date="2024-03-04", row_hash="s"),
    ]
    _, out = staged_rows(spark, rows)
    assert out["f"]["failure_reasons"] == "FUTURE_ORDER_DATE"
    assert out["t"]["is_valid"]  # the run day itself is not in the future
    assert out["s"]["failure_reasons"] == "SHIP_BEFORE_ORDER_DATE"


def test_gold_cleaning(spark):
    rows = [
        raw_row(order_id=" g1 ", customer_email="  ", discount_pct=None, product_name="  BBQ grill-pro ",
                store_name="\tgarden grove\t", customer_name=" Jane ", row_hash="g1"),
        raw_row(order_id="g2", store_name="corner shop", product_name="PatioChair", row_hash="g2"),
    ]
    st, _ = staged_rows(spark, rows)
    g = {r["order_id"]: r for r in gold_rows(st, RUN_TS).collect()}
    assert set(g) == {"g1", "g2"}
    assert g["g1"]["customer_email"] is None and g["g1"]["discount_pct"] == 0.0
    assert g["g1"]["product_name"] == "Bbq Grill-Pro"
    assert g["g1"]["store_name"] == "Garden Grove Store"
    assert g["g1"]["customer_name"] == "Jane"
    assert g["g2"]["store_name"] == "Corner Shop" and g["g2"]["product_name"] == "Patiochair"
    assert str(g["g2"]["_gold_created_at"]) == RUN_TS


def _py_initcap(s, delims):
    out, prev = [], None
    for i, ch in enumerate(s.lower()):
        out.append(ch.upper() if i == 0 or prev in delims else ch)
        prev = ch
    return "".join(out)


def test_initcap_and_trim_functions(spark):
    from quayside.functions.text import INITCAP_PUNCTUATION, WHITESPACE

    values = ["patio chair", "BBQ grill Pro", "o'neil x(y)z", "a  b", "\tab", "x_y.z", "fire-pit/deck", "", "ÉCOLE été"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(initcap_words("s")).collect()]
    assert got == [_py_initcap(v, set(INITCAP_PUNCTUATION + WHITESPACE)) for v in values]
    ws = spark.createDataFrame([("　\t x \n ",)], "s string").select(ws_trim("s")).first()[0]
    assert ws == "x"
    store = spark.createDataFrame([(" PACIFIC coast ",), ("Mountain View",), (None,)], "s string")
    assert [r[0] for r in store.select(normalise_store("s")).collect()] == ["Pacific Coast Store", "Mountain View Store", None]


def test_aggregate_and_window_numbering_agree_on_hot_keys(spark):
    # A hot NULL id, a hot real id and byte-identical copies: both methods must agree.
    rows = []
    for i in range(300):
        rows.append(raw_row(order_id=None, source=f"f{i % 3}.csv", row_hash=f"n{i % 50}",
                            loaded_at=TS + dt.timedelta(minutes=i % 7)))
        rows.append(raw_row(order_id="HOT", source=f"f{i % 2}.csv", row_hash=f"h{i % 40}",
                            loaded_at=TS + dt.timedelta(minutes=i % 5)))
        rows.append(raw_row(order_id=f"u{i}", row_hash=f"u{i}"))
    _, raw = land(spark, rows)
    day = raw_day(raw, DAY)
    a = stage(day, DAY, "aggregate")
    w = stage(day, DAY, "window")
    key = ["_rid_file", "_rid_row"]
    diff = a.select(*key, "duplicate_order_id").exceptAll(w.select(*key, "duplicate_order_id"))
    assert diff.count() == 0
    counts = {r["order_id"]: r["n"] for r in a.where(~F.col("duplicate_order_id")).groupBy("order_id").agg(F.count("*").alias("n")).collect()}
    assert counts[None] == 1 and counts["HOT"] == 1 and counts["u7"] == 1


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_first_row_is_earliest(spark, method):
    rows = [
        raw_row(order_id="K", loaded_at=TS + dt.timedelta(hours=2), source="b.csv", row_hash="late"),
        raw_row(order_id="K", loaded_at=TS, source="z.csv", row_hash="early"),
        raw_row(order_id="K", loaded_at=TS, source="a.csv", row_hash="earliest-file"),
    ]
    _, out = staged_rows(spark, rows, method)
    assert not out["earliest-file"]["duplicate_order_id"]
    assert out["early"]["duplicate_order_id"] and out["late"]["duplicate_order_id"]
