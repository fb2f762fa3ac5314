"""Membership summaries of gold: no member is missed, few others hit, few folders are listed."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.plans import gold_run
from quayside.plans.gold_run import run_gold
from quayside.schema import RAW_SCHEMA
from quayside.sinks import members
from quayside.sinks.tables import compact_gold, gold_runs, read_commits, read_gold
from quayside.sources.raw_table import append_raw

from helpers import DAY, TS, land, raw_row

NEXT = dt.date.fromisoformat(str(DAY)) + dt.timedelta(days=1)


def hashed(spark, n, salt, dates=("2024-01-01",)):
    """n rows, a third of them on the first date."""
    place = F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % len(dates) + 1).cast("int"))
    day = F.element_at(F.array(*[F.lit(d) for d in dates]), place)
    return spark.range(n).select(day.cast("date").alias("order_date"), F.md5(F.concat(F.lit(salt), "id")).alias("_row_hash"))


def test_every_member_hits_and_few_others(spark):
    dates = [f"2024-01-{d:02d}" for d in range(1, 8)]
    mine, other = hashed(spark, 60_000, "a", dates), hashed(spark, 60_000, "b", dates)
    days = [dt.date.fromisoformat(d) for d in dates]
    found = members.summary(mine)
    assert members.possible(mine, found, days).count() == 60_000
    assert members.possible(other, found, days).count() <= 30
    # Filters of several sizes are asked side by side.
    both = found.unionByName(members.summary(other.limit(100)))
    assert members.possible(mine, both, days).count() == 60_000
    assert members.possible(other.limit(100), both, days).count() == 100


def test_blocks_follow_the_rows_of_a_date(spark):
    blocks = members.summary(hashed(spark, 40_000, "a")).agg(F.count(F.lit(1)), F.max("level")).first()
    assert tuple(blocks) == (4096, 12)
    assert members.summary(hashed(spark, 16, "a")).select("level", "block").collect() == [(0, 0)]


def test_nulls_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "x"), (dt.date(2024, 1, 1), "x"), (dt.date(2024, 1, 1), None), (None, "x"), (dt.date(2024, 1, 2), "")],
        "order_date date, _row_hash string",
    )
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    found = members.summary(rows)
    assert found.count() == 2
    got = sorted(map(tuple, members.possible(rows, found, days).collect()))
    assert got == [(dt.date(2024, 1, 1), "x"), (dt.date(2024, 1, 2), "")]
    assert members.summary(rows.limit(0)).count() == 0
    assert members.possible(rows, found.limit(0), days).count() == 0
    assert members.possible(rows.limit(0), found, days).count() == 0
    extra = rows.withColumn("w0", F.lit(1)).withColumn("level", F.lit("z")).withColumn("block", F.lit(7))
    assert sorted(members.summary(extra).collect()) == sorted(found.collect())


def many_dates(n=12):
    days = [(TS - dt.timedelta(days=k + 1)).date().isoformat() for k in range(n)]
    return [raw_row(order_id=f"o{k}", order_date=d, ship_date=d, row_hash=f"h{k}") for k, d in enumerate(days)]


def spy(monkeypatch):
    """What run_gold lists of gold: the dates' folders asked for, and whole reads."""
    seen = {"dates": [], "files": [], "whole": 0}
    some, whole = members.read_gold_dates, read_gold

    def dated(spark, gold, dates, runs):
        df = some(spark, gold, dates, runs)
        seen["dates"] += list(dates)
        seen["files"] += df.inputFiles() if df is not None else []
        return df

    def all_of_it(spark, path):
        seen["whole"] += 1
        return whole(spark, path)

    monkeypatch.setattr(gold_run, "read_gold_dates", dated)
    monkeypatch.setattr(gold_run, "read_gold", all_of_it)
    return seen


def test_only_folders_with_possible_hits_are_listed(spark, monkeypatch):
    rows = many_dates()
    lake, _ = land(spark, rows)
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    # The next day: two rows again under new ids, ten new ones on the same order dates.
    later = TS + dt.timedelta(days=1)
    day2 = [dict(zip(RAW_SCHEMA.fieldNames(), r)) for r in rows]
    for k, r in enumerate(day2):
        r["_loaded_at"] = later
        if k >= 2:
            r["_row_hash"] = f"new{k}"
    append_raw(spark.createDataFrame([tuple(r[c] for c in RAW_SCHEMA.fieldNames()) for r in day2], RAW_SCHEMA), lake.raw)
    seen = spy(monkeypatch)
    res = run_gold(spark, lake, NEXT, "2024-03-12 07:00:00")
    assert res.gold_appended == 10
    assert seen["whole"] == 0 and len(seen["dates"]) == 2 and len(seen["files"]) == 2
    monkeypatch.undo()
    assert read_gold(spark, lake.gold).count() == 22


def test_without_a_summary_gold_itself_is_asked(spark):
    lake, _ = land(spark, many_dates())
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    members.drop_members(spark, lake.gold, set())
    assert members.read_members(spark, lake.gold, gold_runs(read_commits(spark, lake.gold))) is None
    again = read_gold(spark, lake.gold).count()
    append_raw(spark.createDataFrame([raw_row(order_id="late", row_hash="h-late")], RAW_SCHEMA), lake.raw)
    assert run_gold(spark, lake, DAY, "2024-03-12 07:00:00").gold_appended == 1
    assert read_gold(spark, lake.gold).count() == again + 1


def test_compaction_has_one_summary_of_all_runs(spark):
    lake, _ = land(spark, many_dates())
    run_gold(spark, lake, DAY, "2024-03-11 07:00:00")
    append_raw(spark.createDataFrame([raw_row(order_id="late", row_hash="h-late")], RAW_SCHEMA), lake.raw)
    run_gold(spark, lake, DAY, "2024-03-12 07:00:00")
    assert compact_gold(spark, lake.gold) == 2
    runs = gold_runs(read_commits(spark, lake.gold))
    gold = read_gold(spark, lake.gold)
    days = [r[0] for r in gold.select("order_date").distinct().collect()]
    assert members.folder_names(spark, members.members_path(lake.gold)) == {f"_run={r}" for r in runs}
    assert members.possible(gold, members.read_members(spark, lake.gold, runs), days).count() == gold.count() == 13
    append_raw(spark.createDataFrame([raw_row(order_id="later", row_hash="h-later")], RAW_SCHEMA), lake.raw)
    assert run_gold(spark, lake, DAY, "2024-03-13 07:00:00").gold_appended == 1
