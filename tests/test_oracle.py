"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

from helpers import SF_SMALL

from quayside.plans.queries import QUERIES

SQL = E.oracle_sql()
KEYS = sorted(SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def test_every_order_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.sql(SQL[key])
    assert sorted(df.columns) == sorted(res.columns)
    o_rows = res.fetchall()
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(res.columns, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns and len(df.columns) == 20
