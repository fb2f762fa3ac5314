"""Test-fixture adapter: derive dirty raw orders from the driver's TPC-H-like tables.

One raw row per lineitem, joined to its order, part, customer and nation. The dirt is
chosen deterministically from ``h = o_orderkey*7 + l_linenumber*13 + l_partkey`` (see
FIXTURES.md); the oracle runs the same derivation in DuckDB. Customers and nations join the
orders, parts the lines, so no shuffle moves a customer's columns once per line: nation (and, at
small scale, part and customer) fall under the broadcast size threshold. The join of the
two, on the order key, is a sort-merge join at any size: it deals the rows to as many tasks as
there are shuffle partitions, which the landing then writes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.hashing import portable_row_hash
from quayside.schema import BUSINESS_COLUMNS, LOAD_DATE, RAW_SCHEMA

# --------------------------------------------------------------------------------------
# Fixture dirt (FIXTURES.md section 2).
# --------------------------------------------------------------------------------------
FIXTURE_STORES = (
    "Garden Grove Store",
    "garden grove store",
    "Pacific Coast",
    "Pacific Coast Store ",
    "Mountain View",
    "Prairie Home",
    "Lakeside Outlet",
    "LAKESIDE",
    "corner shop",
)
FIXTURE_SHIPPING = ("Standard", "Express", "Overnight", "Ground")
FIXTURE_PAYMENT = ("Credit Card", "PayPal", "Debit Card", "Gift Card")
FIXTURE_STATUS = (("F", "Completed"), ("O", "Returned"), ("P", "Cancelled"))
FIXTURE_LOADS = (
    # (_loaded_at, _source_file)
    ("2001-05-31 07:00:00", "orders_2001-05-31.csv"),
    ("2001-06-01 06:00:00", "orders_2001-06-01a.csv"),
    ("2001-06-01 07:00:00", "orders_2001-06-01b.csv"),
)
FIXTURE_AS_OF = "2001-06-01"
FIXTURE_PREV_DAY = "2001-05-31"


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders (16 strings + 3 audit columns) derived from the driver tables."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    lines = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    j = lines.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    h = F.col("o_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")
    od = F.to_date(F.col("o_orderdate"))
    ext = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")

    def m(n: int) -> Column:
        return (h % n) == 0

    cols = {
        "order_id": F.when(m(97), F.lit(None).cast("string"))
        .when(m(101), F.lit("  "))
        .otherwise(F.concat(F.lit("O"), F.col("o_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))),
        "order_date": F.when(m(89), F.lit("2025-99-99"))
        .when(m(83), F.lit(""))
        .when(m(79), F.lit(None).cast("string"))
        .otherwise(od.cast("string")),
        "ship_date": F.when(m(33), F.date_add(od, -3).cast("string")).otherwise(
            F.date_add(od, (h % 10 + 1).cast("int")).cast("string")
        ),
        "customer_name": F.when(m(5), F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).otherwise(F.col("c_name")),
        "customer_email": F.when(m(67), F.lit(None).cast("string"))
        .when(m(71), F.lit(""))
        .otherwise(F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com"))),
        "customer_state": F.col("n_name"),
        "product_name": F.when(m(12), F.upper(F.col("p_name")))
        .when((h % 12) == 1, F.concat(F.lit("  "), F.col("p_name")))
        .otherwise(F.col("p_name")),
        "category": F.col("p_type"),
        "quantity": F.when(m(103), F.lit("abc"))
        .when(m(107), F.lit("0"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")),
        "unit_price": F.col("p_retailprice").cast("decimal(18,2)").cast("string"),
        "discount_pct": F.when(m(109), F.lit(None).cast("string")).otherwise(
            F.col("l_discount").cast("decimal(4,2)").cast("string")
        ),
        "revenue": F.when(m(51), F.lit("0.00")).when(m(107), F.concat(F.lit("-"), ext)).otherwise(ext),
        "store_name": F.when(m(113), F.lit(None).cast("string"))
        .when(m(127), F.lit(" "))
        .otherwise(_pick(F.col("l_suppkey") % 9, FIXTURE_STORES)),
        "shipping_method": _pick(F.col("l_linenumber") % 4, FIXTURE_SHIPPING),
        "payment_method": _pick(h % 4, FIXTURE_PAYMENT),
        "order_status": _pick_map(F.col("o_orderstatus"), FIXTURE_STATUS),
    }
    day_prev = F.col("o_orderkey") % 4 == 0
    early = F.col("l_partkey") % 2 == 0
    (ts0, f0), (ts1, f1), (ts2, f2) = FIXTURE_LOADS
    loaded_at = F.when(day_prev, F.to_timestamp(F.lit(ts0))).when(early, F.to_timestamp(F.lit(ts1))).otherwise(
        F.to_timestamp(F.lit(ts2))
    )
    source = F.when(day_prev, F.lit(f0)).when(early, F.lit(f1)).otherwise(F.lit(f2))

    business = j.select(*[cols[c].alias(c) for c in BUSINESS_COLUMNS], loaded_at.alias("_loaded_at"), source.alias("_source_file"))
    return business.withColumn("_row_hash", portable_row_hash(BUSINESS_COLUMNS)).select(*RAW_SCHEMA.fieldNames())


def _pick_map(value: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(value == F.lit(k), F.lit(v)) if out is None else out.when(value == F.lit(k), F.lit(v))
    return out


def with_load_date(raw: DataFrame) -> DataFrame:
    """Add the raw table's partition column: the UTC calendar day of _loaded_at."""
    return raw.withColumn(LOAD_DATE, F.to_date(F.col("_loaded_at")))


__all__ = [
    "FIXTURE_AS_OF",
    "FIXTURE_PREV_DAY",
    "FIXTURE_LOADS",
    "fixture_raw_orders",
    "read_table",
    "with_load_date",
]
