"""Helpers: build raw rows and land them in a raw table under the shared scratch folder."""

import datetime as dt

from quayside.schema import BUSINESS_COLUMNS, RAW_SCHEMA
from quayside.session import Lakehouse
from quayside.sources.raw_table import append_raw, read_raw

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DAY = "2024-03-10"
TS = dt.datetime(2024, 3, 10, 7, 0, 0)

GOOD = {
    "order_id": "O-1",
    "order_date": "2024-03-01",
    "ship_date": "2024-03-03",
    "customer_name": "Jane Lopez",
    "customer_email": "jane@example.com",
    "customer_state": "CA",
    "product_name": "patio chair",
    "category": "Garden",
    "quantity": "2",
    "unit_price": "10.00",
    "discount_pct": "0.1",
    "revenue": "18.00",
    "store_name": "Lakeside",
    "shipping_method": "Ground",
    "payment_method": "PayPal",
    "order_status": "Completed",
}


def raw_row(loaded_at=TS, source="f1.csv", row_hash=None, **over):
    r = dict(GOOD)
    r.update(over)
    h = row_hash if row_hash is not None else "h-" + "|".join(str(r[c]) for c in sorted(BUSINESS_COLUMNS))
    return tuple(r[c] for c in BUSINESS_COLUMNS) + (loaded_at, source, h)


def land(spark, rows, lake=None):
    lake = lake or Lakehouse.fresh(spark, "test-lake")
    append_raw(spark.createDataFrame(rows, RAW_SCHEMA), lake.raw)
    return lake, read_raw(spark, lake.raw)
