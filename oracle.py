"""DuckDB oracle SQL for the registered queries (driver correctness gate).

Each query is built from the same CTE chain: the fixture adapter (driver tables ->
raw orders), the run day, casts, row_number() numbering, checks and routing, written
independently of the Spark code in plain SQL. The driver runs them against the
pre-registered views (lineitem, orders, part, customer, nation, ...).
"""

from __future__ import annotations

# The landing columns, the tokens read as NULL, the canonical store names
# with their raw forms, whitespace, and the word delimiters of title case. Stated here
# again, not imported, so that a wrong entry of the engine does not pass.
BUSINESS_COLUMNS = (
    "order_id", "order_date", "ship_date", "customer_name", "customer_email", "customer_state", "product_name",
    "category", "quantity", "unit_price", "discount_pct", "revenue", "store_name", "shipping_method",
    "payment_method", "order_status",
)
NULL_TOKENS = ("", "NA", "N/A", "null", "NULL")
STORE_LOOKUP = (
    ("Garden Grove Store", ("garden grove store", "garden grove")),
    ("Pacific Coast Store", ("pacific coast store", "pacific coast")),
    ("Lakeside Outlet", ("lakeside outlet", "lakeside")),
    ("Mountain View Store", ("mountain view", "mountain view store")),
    ("Prairie Home Store", ("prairie home", "prairie home store")),
)
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
INITCAP_PUNCTUATION = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'

AS_OF = "2001-06-01"
PREV_DAY = "2001-05-31"
RUN_TS = "2001-06-02 07:00:00"
PREV_RUN_TS = "2001-06-01 07:00:00"
RERUN_TS = "2001-06-03 07:00:00"

_WS = WHITESPACE.replace("'", "''")
_DELIMS = (INITCAP_PUNCTUATION + WHITESPACE).replace("'", "''")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_(x: str) -> str:
    return f"trim({x}, '{_WS}')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {trim_(x)} = '')"


def safe_date(x: str) -> str:
    t = trim_(x)
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
        f"THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) END"
    )


def safe_bigint(x: str) -> str:
    t = trim_(x)
    return f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS BIGINT) END"


def safe_double(x: str) -> str:
    t = trim_(x)
    specials = ", ".join(_q(s) for s in ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"))
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
        f"OR lower({t}) IN ({specials}) THEN TRY_CAST({t} AS DOUBLE) END"
    )


def initcap(x: str) -> str:
    lx = f"lower({x})"
    return (
        f"array_to_string(list_transform(range(1, length({lx}) + 1), lambda i: "
        f"CASE WHEN i = 1 OR strpos('{_DELIMS}', substring({lx}, i - 1, 1)) > 0 "
        f"THEN upper(substring({lx}, i, 1)) ELSE substring({lx}, i, 1) END), '')"
    )


def store_norm(x: str) -> str:
    key = f"lower({trim_(x)})"
    arms = " ".join(
        f"WHEN {key} IN ({', '.join(_q(v) for v in variants)}) THEN {_q(canon)}" for canon, variants in STORE_LOOKUP
    )
    return f"CASE {arms} ELSE {initcap(trim_(x))} END"


def null_tok(x: str) -> str:
    return f"CASE WHEN {x} IN ({', '.join(_q(t) for t in NULL_TOKENS)}) THEN NULL ELSE {x} END"


def pct(part: str, whole: str) -> str:
    """Percent to two decimals, halves up: hundredths of a percent, plus one from half of a remainder on."""
    return (
        f"CASE WHEN {whole} > 0 THEN CAST(({part} * 10000) // {whole} "
        f"+ CASE WHEN (({part} * 10000) % {whole}) * 2 >= {whole} THEN 1 ELSE 0 END AS DOUBLE) / 100.0 END"
    )


def portable_hash(cols=BUSINESS_COLUMNS) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({c}, '~')" for c in sorted(cols)) + "))"


def json_hash(cols) -> str:
    """md5 of json.dumps(row, sort_keys=True) for ASCII values without control chars."""
    parts = []
    for i, c in enumerate(sorted(cols)):
        sep = "" if i == 0 else ", "
        val = f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || replace(replace({c}, '\\', '\\\\'), '\"', '\\\"') || '\"' END"
        parts.append(f"'{sep}\"{c}\": ' || {val}")
    return "md5('{' || " + " || ".join(parts) + " || '}')"


RAW_COLS = ", ".join(BUSINESS_COLUMNS) + ", _loaded_at, _source_file, _row_hash"

# Fixed values of the fixture (FIXTURES.md): store names by supplier, shipping and payment methods.
_STORES = ("Garden Grove Store", "garden grove store", "Pacific Coast", "Pacific Coast Store ", "Mountain View",
           "Prairie Home", "Lakeside Outlet", "LAKESIDE", "corner shop")
_SHIP = ("Standard", "Express", "Overnight", "Ground")
_PAY = ("Credit Card", "PayPal", "Debit Card", "Gift Card")


def _case_index(expr: str, values) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


FIXTURE_BASE = f"""
fx_base AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         o_orderkey, o_custkey, o_orderstatus, p_name, p_type, p_retailprice, c_custkey, c_name, n_name,
         o_orderkey * 7 + l_linenumber * 13 + l_partkey AS h,
         CAST(o_orderdate AS DATE) AS od,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS ext
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
fx_rows AS (
  SELECT
    CASE WHEN h % 97 = 0 THEN NULL WHEN h % 101 = 0 THEN '  '
         ELSE 'O' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id,
    CASE WHEN h % 89 = 0 THEN '2025-99-99' WHEN h % 83 = 0 THEN '' WHEN h % 79 = 0 THEN NULL
         ELSE CAST(od AS VARCHAR) END AS order_date,
    CASE WHEN h % 33 = 0 THEN CAST(od + CAST(-3 AS INTEGER) AS VARCHAR)
         ELSE CAST(od + CAST(h % 10 + 1 AS INTEGER) AS VARCHAR) END AS ship_date,
    CASE WHEN h % 5 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS customer_name,
    CASE WHEN h % 67 = 0 THEN NULL WHEN h % 71 = 0 THEN ''
         ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS customer_email,
    n_name AS customer_state,
    CASE WHEN h % 12 = 0 THEN upper(p_name) WHEN h % 12 = 1 THEN '  ' || p_name ELSE p_name END AS product_name,
    p_type AS category,
    CASE WHEN h % 103 = 0 THEN 'abc' WHEN h % 107 = 0 THEN '0'
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
    CASE WHEN h % 109 = 0 THEN NULL ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount_pct,
    CASE WHEN h % 51 = 0 THEN '0.00' WHEN h % 107 = 0 THEN '-' || ext ELSE ext END AS revenue,
    CASE WHEN h % 113 = 0 THEN NULL WHEN h % 127 = 0 THEN ' '
         ELSE {_case_index("l_suppkey % 9", _STORES)} END AS store_name,
    {_case_index("l_linenumber % 4", _SHIP)} AS shipping_method,
    {_case_index("h % 4", _PAY)} AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Returned' WHEN 'P' THEN 'Cancelled' END AS order_status,
    CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2001-05-31 07:00:00'
         WHEN l_partkey % 2 = 0 THEN TIMESTAMP '2001-06-01 06:00:00'
         ELSE TIMESTAMP '2001-06-01 07:00:00' END AS _loaded_at,
    CASE WHEN o_orderkey % 4 = 0 THEN 'orders_2001-05-31.csv'
         WHEN l_partkey % 2 = 0 THEN 'orders_2001-06-01a.csv'
         ELSE 'orders_2001-06-01b.csv' END AS _source_file
  FROM fx_base
),
raw AS (
  SELECT *, {portable_hash()} AS _row_hash FROM fx_rows
)"""


def staged_ctes(src: str, as_of: str, prefix: str, first: str = "") -> str:
    """CTEs {prefix}_typed, {prefix}_numbered, {prefix}_staged for rows of `src` loaded on as_of.

    `first` is an order that goes before the numbering's own, with a comma after it."""
    p = prefix
    casts = ",\n    ".join(
        [
            f"{safe_date('order_date')} AS order_date_cast",
            f"{safe_date('ship_date')} AS ship_date_cast",
            f"{safe_bigint('quantity')} AS quantity_cast",
            f"{safe_double('unit_price')} AS unit_price_cast",
            f"{safe_double('discount_pct')} AS discount_pct_cast",
            f"{safe_double('revenue')} AS revenue_cast",
        ]
    )
    checks = {
        "missing_order_id": blank("order_id"),
        "duplicate_order_id": "_rn > 1",
        "invalid_order_date": "order_date_cast IS NULL",
        "future_order_date": f"order_date_cast > DATE '{as_of}'",
        "ship_before_order_date": "ship_date_cast IS NOT NULL AND order_date_cast IS NOT NULL AND ship_date_cast < order_date_cast",
        "zero_revenue_with_qty": "revenue_cast IS NOT NULL AND quantity_cast IS NOT NULL AND quantity_cast > 0 AND revenue_cast <= 0",
        "missing_store_name": blank("store_name"),
        "missing_order_date_string": blank("order_date"),
    }
    codes = {
        "missing_order_id": "MISSING_ORDER_ID",
        "duplicate_order_id": "DUPLICATE_ORDER_ID",
        "invalid_order_date": "INVALID_ORDER_DATE",
        "future_order_date": "FUTURE_ORDER_DATE",
        "ship_before_order_date": "SHIP_BEFORE_ORDER_DATE",
        "zero_revenue_with_qty": "ZERO_REVENUE_WITH_QTY",
        "missing_store_name": "MISSING_STORE_NAME",
        "missing_order_date_string": "MISSING_ORDER_DATE_STRING",
    }
    flag_sql = ",\n    ".join(f"coalesce({cond}, false) AS {name}" for name, cond in checks.items())
    reason_sql = "concat_ws(', ', " + ", ".join(f"CASE WHEN {n} THEN '{c}' END" for n, c in codes.items()) + ")"
    return f"""
{p}_typed AS (
  SELECT *,
    {casts}
  FROM {src} WHERE CAST(_loaded_at AS DATE) = DATE '{as_of}'
),
{p}_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY {first} _loaded_at ASC NULLS FIRST, _source_file ASC NULLS FIRST, _row_hash ASC NULLS FIRST) AS _rn
  FROM {p}_typed
),
{p}_checked AS (
  SELECT *,
    {flag_sql}
  FROM {p}_numbered
),
{p}_staged AS (
  SELECT *, {reason_sql} AS failure_reasons, {reason_sql} = '' AS is_valid FROM {p}_checked
)"""


def gold_select(src: str, run_ts: str) -> str:
    return f"""SELECT
    {trim_('order_id')} AS order_id,
    order_date_cast AS order_date,
    ship_date_cast AS ship_date,
    {trim_('customer_name')} AS customer_name,
    NULLIF({trim_('customer_email')}, '') AS customer_email,
    {trim_('customer_state')} AS customer_state,
    {initcap(trim_('product_name'))} AS product_name,
    {trim_('category')} AS category,
    quantity_cast AS quantity,
    unit_price_cast AS unit_price,
    coalesce(discount_pct_cast, 0.0) AS discount_pct,
    abs(revenue_cast) AS revenue,
    {store_norm('store_name')} AS store_name,
    {trim_('shipping_method')} AS shipping_method,
    {trim_('payment_method')} AS payment_method,
    {trim_('order_status')} AS order_status,
    _source_file, _row_hash, _loaded_at,
    TIMESTAMP '{run_ts}' AS _gold_created_at
  FROM {src} WHERE is_valid"""


def quarantine_select(src: str, run_ts: str) -> str:
    return f"""SELECT {', '.join(BUSINESS_COLUMNS)}, _source_file, _row_hash, _loaded_at,
    failure_reasons AS _failure_reason, TIMESTAMP '{run_ts}' AS _quarantine_at
  FROM {src} WHERE NOT is_valid"""


CHECK_FLAG_NAMES = (
    "missing_order_id",
    "duplicate_order_id",
    "invalid_order_date",
    "future_order_date",
    "ship_before_order_date",
    "zero_revenue_with_qty",
    "missing_store_name",
    "missing_order_date_string",
)

LOGGED = (
    ("no_duplicate_order_ids", "duplicate_order_id"),
    ("no_future_order_dates", "future_order_date"),
    ("ship_date_after_order_date", "ship_before_order_date"),
    ("no_zero_revenue_with_quantity", "zero_revenue_with_qty"),
    ("store_name_not_missing", "missing_store_name"),
)
EXTRA = (
    ("order_id_not_missing", "missing_order_id"),
    ("order_date_parseable", "invalid_order_date"),
    ("order_date_string_not_missing", "missing_order_date_string"),
)


def log_select(staged: str, as_of: str, run_ts: str, checks, gold_count: str, raw_count: str) -> str:
    aggs = ", ".join(f"CAST(count_if({flag}) AS BIGINT) AS n{i}" for i, (_, flag) in enumerate(checks))
    arms = []
    for i, (name, _) in enumerate(checks):
        arms.append(
            f"SELECT DATE '{as_of}' AS run_date, '{name}' AS check_name, "
            f"CASE WHEN n{i} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, total AS total_rows, "
            f"n{i} AS failing_rows, {pct(f'n{i}', 'total')} AS pct_failed, TIMESTAMP '{run_ts}' AS checked_at FROM agg_{as_of.replace('-', '')}"
        )
    rec = (
        f"SELECT DATE '{as_of}' AS run_date, 'gold_vs_raw_row_count_check' AS check_name, "
        f"CASE WHEN r > 0 AND abs(g - r) * 10 < r THEN 'PASS' ELSE 'FAIL' END AS status, r AS total_rows, "
        f"abs(g - r) AS failing_rows, {pct('abs(g - r)', 'r')} AS pct_failed, TIMESTAMP '{run_ts}' AS checked_at "
        f"FROM (SELECT CAST(({gold_count}) AS BIGINT) AS g, CAST(({raw_count}) AS BIGINT) AS r) AS cnt"
    )
    agg_cte = f"agg_{as_of.replace('-', '')} AS (SELECT CAST(count(*) AS BIGINT) AS total, {aggs} FROM {staged})"
    return agg_cte, "\nUNION ALL\n".join(arms + [rec])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c)


# --------------------------------------------------------------------------------------


def build() -> dict[str, str]:
    day = staged_ctes("raw", AS_OF, "d")
    base = with_(FIXTURE_BASE, day)
    gold_cte = f"gold AS ({gold_select('d_staged', RUN_TS)})"
    quar_cte = f"quarantine AS ({quarantine_select('d_staged', RUN_TS)})"
    s: dict[str, str] = {}

    s["raw_orders"] = f"{with_(FIXTURE_BASE)} SELECT {RAW_COLS} FROM raw"
    s["raw_landing_count"] = f"{with_(FIXTURE_BASE)} SELECT CAST(count(*) AS BIGINT) AS raw_rows FROM raw"
    s["null_token_normalise"] = (
        f"{with_(FIXTURE_BASE)} SELECT "
        + ", ".join(f"{null_tok(c)} AS {c}" for c in BUSINESS_COLUMNS)
        + ", _row_hash FROM raw"
    )
    norm = ", ".join(f"{null_tok(c)} AS {c}" for c in BUSINESS_COLUMNS)
    s["row_hash"] = (
        f"{with_(FIXTURE_BASE, f'n AS (SELECT {norm}, _row_hash FROM raw)')} "
        f"SELECT order_id, _row_hash, {portable_hash()} AS portable_hash, {json_hash(BUSINESS_COLUMNS)} AS json_hash FROM n"
    )
    s["incremental_day"] = f"{with_(FIXTURE_BASE)} SELECT {RAW_COLS} FROM raw WHERE CAST(_loaded_at AS DATE) = DATE '{AS_OF}'"
    s["typed_orders"] = (
        f"{base} SELECT order_id, _row_hash, order_date_cast, ship_date_cast, quantity_cast, "
        f"unit_price_cast, discount_pct_cast, revenue_cast FROM d_typed"
    )
    s["dedupe_rank"] = (
        f"{base} SELECT order_id, _loaded_at, _source_file, _row_hash, _rn > 1 AS duplicate_order_id FROM d_numbered"
    )
    flags = ", ".join(CHECK_FLAG_NAMES)
    s["row_checks"] = f"{base} SELECT order_id, _row_hash, {flags} FROM d_staged"
    s["failure_reasons"] = f"{base} SELECT order_id, _row_hash, failure_reasons, is_valid FROM d_staged"
    s["gold_orders"] = f"{base} {gold_select('d_staged', RUN_TS)}"
    s["quarantine_orders"] = f"{base} {quarantine_select('d_staged', RUN_TS)}"
    s["store_normalise"] = (
        f"{with_(FIXTURE_BASE)} SELECT store_name AS raw_store_name, {store_norm('store_name')} AS store_name, "
        f"CAST(count(*) AS BIGINT) AS raw_rows FROM raw GROUP BY 1"
    )
    s["product_normalise"] = (
        f"{with_(FIXTURE_BASE)} SELECT product_name AS raw_product_name, {initcap(trim_('product_name'))} AS product_name, "
        f"CAST(count(*) AS BIGINT) AS raw_rows FROM raw GROUP BY 1"
    )

    gold_n = "SELECT count(*) FROM gold"
    raw_n = "SELECT count(*) FROM raw"
    agg_cte, body = log_select("d_staged", AS_OF, RUN_TS, LOGGED, gold_n, raw_n)
    s["check_log"] = f"{with_(FIXTURE_BASE, day, gold_cte, agg_cte)} {body}"
    agg_cte8, body8 = log_select("d_staged", AS_OF, RUN_TS, LOGGED + EXTRA, gold_n, raw_n)
    s["check_log_all_eight"] = f"{with_(FIXTURE_BASE, day, gold_cte, agg_cte8)} {body8}"
    rec_only = body.split("UNION ALL")[-1]
    s["reconcile_row_counts"] = f"{with_(FIXTURE_BASE, day, gold_cte)} {rec_only}"

    s["destination_counts"] = (
        f"{with_(FIXTURE_BASE, day, gold_cte, quar_cte)} "
        f"SELECT 'gold' AS destination, CAST(count(*) AS BIGINT) AS row_count FROM gold "
        f"UNION ALL SELECT 'quarantine', CAST(count(*) AS BIGINT) FROM quarantine"
    )
    s["quarantine_by_reason"] = (
        f"{with_(FIXTURE_BASE, day, quar_cte)} SELECT _failure_reason, CAST(count(*) AS BIGINT) AS rejected_rows "
        f"FROM quarantine GROUP BY _failure_reason ORDER BY rejected_rows DESC, _failure_reason"
    )
    codes = ", ".join(
        f"CAST(count_if(contains(_failure_reason, '{c}')) AS BIGINT) AS {c.lower()}"
        for c in ("MISSING_ORDER_ID", "DUPLICATE_ORDER_ID", "INVALID_ORDER_DATE", "FUTURE_ORDER_DATE",
                  "SHIP_BEFORE_ORDER_DATE", "ZERO_REVENUE_WITH_QTY", "MISSING_STORE_NAME", "MISSING_ORDER_DATE_STRING")
    )
    s["quarantine_reason_codes"] = f"{with_(FIXTURE_BASE, day, quar_cte)} SELECT {codes} FROM quarantine"
    s["orders_by_store"] = (
        f"{with_(FIXTURE_BASE, day, gold_cte)} SELECT store_name, CAST(count(*) AS BIGINT) AS orders "
        f"FROM gold GROUP BY store_name ORDER BY orders DESC, store_name"
    )
    s["orders_by_product"] = (
        f"{with_(FIXTURE_BASE, day, gold_cte)} SELECT product_name, CAST(count(*) AS BIGINT) AS orders "
        f"FROM gold GROUP BY product_name ORDER BY orders DESC, product_name"
    )

    # Two run days through the real writes: 2001-05-31, then 2001-06-01.
    prev = staged_ctes("raw", PREV_DAY, "p")
    gold_prev = f"gold_prev AS ({gold_select('p_staged', PREV_RUN_TS)})"
    gold_new = (
        f"gold_new AS (SELECT g.* FROM ({gold_select('d_staged', RUN_TS)}) g "
        f"WHERE NOT EXISTS (SELECT 1 FROM gold_prev x WHERE x.order_date = g.order_date AND x._row_hash = g._row_hash))"
    )
    gold_all = "gold_all AS (SELECT * FROM gold_prev UNION ALL SELECT * FROM gold_new)"
    n_logged = len(LOGGED) + 1
    two_days = with_(FIXTURE_BASE, prev, day, gold_prev, gold_new)
    n_of = "CAST(count(*) AS BIGINT) AS row_count FROM"
    s["run_marker"] = (
        f"{two_days} SELECT 'broken off' AS phase, 'gold' AS table_name, {n_of} gold_prev "
        f"UNION ALL SELECT 'broken off', 'quarantine', {n_of} p_staged WHERE NOT is_valid "
        f"UNION ALL SELECT 'broken off', 'check_log', CAST({n_logged} AS BIGINT) "
        f"UNION ALL SELECT 'run again', 'gold', {n_of} (SELECT 1 FROM gold_prev UNION ALL SELECT 1 FROM gold_new) "
        f"UNION ALL SELECT 'run again', 'quarantine', {n_of} "
        f"(SELECT 1 FROM p_staged WHERE NOT is_valid UNION ALL SELECT 1 FROM d_staged WHERE NOT is_valid) "
        f"UNION ALL SELECT 'run again', 'check_log', CAST({2 * n_logged} AS BIGINT)"
    )
    s["compact_gold"] = f"{two_days} SELECT * FROM gold_prev UNION ALL SELECT * FROM gold_new"
    a1, b1 = log_select("p_staged", PREV_DAY, PREV_RUN_TS, LOGGED, "SELECT count(*) FROM gold_prev", raw_n)
    a2, b2 = log_select("d_staged", AS_OF, RUN_TS, LOGGED, "SELECT count(*) FROM gold_all", raw_n)
    s["check_log_history"] = (
        f"{with_(FIXTURE_BASE, prev, day, gold_prev, gold_new, gold_all, a1, a2)} "
        f"SELECT run_date, check_name, status, total_rows, failing_rows, pct_failed FROM ({b1}\nUNION ALL\n{b2}) "
        f"ORDER BY run_date DESC, check_name"
    )

    # Day-1 Express rows land again on day 2 under a new file name (08:00, re.csv).
    relanded = (
        "raw2 AS (SELECT * FROM raw UNION ALL SELECT "
        + ", ".join(BUSINESS_COLUMNS)
        + f", TIMESTAMP '{AS_OF} 08:00:00' AS _loaded_at, 're.csv' AS _source_file, _row_hash FROM raw "
        f"WHERE CAST(_loaded_at AS DATE) = DATE '{PREV_DAY}' AND shipping_method = 'Express')"
    )
    day2 = staged_ctes("raw2", AS_OF, "d")
    s["skip_already_loaded"] = (
        f"{with_(FIXTURE_BASE, relanded, prev, day2, gold_prev, gold_new)} "
        f"SELECT order_id, order_date, _row_hash, _source_file, _loaded_at, _gold_created_at FROM gold_prev "
        f"UNION ALL SELECT order_id, order_date, _row_hash, _source_file, _loaded_at, _gold_created_at FROM gold_new"
    )
    s["rerun_day"] = f"{base} {gold_select('d_staged', RUN_TS)}"

    # The day runs over file b alone; then file a lands, and Express rows of b again with
    # an earlier load time, as new rows; the day runs again and gold's rows stay.
    day_1 = f"raw_1 AS (SELECT * FROM raw WHERE _source_file = 'orders_2001-06-01b.csv')"
    late = (
        "raw_2 AS (SELECT *, NOT EXISTS (SELECT 1 FROM gold_prev g WHERE g._source_file = r._source_file "
        "AND g._row_hash = r._row_hash AND g._loaded_at = r._loaded_at) AS _is_new FROM ("
        "SELECT * FROM raw WHERE _source_file <> 'orders_2001-05-31.csv' UNION ALL "
        f"SELECT {', '.join(BUSINESS_COLUMNS)}, TIMESTAMP '{AS_OF} 05:00:00', 'late.csv', md5(_row_hash) FROM raw_1 "
        "WHERE shipping_method = 'Express') r)"
    )
    late_ctes = with_(
        FIXTURE_BASE, day_1, staged_ctes("raw_1", AS_OF, "p"), f"gold_prev AS ({gold_select('p_staged', RUN_TS)})",
        late, staged_ctes("raw_2", AS_OF, "d", "_is_new,"), gold_new.replace(RUN_TS, RERUN_TS),
    )
    kept_cols = "order_id, _source_file, _row_hash, _loaded_at"
    s["late_file_rerun"] = (
        f"{late_ctes} SELECT 'gold' AS destination, {kept_cols}, NULL AS reason FROM gold_prev UNION ALL "
        f"SELECT 'gold', {kept_cols}, NULL FROM gold_new UNION ALL "
        f"SELECT 'quarantine', {kept_cols}, failure_reasons FROM d_staged WHERE NOT is_valid"
    )

    s["raw_profile"] = f"""{with_(FIXTURE_BASE)}
SELECT CAST(count(*) AS BIGINT) AS total_rows, {len(BUSINESS_COLUMNS)} AS n_columns,
  CAST(count(*) - count(DISTINCT order_id) - max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_order_ids,
  CAST(count_if({safe_date('order_date')} > DATE '{AS_OF}') AS BIGINT) AS future_order_dates,
  CAST(count_if({safe_double('revenue')} = 0) AS BIGINT) AS zero_revenue,
  CAST(count_if(store_name IS NULL) AS BIGINT) AS missing_store_name,
  CAST(count_if(customer_email IS NULL) AS BIGINT) AS missing_customer_email,
  CAST(count_if({safe_date('ship_date')} < {safe_date('order_date')}) AS BIGINT) AS ship_before_order,
  CAST(count_if(product_name IS NULL OR product_name <> {trim_('product_name')}) AS BIGINT) AS dirty_product_names,
  CAST(count_if(product_name IS NULL OR lower(product_name) <> lower({trim_('product_name')})) AS BIGINT) AS dirty_product_names_casefold
FROM raw"""
    s["raw_preview"] = (
        f"{with_(FIXTURE_BASE)} SELECT {RAW_COLS} FROM raw "
        f"ORDER BY _loaded_at, _source_file, _row_hash LIMIT 3"
    )
    # CSV landing: a = 05-31 rows (16 columns), b = 06-01a rows (16, other header),
    # c = 06-01b rows without customer_state (so NULL there and 15 names in the hash).
    cols15 = [c for c in BUSINESS_COLUMNS if c != "customer_state"]
    sel16 = ", ".join(BUSINESS_COLUMNS)
    sel15 = ", ".join("NULL AS customer_state" if c == "customer_state" else c for c in BUSINESS_COLUMNS)
    n_cte = f"n AS (SELECT {norm}, _source_file AS fx_file FROM raw)"

    def csv_rows(ts_a: str, ts_bc: str) -> str:
        return (
            f"csvraw AS (SELECT {sel16}, {json_hash(BUSINESS_COLUMNS)} AS _row_hash, TIMESTAMP '{ts_a}' AS _loaded_at, "
            f"'a' AS _source_file FROM n WHERE fx_file = 'orders_2001-05-31.csv' "
            f"UNION ALL SELECT {sel16}, {json_hash(BUSINESS_COLUMNS)}, TIMESTAMP '{ts_bc}', 'b' FROM n "
            f"WHERE fx_file = 'orders_2001-06-01a.csv' "
            f"UNION ALL SELECT {sel15}, {json_hash(cols15)}, TIMESTAMP '{ts_bc}', 'c' FROM n "
            f"WHERE fx_file = 'orders_2001-06-01b.csv')"
        )

    landed = csv_rows(f"{AS_OF} 07:00:00", f"{AS_OF} 07:00:00")
    s["csv_roundtrip"] = (
        f"{with_(FIXTURE_BASE, n_cte, landed)} SELECT {sel16}, _row_hash, _source_file AS source_group FROM csvraw"
    )
    s["stream_ingest"] = s["csv_roundtrip"]
    s["stream_late_file"] = s["csv_roundtrip"]
    s["stream_forgotten"] = s["csv_roundtrip"]
    # Edge cases: what each of the sixteen forms reads as; only forms 11 to 13 differ where category is last.
    kind = "strpos('0123456789abcdef', substr(_row_hash, 1, 1)) - 1"
    product = (
        "CASE k WHEN 2 THEN p || ', \"x\"' WHEN 3 THEN p || 'tail' WHEN 4 THEN 'x' || p || '\"q\"' "
        "WHEN 5 THEN ' \"' || p || '\"' WHEN 6 THEN p || 'a\"b' WHEN 7 THEN '' WHEN 8 THEN '\"' WHEN 9 THEN 'NA' ELSE p END"
    )
    category = "CASE WHEN g <> 'b' AND k = 11 THEN c || ', more' WHEN g <> 'b' AND k = 13 THEN '' ELSE c END"
    edge_names = ("order_id", "store_name", "product_name", "category")
    edge = (
        f"edge AS (SELECT {kind} AS k, coalesce(order_id, '') AS o, coalesce(store_name, '') AS s, coalesce(product_name, '') AS p, "
        f"coalesce(category, '') AS c, CASE _source_file WHEN 'orders_2001-05-31.csv' THEN 'a' "
        f"WHEN 'orders_2001-06-01a.csv' THEN 'b' ELSE 'c' END AS g FROM raw), "
        f"edge_text AS (SELECT g, k, o AS order_id, s AS store_name, {product} AS product_name, {category} AS category FROM edge), "
        f"edge_null AS (SELECT g, k, {', '.join(f'{null_tok(x)} AS {x}' for x in edge_names)} FROM edge_text)"
    )
    edge_rows = f"SELECT {', '.join(edge_names)}, {json_hash(edge_names)} AS _row_hash, g AS source_group FROM edge_null"
    s["csv_edge_cases"] = f"{with_(FIXTURE_BASE, edge)} {edge_rows} UNION ALL {edge_rows} WHERE k = 15"
    in_file = "count(*) AS n FROM raw WHERE _source_file ="
    s["landing_rejects"] = (
        f"{with_(FIXTURE_BASE)} SELECT 'a' AS source_group, 'landed' AS outcome, {in_file} 'orders_2001-05-31.csv' "
        f"UNION ALL SELECT 'b', 'landed', {in_file} 'orders_2001-06-01a.csv' "
        f"UNION ALL SELECT 'c', 'unknown columns: [''coupon'']', CAST(least(count(*), 1) AS BIGINT) AS n "
        f"FROM raw WHERE _source_file = 'orders_2001-06-01b.csv'"
    )
    # Stored metrics: landing and gold run of the same landed rows.
    day_m = staged_ctes("csvraw", AS_OF, "d")
    s["run_metrics"] = (
        f"{with_(FIXTURE_BASE, n_cte, landed, day_m)} SELECT 'landing' AS kind, 'rows_landed' AS metric, count(*) AS value FROM csvraw "
        f"UNION ALL SELECT 'gold', 'staged_rows', count(*) FROM d_staged "
        f"UNION ALL SELECT 'gold', 'gold_appended', count(*) FROM d_staged WHERE is_valid "
        f"UNION ALL SELECT 'gold', 'quarantined', count(*) FROM d_staged WHERE NOT is_valid "
        f"UNION ALL SELECT 'ledger', _source_file, count(*) FROM csvraw GROUP BY _source_file"
    )
    s["batch_replace"] = (
        f"{with_(FIXTURE_BASE)} SELECT {', '.join(BUSINESS_COLUMNS)}, _row_hash, '2001-07-01' AS load_day "
        f"FROM raw WHERE _source_file = 'orders_2001-05-31.csv'"
    )
    # Three batches of the day end as one run over all of them.
    lies = "order_id, _source_file, _row_hash, _loaded_at"
    s["gold_increments"] = (
        f"{with_(FIXTURE_BASE, day, gold_cte)} SELECT 'gold' AS destination, {lies}, NULL AS reason FROM gold "
        f"UNION ALL SELECT 'quarantine', {lies}, failure_reasons FROM d_staged WHERE NOT is_valid"
    )
    s["increment_log"] = s["check_log"]
    # Two days of state: the second upload of file a is dropped, the last one is beyond it.
    in_a = "SELECT _row_hash FROM raw WHERE _source_file = 'orders_2001-05-31.csv'"
    in_b = "SELECT _row_hash FROM raw WHERE _source_file = 'orders_2001-06-01a.csv'"
    s["stream_reuploads"] = (
        f"{with_(FIXTURE_BASE)} SELECT DISTINCT _row_hash, TIMESTAMP '2001-06-01 07:00:00' AS _loaded_at FROM ({in_a}) "
        f"UNION ALL SELECT *, TIMESTAMP '2001-06-12 07:00:00' FROM ({in_b} EXCEPT {in_a}) "
        f"UNION ALL SELECT DISTINCT _row_hash, TIMESTAMP '2001-06-12 08:00:00' FROM ({in_a})"
    )
    s["sql_by_reason"] = s["quarantine_by_reason"]
    s["quarantine_written"] = (
        f"SELECT {', '.join(BUSINESS_COLUMNS)}, _row_hash, _failure_reason FROM ({s['quarantine_orders']})"
    )

    streamed = csv_rows(f"{PREV_DAY} 07:00:00", f"{AS_OF} 07:00:00")
    prev_c = staged_ctes("csvraw", PREV_DAY, "p")
    day_c = staged_ctes("csvraw", AS_OF, "d")
    gcols = "order_id, order_date, ship_date, customer_name, customer_email, customer_state, product_name, category, " \
        "quantity, unit_price, discount_pct, revenue, store_name, shipping_method, payment_method, order_status, " \
        "_row_hash, _loaded_at, _gold_created_at, _source_file AS source_group"
    s["stream_gold"] = (
        f"{with_(FIXTURE_BASE, n_cte, streamed, prev_c, day_c, gold_prev, gold_new)} "
        f"SELECT {gcols} FROM gold_prev UNION ALL SELECT {gcols} FROM gold_new"
    )
    return s


__all__ = ["build", "AS_OF", "PREV_DAY", "RUN_TS", "PREV_RUN_TS", "RERUN_TS"]
