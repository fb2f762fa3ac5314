"""Non-failing casts of raw text (ANSI mode stays on; every cast is a try_*).

Each cast trims Unicode whitespace first and only hands text of the accepted shape to
Spark's try_* cast, because Spark alone accepts more than the warehouse dialect does
(`24-01-05` as a date, `1d` as a double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import ws_trim

# --------------------------------------------------------------------------------------
# Accepted text shapes.
# --------------------------------------------------------------------------------------
DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"  # %Y-%m-%d, 1- or 2-digit month and day
INTEGER_SHAPE = r"^[+-]?[0-9]+$"
DECIMAL_SHAPE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_SPECIALS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c: Column | str) -> Column:
    """Trimmed `%Y-%m-%d` text to DATE; NULL for any other shape or an impossible date.

    Behind the shape guard, Spark's string-to-date cast reads exactly
    year-month-day (1- or 2-digit month and day) and returns NULL for impossible
    dates; it is several times cheaper than a pattern-based parse.
    """
    t = ws_trim(_col(c))
    return F.when(t.rlike(DATE_SHAPE), t.try_cast("date"))


def safe_bigint(c: Column | str) -> Column:
    """Trimmed integer text to BIGINT; NULL for decimals, exponents, overflow, junk."""
    t = ws_trim(_col(c))
    return F.when(t.rlike(INTEGER_SHAPE), t.try_cast("bigint"))


def safe_double(c: Column | str) -> Column:
    """Trimmed decimal / exponent / nan / inf text to DOUBLE; NULL otherwise."""
    t = ws_trim(_col(c))
    ok = t.rlike(DECIMAL_SHAPE) | F.lower(t).isin(*FLOAT_SPECIALS)
    return F.when(ok, t.try_cast("double"))


__all__ = ["safe_date", "safe_bigint", "safe_double"]
