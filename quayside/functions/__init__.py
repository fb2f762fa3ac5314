"""Column functions (pure Spark Column expressions)."""

from quayside.functions.casts import safe_bigint, safe_date, safe_double
from quayside.functions.hashing import json_row_hash, json_string, portable_row_hash
from quayside.functions.text import (
    initcap_words,
    is_blank,
    normalise_product,
    normalise_store,
    null_tokens_to_null,
    nullif_blank,
    ws_trim,
)

__all__ = [
    "safe_bigint",
    "safe_date",
    "safe_double",
    "json_row_hash",
    "json_string",
    "portable_row_hash",
    "initcap_words",
    "is_blank",
    "normalise_product",
    "normalise_store",
    "null_tokens_to_null",
    "nullif_blank",
    "ws_trim",
]
