"""Row hashes, computed natively (no Python per row).

``json_row_hash`` reproduces ``md5(json.dumps(row, sort_keys=True))`` of a Python dict
of strings/None byte for byte, including the ASCII escaping of non-ASCII text that
``json.dumps`` applies by default. ``portable_row_hash`` is the simpler form the test
fixture uses, which DuckDB can compute too.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------------------
# Short escapes of JSON strings; other control characters use \\u00XX.
# --------------------------------------------------------------------------------------
_SHORT_ESCAPES = (
    ('"', '\\"'),
    ("\\", "\\\\"),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
)
# Any character outside printable ASCII (space to tilde) needs per-character escaping.
_NEEDS_CHAR_ESCAPE = r"[^ -~]"
PORTABLE_NULL = "~"
PORTABLE_SEPARATOR = "|"


def _u_escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escape_char(ch: Column) -> Column:
    cp = F.ascii(ch)  # code point of the (single) character
    out = None
    for raw, esc in _SHORT_ESCAPES:
        out = F.when(ch == F.lit(raw), F.lit(esc)) if out is None else out.when(ch == F.lit(raw), F.lit(esc))
    astral = cp - F.lit(0x10000)
    return (
        out.when(ch == F.lit(""), F.lit(""))
        .when((cp >= 0x20) & (cp <= 0x7E), ch)
        .when(cp < 0x10000, _u_escape(cp))
        .otherwise(
            F.concat(
                _u_escape(F.lit(0xD800) + F.shiftright(astral, 10)),
                _u_escape(F.lit(0xDC00) + astral.bitwiseAND(0x3FF)),
            )
        )
    )


def json_string(c: Column, key: str = "") -> Column:
    """The JSON literal for a string column, as ``json.dumps`` (ensure_ascii) writes it, behind ``key``."""
    simple = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    slow = F.array_join(F.transform(F.split(c, ""), _escape_char), "")
    body = F.when(c.rlike(_NEEDS_CHAR_ESCAPE), slow).otherwise(simple)
    return _quoted(c, body, key)


def _quoted(c: Column, body: Column, key: str) -> Column:
    # The key goes into the one concatenation: a second one would copy every value again.
    return F.when(c.isNull(), F.lit(key + "null")).otherwise(F.concat(F.lit(key + '"'), body, F.lit('"')))


def _plain_json_string(c: Column, key: str = "") -> Column:
    # For text of printable ASCII without quote or backslash: no escaping at all.
    return _quoted(c, c, key)


def _needs_escape(text: Column) -> Column:
    """Whether json.dumps would escape any character of a text: outside printable ASCII, a quote, a backslash."""
    # One range is what the regex engine is quick at; an alternative for the other two took three times as long.
    return text.rlike(_NEEDS_CHAR_ESCAPE) | F.contains(text, F.lit('"')) | F.contains(text, F.lit("\\"))


def json_row_hash(fields: Mapping[str, Column], present: Mapping[str, Column] | None = None) -> Column:
    """md5 hex of ``json.dumps({name: value, ...}, sort_keys=True)`` for string values.

    One test per row decides whether any value needs escaping; only such rows take the
    escaping path, which is one expression over all values. ``present`` tells per row which
    names the dict has (all, if not given).
    """
    names = sorted(fields)
    if not names:
        return F.md5(F.lit("{}"))
    keys = {n: json.dumps(n) + ": " for n in names}

    if present is None:
        parts = [_plain_json_string(fields[n], ("" if i == 0 else ", ") + keys[n]) for i, n in enumerate(names)]
        plain = F.concat(F.lit("{"), *parts, F.lit("}"))
    else:
        pairs = [F.when(present[n], _plain_json_string(fields[n], keys[n])) for n in names]
        plain = F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))

    key = {n: F.lit(keys[n]) if present is None else F.when(present[n], F.lit(keys[n])) for n in names}
    entries = F.array(*[F.struct(key[n].alias("key"), fields[n].alias("value")) for n in names])
    escaped = F.transform(entries, lambda e: F.concat(e["key"], json_string(e["value"])))  # null where not present
    needs_escape = _needs_escape(F.concat_ws("", *[fields[n] for n in names]))
    return F.md5(F.when(needs_escape, F.concat(F.lit("{"), F.concat_ws(", ", escaped), F.lit("}"))).otherwise(plain))


def portable_row_hash(columns: Iterable[str]) -> Column:
    """md5 of the columns in name order, NULL as '~', joined by '|'."""
    return F.md5(
        F.concat_ws(PORTABLE_SEPARATOR, *[F.coalesce(F.col(c), F.lit(PORTABLE_NULL)) for c in sorted(columns)])
    )


#: Characters of a row hash, an MD5 digest in hex.
HASH_LENGTH = 32


def hash_bytes(c: Column | str) -> Column:
    """The bytes of a row hash in lower-case hex, which have its order in half its size; null for any other text."""
    c = F.col(c) if isinstance(c, str) else c
    code = F.unhex(c)
    return F.when((F.length(c) == HASH_LENGTH) & (F.lower(F.hex(code)) == c), code)


def hash_text(code: Column | str) -> Column:
    """The row hash of its bytes."""
    return F.lower(F.hex(code))


__all__ = ["hash_bytes", "hash_text", "json_string", "json_row_hash", "portable_row_hash"]
