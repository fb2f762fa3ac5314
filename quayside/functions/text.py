"""String column helpers: whitespace trim, blank tests, NULL tokens, title case, store names.

All helpers return Spark Columns built from built-in functions, so they stay inside
whole-stage code generation (or, for the title-case slow path, inside the JVM).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.schema import NULL_TOKENS, STORE_LOOKUP

# --------------------------------------------------------------------------------------
# The Unicode White_Space characters. TRIM in the warehouse dialect strips
# all of them; Spark's own trim() strips only U+0020.
# --------------------------------------------------------------------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --------------------------------------------------------------------------------------
# Word delimiters of the warehouse dialect's INITCAP (besides whitespace).
# --------------------------------------------------------------------------------------
INITCAP_PUNCTUATION = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'


def _char_class(chars: str) -> str:
    # Java regex: a backslash before any non-alphabetic character makes it literal.
    return "[" + "".join(ch if ch.isalnum() else "\\" + ch for ch in chars) + "]"


_DELIMITER_CLASS = _char_class(INITCAP_PUNCTUATION + WHITESPACE)
# Delimiters other than U+0020: when none is present, Spark's initcap() is exact.
_NON_SPACE_DELIMITER_CLASS = _char_class(INITCAP_PUNCTUATION + WHITESPACE.replace(" ", ""))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_OTHER_WHITESPACE = tuple(ch for ch in WHITESPACE if ch != " ")


def ws_trim(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace (not only spaces).

    Spark's trim() (spaces only) is several times faster than a trim with a character
    set, so the set is applied only when an edge character left by trim() is other
    whitespace (a tab, a no-break space, ...), which is rare.
    """
    t = F.trim(_col(c))
    edge = F.substring(t, 1, 1).isin(*_OTHER_WHITESPACE) | F.substring(t, -1, 1).isin(*_OTHER_WHITESPACE)
    return F.when(edge, F.btrim(t, F.lit(WHITESPACE))).otherwise(t)


def is_blank(c: Column | str) -> Column:
    """NULL, or empty after trimming: without a character that trimming leaves. Never NULL itself."""
    c = _col(c)
    return c.isNull() | ~c.rlike(f"[^{WHITESPACE}]")


def nullif_blank(c: Column | str) -> Column:
    """Trimmed value, with the empty string turned into NULL."""
    t = ws_trim(c)
    return F.when(t != F.lit(""), t)


def null_tokens_to_null(c: Column | str) -> Column:
    """Exact, case-sensitive, untrimmed NULL tokens ('' NA N/A null NULL) become NULL."""
    c = _col(c)
    return F.when(~c.isin(*NULL_TOKENS), c)


# Parts the texts of a packed row, and stands for a null among them.
PART, NULL_MARK = "\x01", "\x02"


def pack_texts(texts: Sequence[str]) -> list[Column]:
    """Text columns as a shuffle moves them in three fifths of the bytes: one text (_texts), in which sixteen bytes and padding go.

    Rows for which that would not be exact (a text with one of the marks) keep their columns (_odd).
    """
    whole = F.concat_ws("", *texts)
    odd = (F.instr(whole, PART) > 0) | (F.instr(whole, NULL_MARK) > 0)
    one = F.concat_ws(PART, *[F.coalesce(c, F.lit(NULL_MARK)) for c in texts])
    return [F.when(~odd, one).alias("_texts"), F.when(odd, F.struct(*texts)).alias("_odd")]


def unpacked_texts(texts: Sequence[str]) -> list[Column]:
    """The columns of ``pack_texts``, from its columns and ``_parts``, the parts of _texts."""
    return [
        F.when(F.col("_odd").isNotNull(), F.col(f"_odd.{c}")).otherwise(F.nullif(F.get("_parts", F.lit(i)), F.lit(NULL_MARK))).alias(c)
        for i, c in enumerate(texts)
    ]


def initcap_words(c: Column | str) -> Column:
    """Title case: lower-case everything, upper-case the first character of each word.

    Words are separated by whitespace and by the punctuation in INITCAP_PUNCTUATION.
    Spark's initcap() splits on U+0020 only, so it is used only where no other
    delimiter occurs; otherwise the string is split after every delimiter and each
    piece gets its first character upper-cased.
    """
    low = F.lower(_col(c))
    pieces = F.split(low, f"(?<={_DELIMITER_CLASS})")
    slow = F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))),
        "",
    )
    return F.when(low.rlike(_NON_SPACE_DELIMITER_CLASS), slow).otherwise(F.initcap(low))


def normalise_store(c: Column | str) -> Column:
    """Canonical store name: fixed lookup on the lower-cased trimmed name, else title case."""
    t = ws_trim(c)
    key = F.lower(t)
    out = None
    for canonical, variants in STORE_LOOKUP:
        cond = key.isin(*variants)
        out = F.when(cond, F.lit(canonical)) if out is None else out.when(cond, F.lit(canonical))
    return out.otherwise(initcap_words(t))


def normalise_product(c: Column | str) -> Column:
    """Product name as gold stores it: title case of the trimmed name."""
    return initcap_words(ws_trim(c))


__all__ = [
    "NULL_MARK",
    "PART",
    "WHITESPACE",
    "INITCAP_PUNCTUATION",
    "ws_trim",
    "is_blank",
    "nullif_blank",
    "null_tokens_to_null",
    "pack_texts",
    "unpacked_texts",
    "initcap_words",
    "normalise_store",
    "normalise_product",
]
