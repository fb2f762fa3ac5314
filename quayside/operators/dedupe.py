"""First-row-per-key marking (ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) > 1).

The default ``aggregate`` method never gathers one key's rows into one task: the first
row of every key is found with ``min(struct(order..., row id))`` (partially aggregated
on the map side, so a key holding a third of all rows costs the same as any other).
The first rows become bitmaps, a bit per row for every 32,768 places of a file, which are
written to scratch storage and joined back by file and place: the rows themselves are not
shuffled while the bitmaps, by their count, can be broadcast (some 500 million rows), and
beyond that no join key has more than 32,768 of them. NULL keys form one group, as in a window
partition.

The ``window`` method is the literal row_number formulation, kept for small inputs
and for comparison; it sorts each key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quayside.functions.hashing import hash_bytes, hash_text
from quayside.session import checkpoint_root, drops_shuffles, scratch_path

ROW_ID_COLUMNS = ("_rid_file", "_rid_row")

#: The order column that holds hex digests.
HASH_COLUMN = "_row_hash"
#: Rows of a bitmap: the bits of Spark's bitmap functions.
BITMAP_ROWS = 32_768
#: Bitmaps up to this many bytes are broadcast to the rows.
BROADCAST_BYTES = 64 << 20


def with_row_ids(df: DataFrame) -> DataFrame:
    """Add a unique row id that is stable under recomputation.

    For a file scan this is (file path, row index in file), read from the hidden
    ``_metadata`` column, so a lost executor recomputes the same ids. Other inputs are
    checkpointed to the shared checkpoint folder first, which fixes their row order.
    """
    try:
        return df.withColumns(
            {
                ROW_ID_COLUMNS[0]: F.col("_metadata.file_path"),
                ROW_ID_COLUMNS[1]: F.col("_metadata.row_index"),
            }
        )
    except AnalysisException as e:
        if "_metadata" not in str(e):
            raise
        checkpoint_root(df.sparkSession)  # registers the shared folder if it is not yet
        fixed = df.checkpoint(eager=True)
        return fixed.withColumns(
            {
                ROW_ID_COLUMNS[0]: F.lit("checkpoint"),
                ROW_ID_COLUMNS[1]: F.monotonically_increasing_id(),
            }
        )


def mark_later_rows(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    flag: str,
    method: str = "aggregate",
    kept: DataFrame | None = None,
    taken: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """Add boolean ``flag``: True for every row except the first per ``key``.

    Rows are ordered by ``order_by`` ascending with NULLs first; the row id breaks
    full ties, so exactly one row per key is first. ``df`` must carry the row id
    columns (``with_row_ids``). ``kept`` (the ``order_by`` columns of rows that were
    chosen before) puts those rows ahead of all others, so a later run over more rows
    does not choose anew; a NULL in them matches nothing. All rows of the keys in ``taken``
    (one column) are later ones. The bitmaps are written to ``path``, by default a scratch
    folder: as long as it is there, the marked rows can be read often and the order is found once.
    """

    def ordered(rows: DataFrame) -> tuple[DataFrame, list[str]]:
        if kept is None:
            return rows, [*order_by, *ROW_ID_COLUMNS]
        marks = kept.select(*order_by).distinct().withColumn("_kept", F.lit(True))
        rows = rows.join(marks, list(order_by), "left").withColumn("_new", F.col("_kept").isNull()).drop("_kept")
        return rows, ["_new", *order_by, *ROW_ID_COLUMNS]

    if method == "window":
        rows, order = ordered(df)
        w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        later = F.row_number().over(w) > 1
        if taken is not None:
            rows = rows.join(_keys(taken).withColumn("_old", F.lit(True)), F.col(key).eqNullSafe(F.col("_taken")), "left")
            later = later | F.col("_old").isNotNull()
        return rows.withColumn(flag, later).select(*df.columns, flag)
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")

    # GROUP BY keeps all NULL keys in one group, as a window partition does.
    rows, order = ordered(df.select(key, *order_by, *ROW_ID_COLUMNS))
    firsts = first_rows(rows, key, order)
    if taken is not None:
        firsts = firsts.join(_keys(taken), F.col(key).eqNullSafe(F.col("_taken")), "left_anti")
    marks = first_row_bitmaps(
        firsts.select(*[f"_first.{c}" for c in ROW_ID_COLUMNS]), path or scratch_path(df.sparkSession, "first-rows")
    )
    return rows_in(df, marks, flag).withColumn(flag, ~F.col(flag))


def rows_in(df: DataFrame, marks: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: whether the bitmaps (``first_row_bitmaps``) have the row."""
    file, row = ROW_ID_COLUMNS
    place = F.col(row).bitwiseAND(F.lit(BITMAP_ROWS - 1))
    word = F.get("_words", F.shiftright(place, 6).cast("int"))
    bit = place.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))  # a bitmap's bytes count from the word's high end
    is_in = F.call_function("getbit", word, bit.cast("int")) == 1
    return (
        df.withColumn("_block", _block(row))
        .join(marks, (F.col(file) == F.col("_file")) & (F.col("_block") == F.col("_in")), "left")
        .withColumn(flag, F.coalesce(is_in, F.lit(False)))
        .select(*df.columns, flag)
    )


def first_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, _first): the least of the order columns' struct per key.

    Row hashes in lower-case hex are shuffled as their bytes, which have the same order in half the
    size; rows with any other hash (or none) have a minimum of their own, and the lesser of the two is first.
    """
    if HASH_COLUMN not in order:
        return rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    code = F.col("_code")
    packed = F.struct(*[code.alias(c) if c == HASH_COLUMN else F.col(c) for c in order])
    found = rows.withColumn("_code", hash_bytes(HASH_COLUMN)).groupBy(key).agg(
        F.min(F.when(code.isNotNull(), packed)).alias("_packed"), F.min(F.when(code.isNull(), F.struct(*order))).alias("_plain")
    )
    plain = [(hash_text(f"_packed.{c}") if c == HASH_COLUMN else F.col(f"_packed.{c}")).alias(c) for c in order]
    unpacked = F.when(F.col("_packed").isNotNull(), F.struct(*plain))
    return found.select(key, F.least(unpacked, "_plain").alias("_first"))


def _keys(taken: DataFrame) -> DataFrame:
    return taken.select(F.col(taken.columns[0]).alias("_taken")).distinct()


def _block(row: str) -> Column:
    return F.shiftright(F.col(row), BITMAP_ROWS.bit_length() - 1)


@drops_shuffles
def first_row_bitmaps(firsts: DataFrame, path: str) -> DataFrame:
    """(_file, _in, _words): a bit per row of every block of a file, set for these row ids; written to ``path`` once."""
    file, row = ROW_ID_COLUMNS
    place = F.col(row).bitwiseAND(F.lit(BITMAP_ROWS - 1))
    blocks = firsts.groupBy(F.col(file).alias("_file"), _block(row).alias("_in")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP_ROWS // 64 - 1)),
        lambda i: F.conv(F.hex(F.substring("_bits", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"),
    )
    blocks = blocks.select("_file", "_in", words.alias("_words"))
    blocks.write.parquet(path)
    stored = firsts.sparkSession.read.schema(blocks.schema).parquet(path)
    return F.broadcast(stored) if bitmaps_fit(firsts.sparkSession, path) else stored


def bitmaps_fit(spark: SparkSession, path: str) -> bool:
    """Whether stored bitmaps are broadcast to the rows, which then are marked without a shuffle."""
    return spark.read.schema("_file string").parquet(path).count() * (BITMAP_ROWS // 8 + 256) <= BROADCAST_BYTES


__all__ = ["ROW_ID_COLUMNS", "bitmaps_fit", "first_rows", "first_row_bitmaps", "rows_in", "with_row_ids", "mark_later_rows"]
