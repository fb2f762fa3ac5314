"""Packing by power-of-two decomposition.

Each document's ids (its text's ids, then an end id) are split into as many pieces of
``max_len`` as fit, then into the binary digits of the rest, longest first. A piece is a
sequence of its own: its length is a power of two, so it needs no padding and no
sequence crosses documents. Sequences of equal length form a bucket (``bucket`` is the
base-2 logarithm of the length); ``write_buckets`` stores each bucket in a folder.

Sequence ids are made from the bucket and Spark's row number within its partition, which
are the same if a lost partition is computed again. No shuffle, and nothing per key.

Defined results: null and empty texts are one piece, the end id; rows with equal or null
ids are packed like any other; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.spans import slices
from quayside.llm.word_ids import word_ids
from quayside.session import ship_package

END_ID = 1
MAX_LEN = 2048


def binary_pieces(tokens: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with so many tokens, in order."""
    docs = np.arange(len(tokens))
    full = tokens // max_len
    of, lengths = [np.repeat(docs, full)], [np.full(int(full.sum()), max_len, np.int64)]
    bit = max_len >> 1
    while bit:
        has = docs[(tokens & bit) > 0]
        of.append(has)
        lengths.append(np.full(len(has), bit, np.int64))
        bit >>= 1
    of, lengths = np.concatenate(of), np.concatenate(lengths)
    order = np.lexsort((-lengths, of))
    of, lengths = of[order], lengths[order]
    before = np.cumsum(lengths) - lengths
    first = np.searchsorted(of, of, side="left")
    return of, before - before[first], lengths


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, doc_tokens,
    ids (binary: little-endian unsigned 32-bit), bucket, sequence_id and offset (always 0)."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    ship_package(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_ids(tokenizer_file)
        for batch in slices(batches, "text", 4 << 20):
            ids, at = enc.encode_ended(batch.column(1), end_id)
            tokens = np.diff(at)
            of, start, length = binary_pieces(tokens, max_len)
            ends = np.append(0, np.cumsum(length))  # the pieces follow each other as the ids do
            binary = pa.Array.from_buffers(
                pa.large_binary(), len(of), [None, pa.py_buffer(4 * ends.astype(np.int64)), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(start), pa.array(length), pa.array(tokens[of]), binary.cast(pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    pieces = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    return (
        pieces.withColumn("bucket", F.log2("length").cast("int"))
        .withColumn("sequence_id", F.monotonically_increasing_id() * 64 + F.col("bucket"))
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences as Parquet, a folder per length."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)
