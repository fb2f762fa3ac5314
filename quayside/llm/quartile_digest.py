"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Three kinds of byte triplets (positions i, i+3, i+7; i, i+5, i+9; i, i+4, i+11) of a
text's UTF-8 bytes, padded with eleven zero bytes, are hashed into 256 buckets and counted.
Each bucket is coded by two bits: the number of the text's three count quartiles that
its count exceeds. Bytes that stand apart say less about the language and more about the
text than neighbouring ones do. The fingerprint is 128 hex digits of codes, then two of
the length code, 8 * log2(1 + bytes), at most 255.

The difference of two fingerprints sums the distance of their bucket codes, and their
length codes' distance, at most LENGTH_CAP; likeness is 1 - difference / greatest difference.

``edited_pairs`` compares each document with an edited text (its last quarter replaced by
the start of the next document, in id order) and with the next document. Documents are
cut into id ranges, each of which gets the first document of the next range as well, and
run through in order, one row at a time; texts travel compressed.

Defined results: null text counts as empty; an empty text has n_chars 0 and the digest
of the padding; equal ids follow each other by text; null ids come first; a single
document is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.spans import slices, text_buffer
from quayside.session import ship_package

BUCKETS = 256
TRIPLETS = ((3, 7), (5, 9), (4, 11))
REACH = 11
LENGTH_CAP = 64
MOST = 3 * BUCKETS + LENGTH_CAP


@lru_cache(maxsize=1)
def _tables() -> np.ndarray:
    """A 16-bit number for each kind of triplet, place in it, and byte: multiples of odd numbers, mixed."""
    n = np.arange(len(TRIPLETS) * 3 * 256, dtype=np.uint64) + np.uint64(1)
    n *= np.uint64(0x9E3779B97F4A7C15)
    n ^= n >> np.uint64(31)
    n *= np.uint64(0xBF58476D1CE4E5B9)
    return (n >> np.uint64(48)).astype(np.uint16).reshape(len(TRIPLETS), 3, 256)


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BUCKETS + 1) codes of the texts data[offsets[i] : offsets[i + 1]]."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    padded = np.zeros(len(data) + REACH * n, np.uint8)
    at = offsets + REACH * np.arange(n + 1)
    place = np.ones(len(padded), bool)
    ends = (at[1:, None] - 1 - np.arange(REACH)).ravel()
    place[ends] = False
    padded[place] = data
    tables, out = _tables(), np.empty((n, BUCKETS + 1), np.uint8)
    counts = np.zeros((n, BUCKETS), np.int64)
    of = np.repeat(np.arange(n) * BUCKETS, sizes)
    for (second, third), table in zip(TRIPLETS, tables):
        m = len(padded) - REACH
        h = table[0][padded[:m]]
        h += table[1][padded[second : m + second]]
        h += table[2][padded[third : m + third]]
        h *= np.uint16(40503)
        h >>= np.uint16(8)
        counts += np.bincount(of + h[place[:m]], minlength=n * BUCKETS).reshape(n, BUCKETS)
    order = np.sort(counts, axis=1)
    out[:, :BUCKETS] = 0
    for quarter in (1, 2, 3):
        out[:, :BUCKETS] += counts > order[:, quarter * BUCKETS // 4 - 1][:, None]
    out[:, BUCKETS] = np.minimum(255, (8 * np.log2(1.0 + sizes)).astype(np.int64))
    return out


def fingerprints(code: np.ndarray) -> list[str]:
    """Codes as hex text."""
    c = code[:, :BUCKETS].reshape(len(code), -1, 4)
    packed = c[:, :, 0] << 6 | c[:, :, 1] << 4 | c[:, :, 2] << 2 | c[:, :, 3]
    return [row.tobytes().hex() for row in np.concatenate([packed, code[:, BUCKETS:]], axis=1)]


def unpack(marks: list[str]) -> np.ndarray:
    """Codes of fingerprints."""
    raw = np.frombuffer(bytes.fromhex("".join(marks)), np.uint8).reshape(len(marks), BUCKETS // 4 + 1)
    c = np.stack([raw[:, :-1] >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(marks), BUCKETS)
    return np.concatenate([c, raw[:, -1:]], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - difference / greatest difference of codes, row by row."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    return 1.0 - (apart[:, :BUCKETS].sum(1) + np.minimum(LENGTH_CAP, apart[:, BUCKETS])) / MOST


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint and ztext (the text, compressed) of whole texts."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text", 2 << 20):
            data, offsets = text_buffer(batch.column(1))
            starts = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            raw = data.tobytes()
            cut = offsets.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(starts[offsets])),
                    pa.array(fingerprints(codes(data, offsets))),
                    pa.array([squeeze.compress(raw[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                ],
                ["doc_id", "n_chars", "fingerprint", "ztext"],
            )

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string, ztext binary"
    )


def edited_pairs(docs: DataFrame, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next document.

    Returns doc_id, n_chars, edited_text (binary, UTF-8), fingerprint, edited_fingerprint, near_edited,
    near_next. Only range bounds (at most ``parts``; default spark.sql.shuffle.partitions) and
    each range's first id pass the driver.
    """
    spark = docs.sparkSession
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(docs[id_col].cast("long").alias("doc_id"))
    cuts = [k / parts for k in range(1, parts)]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", F.lit(cuts or [0.5]), F.lit(100 * parts))).head()[0] or [])) if cuts else []
    part = F.lit(0)
    if bounds:  # the number of bounds at or below the id: a binary search by nested conditions
        part = _place(F.col("doc_id"), bounds, 0, len(bounds))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part)
    firsts = ids.groupBy(part.alias("part")).agg(
        F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls")
    )
    firsts = sorted((r["part"], None if r["nulls"] else r["first"]) for r in firsts.collect())
    marked = fingerprint(docs, id_col, text_col).withColumn("part", part)
    if not firsts:
        copies = F.array(F.struct(F.col("part"), F.lit(False).alias("ahead")))
    else:
        # a range's first document also ends the range before it; the very first ends the last
        before = {f: firsts[k - 1][0] for k, (_, f) in enumerate(firsts)}
        to = F.when(F.col("doc_id").isNull(), F.lit(before.get(None)).cast("int"))
        known = [x for f, b in before.items() if f is not None for x in (F.lit(f), F.lit(b))]
        if known:
            to = to.otherwise(F.try_element_at(F.create_map(*known), F.col("doc_id")))
        own = F.struct(F.col("part"), F.lit(False).alias("ahead"))
        copies = F.filter(F.array(own, F.struct(to.alias("part"), F.lit(True).alias("ahead"))), lambda c: c["part"].isNotNull())
    rows = marked.withColumn("copy", F.explode(copies)).select(
        F.col("copy.part").alias("part"), F.col("copy.ahead").alias("ahead"), "doc_id", "n_chars", "fingerprint", "ztext"
    )
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "ahead", "doc_id", F.length("ztext"), "ztext")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        held, queue, size, closed = None, [], 0, None

        def out():
            own, nxt, edited = zip(*queue)
            raw = b"".join(edited)
            offsets = np.append(0, np.cumsum([len(e) for e in edited])).astype(np.int64)
            code = codes(np.frombuffer(raw, np.uint8), offsets)
            mine = unpack([o[2] for o in own])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in own], pa.int64()),
                    pa.array([o[1] for o in own], pa.int64()),
                    pa.array(edited, pa.binary()),
                    pa.array([o[2] for o in own]),
                    pa.array(fingerprints(code)),
                    pa.array(likeness(mine, code)),
                    pa.array(likeness(mine, unpack([x[2] for x in nxt]))),
                ],
                ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            ztexts = batch.column(5)
            for k, (p, ahead, *doc) in enumerate(zip(*columns)):
                if ahead and closed == p:
                    continue  # another row of the next range's first id
                now = (*doc, unzip.decompress(ztexts[k].as_py()).decode(), p)
                if held is not None and held[4] == p:
                    cut = held[1] // 4
                    edited = (held[3][: held[1] - cut] + now[3][:cut]).encode()
                    queue.append((held, now, edited))
                    size += len(edited) + 2000
                    if size > 2 << 20:
                        yield out()
                        queue, size = [], 0
                held, closed = (None, p) if ahead else (now, None)
        if queue:
            yield out()

    return rows.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_text binary, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _place(x, bounds: list, low: int, high: int):
    """Column: how many of the sorted bounds[low:high] are at most x, plus low."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(x >= bounds[mid], _place(x, bounds, mid + 1, high)).otherwise(_place(x, bounds, low, mid))
