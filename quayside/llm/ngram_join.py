"""N-gram Jaccard self-join of documents by vertical partitioning.

A document's set is its distinct n-word shingles, as 64-bit hashes. Documents with equal
sets are one class from the start: copies are not compared.

1. Order. The shingles are cut by hash range into parts of a bounded number; a part
   holds its piece of every document and counts, by itself, in how many different sets
   each n-gram occurs. The global n-gram order is by that count, then hash. Only n-grams
   of two sets or more leave the parts.
2. Candidates. Sets that reach the threshold share one of their first
   n - ceil(percent * n / 100) + 1 n-grams of the order. Most documents have that many
   n-grams of their own, and are done. The others are joined, by n-gram, to the
   smallest of its documents: a star, not all pairs.
3. Groups. Connected components of these stars hold every linking pair. A small one
   is a cell; a large one is cut by size bucket and hashed blocks, and its cells are the
   pairs of blocks whose sizes can link. No task gets more than two blocks.
4. Counting. In a cell, the overlaps of each fragment of the n-gram order are counted by
   themselves (a matrix product, or the pairs of a rare n-gram), and summed per pair. Of
   the pairs that reach the threshold a spanning forest is returned, not the pairs.
5. Components of these links give each document its class.

Defined results: null texts, and texts without words, have no n-grams and link with
nothing; texts of fewer words than n have one n-gram, the whole sequence; null ids are
in no class (component null) and link nothing; rows with equal ids count as one document
in links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.components import connected_components
from quayside.llm.spans import slices, text_buffer
from quayside.session import scratch_path, ship_package

N = 3
PERCENT = 90
#: N-grams of a part of the order; bits of a hash that tell n-grams apart there (taking two for one costs
#: a candidate, and loses none).
PART_GRAMS = 3_000_000
GRAM_BITS = 48
BLOCK_DOCS = 512
BLOCK_TOKENS = 400_000
RARE = 6
FRAGMENT_CELLS = 4 << 20
BROADCAST_BYTES = 64 << 20

_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_ODD = [_U((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) | 1) for k in range(12)]
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[ord(c) for c in ascii_uppercase]] = [ord(c) for c in ascii_lowercase]
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x *= _MIX[0]
    x ^= x >> _U(27)
    x *= _MIX[1]
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[0])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per document): each document's distinct shingles in ascending order."""
    docs = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    word = ~_BREAK[data]
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets[:-1]] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | begin[1:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    letters = _BYTE[_FOLD[data]]
    letters[~word] = 0
    sizes = np.diff(np.append(at, len(data)))
    lead = np.arange(at[0], len(data)) - np.repeat(at, sizes)
    power = np.cumprod(np.full(int(lead.max()) + 1, _ODD[1]))
    words = mix(np.add.reduceat(letters[at[0] :] * power[lead], at - at[0]))
    doc = np.searchsorted(offsets, at, side="right") - 1
    count = np.bincount(doc, minlength=docs)
    # a shingle starts at each word that has n - 1 after it, or at the first word of a short text
    rank = np.arange(len(at)) - (np.cumsum(count) - count)[doc]
    starts = np.flatnonzero((rank + n <= count[doc]) | (rank == 0))
    held = np.minimum(n, count[doc[starts]] - rank[starts])
    joined = held.astype(np.uint64) * _ODD[2]
    for k in range(n):
        there = held > k
        joined[there] += words[starts[there] + k] * _ODD[3 + k]
    hashes, of = mix(joined), doc[starts]
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1]))
    hashes, of = hashes[new], of[new]
    return hashes, np.append(0, np.cumsum(np.bincount(of, minlength=docs)))


def size_buckets(percent: int, limit: int = 1 << 31) -> list[int]:
    """Smallest sizes of buckets wide enough that a linking set is in the same or the next one."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, -(-out[-1] * 101 // percent)))
    return out


def _planes(*arrays: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: planes of zeros cost nothing."""
    raw = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in arrays]
    head = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(raw))


def _from_planes(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    k = int(np.frombuffer(raw, "<u4", 1)[0])
    at, out = 4 + 4 * k, []
    for n in np.frombuffer(raw, "<u4", k, 4).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view("<u8").ravel())
        at += 8 * n
    return out


def _ranges(values: np.ndarray, parts: int) -> np.ndarray:
    """Places where each of so many equal ranges of sorted GRAM_BITS numbers begins, and the end."""
    number = (values >> _U(24)) * _U(parts) >> _U(GRAM_BITS - 24)
    return np.searchsorted(number, np.arange(parts + 1, dtype=np.uint64))


def part_blocks(hashes: np.ndarray, offsets: np.ndarray, marks: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, block) of sets: the n-grams of each hash range in order, with the set that each belongs to, and
    the sets' digests and sizes. marks: the digest of each set; of equal sets one is taken."""
    _, first = np.unique(marks, return_index=True)
    taken = np.zeros(len(marks), bool)
    taken[first] = True
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(len(marks)), sizes)
    mine = taken[of]
    grams, of = hashes[mine] >> _U(64 - GRAM_BITS), of[mine]
    order = np.argsort(grams, kind="stable")
    grams, of = grams[order], of[order]
    bounds = _ranges(grams, parts).tolist()
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            used, place = np.unique(of[a:b], return_inverse=True)
            steps = np.diff(grams[a:b], prepend=_U(0))
            yield part, _planes(marks[used].view(np.uint64), sizes[used], steps, place)


def read_part(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, digest of the set of each, size of the set of each) of a part's blocks."""
    out = []
    for block in blocks:
        marks, sizes, steps, place = _from_planes(block)
        place = place.astype(np.int64)
        out.append((np.cumsum(steps, dtype=np.uint64), marks[place], sizes[place]))
    return tuple(np.concatenate(x) for x in zip(*out))


def shared_blocks(grams: np.ndarray, marks: np.ndarray, sizes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket of sets, block) of a part: the sets' n-grams that other sets hold, too, with the number of those sets."""
    order = np.argsort(grams, kind="stable")
    grams, marks, sizes = grams[order], marks[order], sizes[order]
    again = np.zeros(len(grams), bool)
    same = grams[1:] == grams[:-1]
    again[1:] |= same
    again[:-1] |= same
    grams, marks, sizes = grams[again], marks[again], sizes[again]
    order = np.lexsort((marks, grams))
    grams, marks, sizes = grams[order], marks[order], sizes[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (marks[1:] != marks[:-1])
    grams, marks, sizes = grams[new], marks[new], sizes[new]
    start = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
    runs = np.diff(np.append(start, len(grams)))
    counts = np.repeat(runs, runs)
    order = np.argsort(marks, kind="stable")
    order = order[counts[order] > 1]
    grams, marks, sizes, counts = grams[order], marks[order], sizes[order], counts[order]
    bounds = _ranges(marks >> _U(64 - GRAM_BITS), buckets).tolist()
    for bucket, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            first = np.flatnonzero(np.append(True, marks[a + 1 : b] != marks[a : b - 1]))
            each = np.diff(np.append(first, b - a))
            yield bucket, _planes(marks[a:b][first], sizes[a:b][first], each, grams[a:b], counts[a:b])


def choose_prefixes(blocks: list[bytes], percent: int) -> tuple[list[int], list[np.ndarray]]:
    """(digests, prefixes) of a bucket's sets that hold enough shared n-grams to link: those of the first
    n - ceil(percent * n / 100) + 1 n-grams of the order that are shared."""
    read = [_from_planes(b) for b in blocks]
    marks = np.concatenate([np.repeat(m, e.astype(np.int64)) for m, _, e, _, _ in read])
    sizes = np.concatenate([np.repeat(z, e.astype(np.int64)) for _, z, e, _, _ in read]).astype(np.int64)
    grams, counts = np.concatenate([r[3] for r in read]), np.concatenate([r[4] for r in read])
    order = np.lexsort((grams, counts, marks))
    marks, sizes, grams = marks[order], sizes[order], grams[order].astype(np.int64)
    start = np.flatnonzero(np.append(True, marks[1:] != marks[:-1])[: len(marks)])
    held = np.diff(np.append(start, len(marks)))
    need = (sizes[start] * percent + 99) // 100
    chosen = np.flatnonzero(held >= need)
    first = (held - need + 1)[chosen].tolist()
    at = start[chosen].tolist()
    return marks[start[chosen]].view(np.int64), [grams[a : a + k] for a, k in zip(at, first)]


def _segment_digest(hashes: np.ndarray, offsets: np.ndarray, odd: np.uint64) -> np.ndarray:
    c = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes * odd), out=c[1:])
    return mix((c[offsets[1:]] - c[offsets[:-1]]) ^ np.diff(offsets).astype(np.uint64)).view(np.int64)


def cell_links(ids: np.ndarray, side: np.ndarray, tokens: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(id, smallest id of its linked group) within a cell. Pairs are of one side, 0, or across sides."""
    n = len(ids)
    sizes = np.array([len(t) for t in tokens])
    flat, row = np.concatenate(tokens), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    df = np.diff(np.append(start, len(flat)))
    overlap = np.zeros((n, n), np.int64)
    for d in range(2, RARE + 1):  # n-grams of few documents: their pairs
        at = start[df == d]
        holders = row[at[:, None] + np.arange(d)]
        for i in range(d):
            for j in range(i + 1, d):
                overlap += np.bincount(holders[:, i] * n + holders[:, j], minlength=n * n).reshape(n, n)
    overlap += overlap.T
    shared = np.flatnonzero(df > RARE)
    width = max(1, FRAGMENT_CELLS // n)
    for a in range(0, len(shared), width):  # a fragment of the n-gram order
        grams = shared[a : a + width]
        held = np.zeros((n, len(grams)), np.float32)
        counts = df[grams]
        places = np.repeat(start[grams] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        held[row[places], np.repeat(np.arange(len(grams)), counts)] = 1
        overlap += (held @ held.T).astype(np.int64)  # exact: a fragment has far fewer than 2^24 n-grams
    both = sizes[:, None] + sizes[None, :]
    linked = (overlap > 0) & (100 * overlap >= percent * (both - overlap))
    if side.any():
        linked &= side[:, None] != side[None, :]
    out, free = [], np.ones(n, bool)
    for k in np.argsort(ids, kind="stable").tolist():  # the smallest id of a group comes first
        if not free[k]:
            continue
        free[k] = False
        wave = np.array([k])
        while len(wave):
            wave = np.flatnonzero(linked[wave].any(axis=0) & free)
            free[wave] = False
            out += [(int(ids[w]), int(ids[k])) for w in wave]
    return out


def jaccard_classes(
    docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), one row per document."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            hashes, off = shingle_sets(*text_buffer(batch.column(1)), n)
            digests = [pa.array(_segment_digest(hashes, off, odd)) for odd in _ODD[10:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(off)), *digests], ["doc_id", "n_shingles", "d1", "d2"])

    where = scratch_path(spark, "ngram-sets")
    texts.mapInArrow(sets, "doc_id long, n_shingles long, d1 long, d2 long").write.parquet(where)
    found = spark.read.parquet(where)

    where = scratch_path(spark, "ngram-classes")
    found.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles")
    ).write.parquet(where)
    classes = spark.read.parquet(where)

    prefixes = _prefixes(texts, classes, n, percent)
    signs = prefixes.select("rep", F.explode("prefix").alias("sign"))
    met = signs.groupBy("sign").agg(F.min("rep").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    stars = signs.join(met, "sign").where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    groups = connected_components(stars)
    cells = _cells(classes, groups, percent)

    members = spark.read.parquet(cells)
    rows = members.count()
    if rows * 200 <= BROADCAST_BYTES:
        members = F.broadcast(members)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            hashes, off = shingle_sets(*text_buffer(batch.column(1)), n)
            same = (_segment_digest(hashes, off, _ODD[10]) == batch.column(2).to_numpy()) & (
                _segment_digest(hashes, off, _ODD[11]) == batch.column(3).to_numpy()
            )
            at = off.astype(np.int64) * 8
            binary = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(at), pa.py_buffer(hashes)])
            out = [batch.column(0), binary.cast(pa.binary()), batch.column(4)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "tokens", "cells"]).filter(pa.array(same))

    cell_type = T.ArrayType(T.StructType([T.StructField("cell", T.LongType()), T.StructField("side", T.IntegerType())]))
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("tokens", T.BinaryType()), T.StructField("cells", cell_type)]
    )

    def links(cell: pa.Table) -> pa.Table:
        ids, side = cell["doc_id"].to_numpy(), cell["side"].to_numpy()
        held = [np.frombuffer(b, np.uint64) for b in cell["tokens"].to_pylist()]
        pairs = cell_links(ids, side, held, percent) if len(held) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    joined = (
        texts.join(members, texts["doc_id"] == members["rep"])
        .select("doc_id", "text", "d1", "d2", "cells")
        .mapInArrow(tokens, schema)
        .select("doc_id", "tokens", F.inline("cells"))
        .groupBy("cell")
        .applyInArrow(links, "a long, b long")
    )
    where = scratch_path(spark, "ngram-links")
    joined.write.parquet(where)
    reached = connected_components(spark.read.parquet(where))

    where = scratch_path(spark, "ngram-components")
    classes.select("d1", "d2", "rep").join(reached, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component")
    ).write.parquet(where)
    known = found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("d1")).alias("d1"), "d2")
    return known.join(spark.read.parquet(where), ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )


def _prefixes(texts: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(rep, prefix): what the first n-grams of the order hold of n-grams that other sets hold, too, of the
    classes that have any there."""
    spark = texts.sparkSession
    total = classes.agg(F.sum("n_shingles")).head()[0] or 0
    parts = int(max(1, -(-total // PART_GRAMS)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            hashes, off = shingle_sets(*text_buffer(batch.column(0)), n)
            rows = list(part_blocks(hashes, off, _segment_digest(hashes, off, _ODD[10]), parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["part", "block"]
            )

    def count(part: pa.Table) -> pa.Table:
        rows = list(shared_blocks(*read_part(part["block"].to_pylist()), parts))
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()), "block": pa.array([b for _, b in rows], pa.binary())})

    def choose(bucket: pa.Table) -> pa.Table:
        marks, prefixes = choose_prefixes(bucket["block"].to_pylist(), percent)
        return pa.table({"mark": marks, "prefix": pa.array(prefixes, pa.list_(pa.int64()))})

    where = scratch_path(spark, "ngram-prefixes")
    texts.where("doc_id is not null").select("text").mapInArrow(blocks, "part int, block binary").groupBy("part").applyInArrow(
        count, "bucket int, block binary"
    ).groupBy("bucket").applyInArrow(choose, "mark long, prefix array<long>").write.parquet(where)
    chosen = spark.read.parquet(where)
    return chosen.join(classes, chosen["mark"] == classes["d1"]).select("rep", "prefix")


def keep_first(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns unchanged, with one document of each class: the one with the smallest
    doc_id. Of rows with that id one stays; rows with a null id are in no class and stay."""
    spark = docs.sparkSession
    where = scratch_path(spark, "ngram-classes-of")
    jaccard_classes(docs, n, percent).write.parquet(where)
    classes = spark.read.parquet(where)
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = classes.where("doc_id = component_id")
    counts = kept.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).head()
    if gone.count() * 16 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    out = docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
    if counts["rows"] > counts["ids"]:  # repeated ids: then, and only then, texts are shuffled
        known = out.where("doc_id is not null").dropDuplicates(["doc_id"])
        out = known.unionByName(out.where("doc_id is null"))
    return out


def _cells(classes: DataFrame, groups: DataFrame, percent: int) -> str:
    """Path of (rep, d1, d2, cells): the cells that each class's tokens go to."""
    spark = classes.sparkSession
    roots = groups.select(F.col("component").alias("node"), "component").distinct()
    nodes = groups.unionByName(roots)
    # the place of a size among the bucket bounds
    bounds = [b for b in size_buckets(percent) if b < 1 << 31]
    bucket = F.aggregate(F.array(*map(F.lit, bounds)), F.lit(0), lambda acc, b: acc + (b <= F.col("n_shingles")).cast("int"))
    rows = classes.select("rep", "d1", "d2", "n_shingles").join(nodes, F.col("rep") == F.col("node")).select(
        "rep", "d1", "d2", "component", "n_shingles", bucket.alias("bucket")
    )
    where = scratch_path(spark, "ngram-groups")
    rows.write.parquet(where)
    rows = spark.read.parquet(where)
    sizes = rows.groupBy("component", "bucket").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("t"))
    by_bucket = sizes.groupBy("component").agg(
        F.sum("c").alias("docs"),
        F.sum("t").alias("tokens"),
        F.map_from_entries(
            F.collect_list(  # at most one entry a bucket
                F.struct("bucket", F.ceil(F.greatest(F.col("c") / BLOCK_DOCS, F.col("t") / BLOCK_TOKENS)).cast("int").alias("blocks"))
            )
        ).alias("blocks"),
    )
    where = scratch_path(spark, "ngram-blocks")
    by_bucket.write.parquet(where)
    by_bucket = spark.read.parquet(where)

    blocks = lambda b: F.coalesce(F.try_element_at("blocks", b), F.lit(0))
    upto = lambda c: F.when(c > 0, F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))
    own = F.col("bucket")
    block = F.pmod(F.xxhash64("rep", "d1"), blocks(own)).cast("int")

    def cell(b, i, c, j, side):
        return F.struct(F.xxhash64("component", b, i, c, j).alias("cell"), side.cast("int").alias("side"))

    within = F.transform(
        upto(blocks(own)), lambda j: cell(own, F.least("block", j), own, F.greatest("block", j), (F.col("block") > j))
    )
    above = F.transform(upto(blocks(own + 1)), lambda j: cell(own, F.col("block"), own + 1, j, F.lit(0)))
    below = F.transform(upto(blocks(own - 1)), lambda i: cell(own - 1, i, own, F.col("block"), F.lit(1)))
    whole = (F.col("docs") <= BLOCK_DOCS) & (F.col("tokens") <= BLOCK_TOKENS)
    one = F.array(F.struct(F.xxhash64("component").alias("cell"), F.lit(0).alias("side")))
    dealt = rows.join(by_bucket, "component").withColumn("block", block)
    path = scratch_path(spark, "ngram-cells")
    dealt.select("rep", "d1", "d2", F.when(whole, one).otherwise(F.concat(within, above, below)).alias("cells")).write.parquet(path)
    return path
