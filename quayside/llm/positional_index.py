"""Benchmark decontamination by a positional inverted index.

``write_index`` stores the postings of all training words: documents are dealt, whole, to
blocks of about BLOCK_WORDS words within their task; a block has a row per term with the
term's places in it, and a row per document with its first place. Between documents one
place stays free, so no phrase crosses them. ``matches`` looks up phrases:

1. the index's words are counted for the phrases' vocabulary; a phrase with a word that the
   index does not hold is done;
2. a phrase goes to the blocks that hold its rarest word;
3. in a block, the rarest word's places, less the word's offset in the phrase, are the
   candidate places; the lists of the other words, from the rarest on, thin them out. With
   ``slop`` the words may stand apart: in order, in at most ``slop`` words more than the
   phrase has (proximity); the match then runs from the first to the last of them.

Phrases are split into parts of PHRASES so that a block with a part of them fits one task
whatever the number of test texts. A block's memory is bounded by its words (one document,
if that is longer); a hot word is a row per block. Nothing but counts reaches the driver.

Words are runs of ASCII digits, letters A-Z in lower case, and everything beyond ASCII.
Null and empty texts have no words: they are in the index, with no hits. Test texts of fewer
than n words are one phrase, those without words none; rows without an id are left out, equal
phrases are looked up once, and an id that occurs more than once has the phrases of all its
rows. Rows of documents that are equal, or whose id is null, give a row each. Other columns
do not come through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path, ship_package

BLOCK_WORDS = 1 << 20
PHRASES = 1 << 18
#: Candidate places looked at in one step.
STEP = 1 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
INDEX_SCHEMA = "block long, term string, doc_id long, ordinal int, start long, n_words long, places binary"
HITS_SCHEMA = "block long, ordinal int, tag string, hits array<struct<start: long, end: long>>"


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []  # lower() of bytes is of A-Z


# ---- index -------------------------------------------------------------------------------------


def _block_rows(block: int, ids: list, words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    counts = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(counts + 1) - counts - 1
    n = len(ids)
    none = pa.nulls(n)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block), pa.int64()),
            none.cast(pa.string()),
            pa.array(ids, pa.int64()),
            pa.array(np.arange(n), pa.int32()),
            pa.array(begins, pa.int64()),
            pa.array(counts, pa.int64()),
            none.cast(pa.binary()),
        ],
        names,
    )
    tokens = np.empty(int(counts.sum()), object)
    tokens[:] = [w for doc in words for w in doc]
    if not len(tokens):
        return
    codes, terms = pd.factorize(tokens)
    places = (np.arange(len(tokens)) + np.repeat(np.arange(n), counts)).astype(np.int32)
    order = np.argsort(codes, kind="stable")
    sizes = np.bincount(codes)
    first = np.cumsum(sizes) - sizes
    gaps = np.diff(places[order], prepend=np.int32(0))  # steps pack better than places
    gaps[first] = places[order][first]
    for a in range(0, len(terms), 1 << 16):
        b = min(a + (1 << 16), len(terms))
        lo, hi = int(first[a]), int(first[b - 1] + sizes[b - 1])
        offsets = np.append(first[a:b], hi).astype(np.int64) - lo
        data = pa.Array.from_buffers(
            pa.large_binary(), b - a, [None, pa.py_buffer(offsets * 4), pa.py_buffer(np.ascontiguousarray(gaps[lo:hi]))]
        )
        empty = pa.nulls(b - a)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(b - a, block), pa.int64()),
                pa.array(terms[a:b].tolist(), pa.binary()).cast(pa.string()),
                empty.cast(pa.int64()),
                empty.cast(pa.int32()),
                empty.cast(pa.int64()),
                pa.array(sizes[a:b], pa.int64()),
                data.cast(pa.binary()),
            ],
            names,
        )


def write_index(docs: DataFrame, path: str) -> None:
    """Write the index of docs (doc_id, text): a row per document (term null) and per term of a block."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, words, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = words_of(text.as_py())
                if ids and size + len(found) > BLOCK_WORDS:
                    yield from _block_rows(block, ids, words)
                    block, ids, words, size = block + 1, [], [], 0
                ids.append(d)
                words.append(found)
                size += len(found)
        if ids:
            yield from _block_rows(block, ids, words)

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    rows.mapInArrow(build, INDEX_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


# ---- phrases -----------------------------------------------------------------------------------


def item_phrases(items: DataFrame, n: int) -> DataFrame:
    """(item_id, phrase): each n consecutive words of a test text, joined by blanks; all of it if it has fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                last = max(len(words) - n + 1, 1) if words else 0
                for a in range(0, last, 1 << 14):
                    found = [b" ".join(words[i : i + n]) for i in range(a, min(a + (1 << 14), last))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary()).cast(pa.string())], ["item_id", "phrase"]
                    )

    rows = items.where("item_id is not null").select(F.col("item_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "item_id long, phrase string")


def tagged_phrases(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((phrase, tag), (tag, item_id)) of distinct pairs (item_id, phrase): phrases of the same items share a tag.

    A tag is made of sums that take any number of items without gathering them: their
    number and two 64-bit sums of their hashes.
    """
    sums = [F.bit_xor(F.xxhash64(F.lit(seed), "item_id")).cast("string") for seed in (1, 2)]
    phrases = pairs.groupBy("phrase").agg(F.concat_ws(":", F.count("*").cast("string"), *sums).alias("tag"))
    one = phrases.groupBy("tag").agg(F.min("phrase").alias("phrase"))
    return phrases, one.join(pairs, "phrase").select("tag", "item_id")


# ---- search ------------------------------------------------------------------------------------


def _thin(keys: np.ndarray, codes, offsets, owner, place):
    """Candidates (phrase, place) that hold every word of their phrase, the rarest words first."""
    for r in range(codes.shape[1]):
        code = codes[owner, r]
        key = (code << 32) + place + offsets[owner, r]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        ok = (code < 0) | (keys[at] == key)  # code -1: the phrase has no more words
        owner, place = owner[ok], place[ok]
    return owner, place


def _chain(keys: np.ndarray, codes, length, owner, place, slop: int):
    """(phrase, first, end) of candidates whose words follow, each at its next occurrence, within slop."""
    last, alive = place.copy(), np.ones(len(place), bool)
    for k in range(1, codes.shape[1]):
        code = codes[owner, k]
        at = np.searchsorted(keys, (code << 32) + last + 1)
        here = np.minimum(at, len(keys) - 1)
        has = (at < len(keys)) & (keys[here] >> 32 == code)
        alive &= (code < 0) | has
        last = np.where((code >= 0) & has, keys[here] & 0xFFFFFFFF, last)
    alive &= last - place < length[owner] + slop
    return owner[alive], place[alive], last[alive] + 1


def _block_hits(left: pa.Table, right: pa.Table, slop: int):
    """(ordinal, tag, start, end) of every match in one block, places from the document's first word."""
    is_doc = left["term"].is_null().to_numpy(zero_copy_only=False)
    docs = left.filter(pa.array(is_doc))
    ordinal = docs["ordinal"].to_numpy()
    begin = docs["start"].to_numpy()
    by = np.argsort(begin, kind="stable")
    ordinal, begin, n_words = ordinal[by], begin[by], docs["n_words"].to_numpy()[by]
    held = left.filter(pa.array(~is_doc))
    number = {t: i for i, t in enumerate(held["term"].to_pylist())}
    lists = [np.cumsum(np.frombuffer(v.as_py(), np.int32), dtype=np.int64) for v in held["places"]]
    keys = np.concatenate([(i << 32) + v for i, v in enumerate(lists)])
    size = np.array([len(v) for v in lists])
    first = np.cumsum(size) - size
    rows = [
        (p.split(" "), t, o)
        for p, t, o in zip(right["phrase"].to_pylist(), right["tag"].to_pylist(), right["rarest"].to_pylist())
        if all(w in number for w in p.split(" "))
    ]
    found = []
    if rows:
        width = max(len(w) for w, _, _ in rows)
        rare, offsets, plain = (np.full((len(rows), width), v, np.int64) for v in (-1, 0, -1))
        length = np.array([len(w) for w, _, _ in rows])
        for i, (words, _, order) in enumerate(rows):
            plain[i, : len(words)] = [number[w] for w in words]
            rare[i, : len(words)] = plain[i, order]
            offsets[i, : len(words)] = order
        lead = rare[:, 0] if not slop else plain[:, 0]
        todo = np.cumsum(size[lead])
        a = 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(todo, (todo[a - 1] if a else 0) + STEP, "right")))
            n = size[lead[a:b]]
            owner = np.repeat(np.arange(a, b), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[lead[a:b]], n)
            place = keys[at] & 0xFFFFFFFF
            if not slop:
                owner, place = _thin(keys, rare, offsets, owner, place - offsets[owner, 0])
                found.append((owner, place, place + length[owner]))
            else:
                key = (rare[owner, 0] << 32) + place + offsets[owner, 0]  # the rarest word at its place or up to slop behind
                near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                ok = (keys[near] >= key) & (keys[near] <= key + slop)
                found.append(_chain(keys, plain, length, owner[ok], place[ok], slop))
            a = b
    owner, start, end = (np.concatenate(v) for v in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    doc = np.searchsorted(begin, start, "right") - 1
    inside = end <= begin[doc] + n_words[doc]
    owner, start, end, doc = owner[inside], start[inside], end[inside], doc[inside]
    tags, tag = np.unique(np.array([t for _, t, _ in rows], object), return_inverse=True) if rows else ([], owner)
    return ordinal[doc], tags, tag[owner], start - begin[doc], end - begin[doc]


def _merged(block: int, ordinal, tags, tag, start, end) -> pa.Table:
    """A row per document and tag, with its hits as stretches that do not meet."""
    order = np.lexsort((start, tag, ordinal))
    ordinal, tag, start, end = ordinal[order].astype(np.int64), tag[order], start[order], end[order]
    group = np.ones(len(order), bool)
    group[1:] = (ordinal[1:] != ordinal[:-1]) | (tag[1:] != tag[:-1])
    shift = np.cumsum(group) << 32  # ends of one group never reach into the next
    reach = np.maximum.accumulate(end + shift) if len(order) else end
    new = np.ones(len(order), bool)
    new[1:] = (start + shift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(order))[: len(at)] - 1
    head = group[at]
    offsets = np.append(np.flatnonzero(head), len(at)).astype(np.int32)
    hits = pa.StructArray.from_arrays([pa.array(start[at], pa.int64()), pa.array(reach[last] - shift[at], pa.int64())], ["start", "end"])
    of = at[head]
    return pa.table(
        {
            "block": pa.array(np.full(len(of), block), pa.int64()),
            "ordinal": pa.array(ordinal[of], pa.int32()),
            "tag": pa.array([tags[t] for t in tag[of]], pa.string()),
            "hits": pa.ListArray.from_arrays(pa.array(offsets), hits),
        }
    )


def matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """(block, ordinal, tag, hits) of every document that holds a phrase; phrases: phrase, tag; phrases occur once.

    hits: stretches [start, end) of the document's words that matches of phrases of this tag cover.
    """
    spark = index.sparkSession
    words = phrases.select("phrase", "tag", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    postings = index.where("term is not null").join(words.select("term").distinct(), "term", "left_semi")
    counts = postings.groupBy("term").agg(F.sum("n_words").alias("n"))
    by_rarity = F.array_sort(F.collect_list(F.struct("n", "offset", "term")))  # a phrase's words
    known = words.join(counts, "term").groupBy("phrase", "tag").agg(by_rarity.alias("w"))
    path = scratch_path(spark, "phrases")
    known.where(F.size("w") == F.size(F.split("phrase", " "))).select(
        "phrase", "tag", F.col("w.offset").alias("rarest"), F.col("w.term")[0].alias("term")
    ).write.parquet(path)
    live = spark.read.parquet(path)
    parts = max(1, -(-live.count() // PHRASES))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    asked = (
        live.join(postings.select("term", F.col("block").alias("at")), "term")
        .select("at", part.alias("part"), "phrase", "tag", "rarest")
        .groupBy("at", "part")
    )
    terms = live.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    rows = index.where("term is not null").join(terms, "term", "left_semi").unionByName(index.where("term is null"))
    held = rows.select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "term", "ordinal", "start", "n_words", "places"
    ).groupBy("block", "part")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return _merged(0, *[np.empty(0, np.int64)] * 5)
        return _merged(left["block"][0].as_py(), *_block_hits(left, right, slop))

    return held.cogroup(asked).applyInArrow(search, HITS_SCHEMA)


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, n_hit, items, n_items) of every row of docs: words that phrases of the items cover.

    ``items``: ids of items with a phrase in the document, sorted as text, joined by commas.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "positional-index")
    write_index(docs, path)
    index = read_index(spark, path)
    pairs_path = scratch_path(spark, "item-phrases")
    item_phrases(items, n).distinct().write.parquet(pairs_path)
    phrases, tag_items = tagged_phrases(spark.read.parquet(pairs_path))
    hits_path = scratch_path(spark, "phrase-hits")
    matches(index, phrases, slop).write.parquet(hits_path)
    hits = spark.read.parquet(hits_path)
    key = ["block", "ordinal"]
    covered = F.expr(
        "aggregate(array_sort(flatten(collect_list(hits))), struct(0L as n, 0L as reach), "
        "(a, h) -> struct(a.n + greatest(0L, h.end - greatest(h.start, a.reach)) as n, greatest(a.reach, h.end) as reach)).n"
    )
    counted = hits.groupBy(*key).agg(covered.alias("n_hit"))
    listed = hits.select(*key, "tag").distinct().join(tag_items, "tag").select(*key, F.col("item_id").cast("string").alias("item"))
    listed = listed.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("found"))
    rows = index.where("term is null").select(*key, "doc_id", "n_words")
    return rows.join(counted, key, "left").join(listed, key, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.array_join("found", ","), F.lit("")).alias("items"),
        F.coalesce(F.size("found").cast("long"), F.lit(0).cast("long")).alias("n_items"),
    )
