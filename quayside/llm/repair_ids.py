"""Token-id files compressed by Re-Pair grammars, with random-access decoding.

Documents are ranged and sorted by id; each partition writes shards of at most
``SHARD_TOKENS`` ids (a longer document has a shard of its own), each with its own grammar:
the most frequent adjacent id pairs are replaced by nonterminals, again and again, until no
pair has ``MIN_COUNT`` uses left. A round counts all pairs exactly and replaces a pair wherever
it ranks above the pairs that overlap it: by uses, then by a hash of the pair, so that the equally
frequent pairs of a repeated passage shrink together; of a pair that overlaps itself ("aaaa"),
every second use counts, from the left of its run. The first pair in rank is replaced wherever it
is used, others if they have ``MIN_USES`` uses of their own in the round (fewer would not
pay for the rule). No pair crosses a document's end.

A shard (one Parquet row, column ``payload``) is

    b"RPID", u32 version, documents, rules, symbols, first nonterminal, bytes a symbol; u64 tokens
    i64 document ids, u8 id is present; u32 symbols and u32 tokens before each document, and the total
    u32 crc32 of each document's symbols; u32 left, u32 right, u32 expansion length of each rule
    3 bytes a symbol (4 where ids or rules need them), little-endian
    u32 crc32 of all that but the symbols

so that one document, or a range of its ids, is decoded from its own symbols alone: the
expansion lengths tell which symbols and which rules below them hold the range, and only
these are expanded; only its own symbols are checked. A nonterminal is its rule's number plus the first
nonterminal. Ids and nonterminals stay below 2^32; a shard beyond is a ValueError.

Defined results: a null or empty text is stored as the end id alone; null ids come first
and equal ids follow each other by text, like any other row; an empty table gives no
shards; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.spans import slices
from quayside.llm.word_ids import word_ids
from quayside.session import ship_package

END_ID = 2
SHARD_TOKENS = 1 << 20
MIN_COUNT = 48
MIN_USES = 8
SLOT_BITS = 18
PARTITION_ROWS = 1 << 16
_HEAD = struct.Struct("<4sIIIIIIQ")
_MIX = np.uint64(0x9E3779B97F4A7C15)
SHARD_SCHEMA = "part int, shard int, tokens_before long, n_docs long, n_tokens long, payload binary"


def _mixed(key: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs."""
    x = (key ^ key >> np.uint64(29)) * _MIX
    return (x ^ x >> np.uint64(32)) * _MIX


def _every_second(at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of uses that overlap one of the same pair, the first, third, ... of each run; all others."""
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (key[1:] != key[:-1])
    first = np.flatnonzero(begins)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return place % 2 == 0


def number_pairs(key: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key, distinct keys). A slot's last key is told by its slot; others are sorted."""
    owner = np.zeros(1 << SLOT_BITS, np.uint64)
    owner[slot] = key
    own = owner[slot] == key
    used = np.zeros(1 << SLOT_BITS, bool)
    used[slot] = True
    place = np.cumsum(used) - 1
    rest, other = np.unique(key[~own], return_inverse=True)
    number = place[slot]
    number[~own] = int(used.sum()) + other
    return number, np.concatenate([owner[used], rest])


def frequent_pairs(s: np.ndarray, asked: np.ndarray, min_count: int):
    """(places, number of the pair at each, uses of each pair, pairs, places to ask again): the uses of
    pairs with min_count uses at least, among the pairs that begin at the places asked.

    Counts by hash slot leave out most rare pairs first; the rest are counted exactly.
    """
    key = s[asked] << np.uint64(32) | s[asked + 1]
    slot = (key * _MIX >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    some = np.bincount(slot, minlength=1 << SLOT_BITS)[slot] >= min_count
    again, key, slot = asked[some], key[some], slot[some]
    counted = _every_second(again, key)
    at = again[counted]
    number, pairs = number_pairs(key[counted], slot[counted])
    uses = np.bincount(number, minlength=len(pairs))
    frequent = uses[number] >= min_count
    return at[frequent], number[frequent], uses, pairs, again


def re_pair(ids: np.ndarray, last: np.ndarray, first_rule: int, min_count: int = MIN_COUNT):
    """(symbols, last-of-document flags, left, right): the ids with frequent pairs replaced.

    After the first round only places whose pair was frequent, or that touch a new nonterminal, are
    asked: no other pair gains uses.
    """
    s, last, left, right = ids.astype(np.uint64), last.copy(), [], []
    n_rules, asked = 0, np.flatnonzero(~last)
    while len(asked):
        at, number, uses, pairs, again = frequent_pairs(s, asked, min_count)
        if not len(at):
            break
        rank = np.empty(len(pairs), np.int64)
        rank[np.lexsort((_mixed(pairs), uses))] = np.arange(len(pairs))
        r, beside = rank[number], np.diff(at) == 1  # beside: overlaps the next use
        wins = np.ones(len(at), bool)
        wins[1:] &= ~beside | (r[1:] > r[:-1])
        wins[:-1] &= ~beside | (r[:-1] > r[1:])
        own = np.bincount(number[wins], minlength=len(pairs))
        wins &= (own[number] >= min(MIN_USES, min_count)) | (r == r.max())
        at, number = at[wins], number[wins]
        named = np.zeros(len(pairs), bool)
        named[number] = True
        left.append(pairs[named] >> np.uint64(32))
        right.append(pairs[named] & np.uint64(0xFFFFFFFF))
        s[at] = (first_rule + n_rules + np.cumsum(named) - 1)[number].astype(np.uint64)
        last[at] = last[at + 1]
        ask = np.zeros(len(s), bool)
        ask[again] = ask[at] = True
        ask[np.maximum(at, 1) - 1] = True
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s, last, ask = s[keep], last[keep], ask[keep]
        asked = np.flatnonzero(ask & ~last)
        n_rules += int(named.sum())
    none = np.zeros(0, np.uint64)
    parts = (np.concatenate(x or [none]).astype(np.int64) for x in (left, right))
    return s.astype(np.int64), last, *parts


def expansion_lengths(left: np.ndarray, right: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids that each rule stands for. A rule's parts come before it."""
    lens = np.ones(1 + len(left), np.int64)  # lens[0]: an id
    a, b = (np.maximum(x - first_rule + 1, 0) for x in (left, right))
    done = 0
    while done < len(left):  # as far as parts are known: one pass a round of replacement
        ready = np.maximum(a[done:], b[done:]) > done
        upto = done + (int(np.argmax(ready)) if ready.any() else len(ready))
        lens[1 + done : 1 + upto] = lens[a[done:upto]] + lens[b[done:upto]]
        done = upto
    return lens[1:]


def pack_shard(doc_ids: list, tokens: np.ndarray, ids: np.ndarray, min_count: int = MIN_COUNT) -> bytes:
    """The bytes of a shard: documents with so many ids each."""
    first_rule = int(ids.max()) + 1
    last = np.zeros(len(ids), bool)
    last[np.cumsum(tokens) - 1] = True
    symbols, last, left, right = re_pair(ids, last, first_rule, min_count)
    if max(first_rule + len(left), len(ids)) > 0xFFFFFFFF:
        raise ValueError("a shard's ids, rules or length do not fit 32 bits")
    width = 3 if first_rule + len(left) <= 1 << 24 else 4
    ends = np.append(0, np.flatnonzero(last) + 1)
    data = np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()
    checks = [zlib.crc32(memoryview(data)[width * a : width * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    head = _HEAD.pack(b"RPID", 2, len(doc_ids), len(left), len(symbols), first_rule, width, len(ids)) + b"".join(
        x.tobytes()
        for x in (
            np.array([0 if d is None else d for d in doc_ids], "<i8"),
            np.array([d is not None for d in doc_ids], np.uint8),
            ends.astype("<u4"),
            np.append(0, np.cumsum(tokens)).astype("<u4"),
            np.array(checks, "<u4"),
            left.astype("<u4"),
            right.astype("<u4"),
            expansion_lengths(left, right, first_rule).astype("<u4"),
        )
    )
    return head + data + struct.pack("<I", zlib.crc32(head))


@dataclass
class Shard:
    """A shard's parts, read in place."""

    doc_ids: list
    symbol_at: np.ndarray
    token_at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    all_lens: np.ndarray  # of an id, then of each rule
    first_rule: int
    checks: np.ndarray
    data: memoryview
    width: int
    expanded: int = 0  # rules expanded so far

    @classmethod
    def read(cls, payload: bytes) -> "Shard":
        magic, version, docs, rules, n, first_rule, width, _ = _HEAD.unpack_from(payload)
        if magic != b"RPID" or version != 2:
            raise ValueError("not a shard of token ids")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        ids, present = take("<i8", docs), take("u1", docs)
        symbol_at, token_at = take("<u4", docs + 1).astype(np.int64), take("<u4", docs + 1).astype(np.int64)
        checks = take("<u4", docs)
        left, right, lens = (take("<u4", rules).astype(np.int64) for _ in range(3))
        view = memoryview(payload)
        if zlib.crc32(view[:at]) != struct.unpack("<I", payload[-4:])[0] or len(payload) != at + width * n + 4:
            raise ValueError("a shard's checksum is wrong")
        doc_ids = [int(d) if p else None for d, p in zip(ids, present)]
        return cls(doc_ids, symbol_at, token_at, left, right, np.append(1, lens), first_rule, checks, view[at : at + width * n], width)

    def doc_symbols(self, k: int, upto: int | None = None) -> np.ndarray:
        """Symbols of document k, or of documents k to ``upto`` - 1, after their checksums."""
        upto = k + 1 if upto is None else upto
        for d in range(k, upto):
            if zlib.crc32(self.data[self.width * self.symbol_at[d] : self.width * self.symbol_at[d + 1]]) != self.checks[d]:
                raise ValueError("a document's checksum is wrong")
        n = int(self.symbol_at[upto] - self.symbol_at[k])
        wide = np.zeros((n, 4), np.uint8)
        own = np.frombuffer(self.data, np.uint8, self.width * n, self.width * int(self.symbol_at[k]))
        wide[:, : self.width] = own.reshape(n, self.width)
        return wide.view("<u4").ravel().astype(np.int64)

    @property
    def symbols(self) -> np.ndarray:
        return self.doc_symbols(0, len(self.doc_ids))

    def _lengths(self, symbols: np.ndarray) -> np.ndarray:
        return self.all_lens[np.maximum(symbols - (self.first_rule - 1), 0)]

    def _expand(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids start to stop - 1 of these symbols. A pass writes the ids among the symbols to their
        places and goes on with the two parts of each nonterminal that holds some of the range."""
        n = stop - start
        out = np.empty(n, "<u4")
        lens = self._lengths(symbols)
        at = np.cumsum(lens) - lens - start
        while len(symbols):
            inside = (at + lens > 0) & (at < n)
            if not inside.all():
                symbols, at = symbols[inside], at[inside]
            rules = symbols >= self.first_rule
            ids = ~rules
            out[at[ids]] = symbols[ids]
            rule, at = symbols[rules] - self.first_rule, at[rules]
            self.expanded += len(rule)
            a = self.left[rule]
            symbols, at = np.concatenate([a, self.right[rule]]), np.concatenate([at, at + self._lengths(a)])
            lens = self._lengths(symbols)
        return out

    def ids(self) -> np.ndarray:
        """All ids of the shard."""
        return self._expand(self.symbols, 0, int(self.token_at[-1]))

    def document(self, k: int, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids start to start + length of document k, from its symbols and the rules that hold them."""
        tokens = int(self.token_at[k + 1] - self.token_at[k])
        stop = tokens if length is None else min(tokens, start + length)
        if start >= stop:
            return np.zeros(0, "<u4")
        return self._expand(self.doc_symbols(k), start, stop)


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts and write their ids as shards, in ascending id order.

    The number of range partitions grows with the rows (a Parquet table's footers have their
    count); a task holds a shard at a time, however long its texts are. Rows of one id (null ids,
    too) are split by how their texts begin.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // PARTITION_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = word_ids(tokenizer_file), TaskContext.get().partitionId()
        shard = before = held = 0
        doc_ids, tokens, ids = [], [], []

        def flush():
            nonlocal shard, before, held, doc_ids, tokens, ids
            counts, flat = np.concatenate(tokens), np.concatenate(ids)
            row = [[part], [shard], [before], [len(doc_ids)], [len(flat)], [pack_shard(doc_ids, counts, flat)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            shard, before, held, doc_ids, tokens, ids = shard + 1, before + len(flat), 0, [], [], []
            names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in slices(batches, "text"):
            flat, at = enc.encode_ended(batch.column(1), end_id)
            keys = batch.column(0).to_pylist()
            a = 0
            while a < len(keys):
                b = int(np.searchsorted(at, at[a] + shard_tokens - held, side="right")) - 1
                if b <= a:
                    if held:
                        yield flush()
                        continue
                    b = a + 1
                doc_ids += keys[a:b]
                tokens.append(np.diff(at[a : b + 1]))
                ids.append(flat[at[a] : at[b]])
                held += int(at[b] - at[a])
                a = b
        if held:
            yield flush()

    ordered = (
        docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
        .repartitionByRange(parts, F.col("doc_id"), F.substring("text", 1, 32))
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(run, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the shards: doc_id, start (ids of all documents before it),
    n_tokens and ids (binary: little-endian unsigned 32-bit).

    Only the totals of the range partitions (one for 65,536 rows, or the shuffle partitions)
    pass the driver, to be summed in order.
    """
    ship_package(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    base, before = {}, 0
    for row in sorted(totals):
        base[row["part"]] = before
        before += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ahead, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = Shard.read(payload)
                ids, at = shard.ids(), shard.token_at
                binary = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(4 * at), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(base[part] + ahead + at[:-1]),
                        pa.array(np.diff(at)),
                        binary.cast(pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return shards.select("part", "tokens_before", "payload").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary"
    )
