"""Prefix trie of conversations, by collapsing whole sequences.

1. A conversation's turns become one sequence: a digest of role and text (128 bits of
   SHA-256) and a word count for every turn.
2. Equal sequences are grouped into one with a weight, its smallest conv_id and its end list.
3. All prefixes of the distinct sequences are aggregated once; sequences that are a proper
   prefix of another are dropped by an anti join, and what is left are the leaves.
4. A sequence *owns* the nodes of which it holds the smallest conv_id: they are the lower end
   of its path, from ``own_depth`` on. So weighted prefixes, aggregated a second time, sum
   everything: conversations (weights), children (one for the sequence that owns the next
   node), leaves, and the words below a node, once for every conversation, less once for
   every owned node.

Every group is summed map-side, so the root or a first turn that all share costs no more
than others; a parent's id is joined only for the topmost owned node of a sequence (that of
the root is a number), which adaptive execution splits for a hot parent. End lists are
hashed in blocks of a range of ids, read in order with one block at a time. A conversation
is one row of 20 bytes a turn.

Turns are ordered by turn (null first), then role, then the text's digest; null role or text
is empty. Rows without a conv_id are left out. Repeated rows are turns of their own. A
conversation whose rebuilt sequence has no turns ends at the root. No rows give no nodes, not
even a root. Other columns do not come through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import scratch_path, ship_package

#: Bytes of a turn in a sequence: digest, then the number of words.
DIGEST, TURN = 16, 20
ROOT = bytes(DIGEST)
#: A block of an end list is a range of 2^END_BITS conv_ids.
END_BITS = 14
#: Rows of prefixes handed on at once.
STEP = 1 << 16

FIRST_SCHEMA = "key binary, parent_key binary, depth long, conv_id long, interior boolean"
SECOND_SCHEMA = (
    "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string"
)


# ---- sequences -----------------------------------------------------------------------------------


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, sequence) of conversations (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    code = F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(words), 2 * (TURN - DIGEST), "0"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn"), role.alias("role"), code.alias("code")).alias("t")
    )
    ordered = F.sort_array(F.collect_list("t"))  # null turns first
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t["code"]), "")).alias("sequence"))


def shared_openings(seqs: DataFrame, group: int = 20, kinds: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group of ids.

    The first h = crc32(conv_id) % kinds turns of conversation ``conv_id - conv_id % group``
    (all if fewer, none if it is absent), then the own turns after the first h.
    """
    opening = seqs.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.substring("sequence", 1, (kinds - 1) * TURN).alias("opening")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % kinds).cast("int") * TURN
    based = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(opening, "base", "left")
    own = F.col("sequence").substr(h + 1, F.length("sequence"))
    first = F.coalesce(F.col("opening").substr(F.lit(1), h), F.lit(b""))
    return based.select("conv_id", F.concat(first, own).alias("sequence"))


# ---- prefixes ------------------------------------------------------------------------------------


def prefix_keys(sequence: bytes) -> list[bytes]:
    """Keys of a sequence's prefixes, the root's first: each hashes the one before and a turn."""
    keys = [ROOT]
    for a in range(0, len(sequence), TURN):
        keys.append(hashlib.sha256(keys[-1] + sequence[a : a + DIGEST]).digest()[:DIGEST])
    return keys


def _binary(keys: list[bytes]) -> pa.Array:
    return pa.array(keys, pa.binary())


def _end_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [prefix_keys(s.as_py())[-1] for s in batch.column(0)]
        yield pa.RecordBatch.from_arrays([*batch.columns, _binary(found)], [*batch.schema.names, "end_key"])


def _in_steps(rows: Iterator[dict], schema: str) -> Iterator[pa.RecordBatch]:
    """The columns of each sequence's prefixes, joined and cut into batches of about STEP rows."""
    arrow = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v for r in held for v in r[name]], arrow[kind]) for name, kind in fields], [name for name, _ in fields]
        )

    for row in rows:
        for a in range(0, len(row["key"]), STEP):
            held.append({k: v[a : a + STEP] for k, v in row.items()})
            size += len(held[-1]["key"])
            if size >= STEP:
                yield batch()
                held, size = [], 0
    if held:
        yield batch()


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for sequence, conv in zip(batch.column("sequence").to_pylist(), batch.column("conv_id").to_pylist()):
                keys = prefix_keys(sequence)
                n = len(keys)
                yield {
                    "key": keys,
                    "parent_key": [None, *keys[:-1]],
                    "depth": range(n),
                    "conv_id": [conv] * n,
                    "interior": [True] * (n - 1) + [False],
                }

    return _in_steps(rows(), FIRST_SCHEMA)


def _second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for r in batch.to_pylist():
                keys, conv = prefix_keys(r["sequence"]), r["conv_id"]
                n = len(keys)
                own = n if r["own_depth"] is None else r["own_depth"]  # n: owns none
                turns = np.frombuffer(r["sequence"], np.uint8).reshape(-1, TURN)[:, DIGEST:]
                words = np.ascontiguousarray(turns).view(">u4").ravel().astype(np.int64)
                below = np.append(np.cumsum(words[::-1])[::-1], 0)  # words of turn d and after
                below = np.append(below[0], below)  # by depth, the root as its first turn; none past the end
                depth = np.arange(n)
                yield {
                    "key": keys,
                    "depth": depth,
                    "conv_id": [conv] * n,
                    "parent_conv_id": [None if d < own else r["parent_conv_id"] if d == own else conv for d in range(n)],
                    "n_convs": [r["weight"]] * n,
                    "n_children": ((depth + 1 >= own) & (depth + 1 < n)).astype(np.int64),
                    "n_leaves": [int(r["leaf"])] * n,
                    "saved_tokens": r["weight"] * below[depth] - below[np.maximum(depth, own)],
                    "ends": [None] * (n - 1) + [r["ends"]],
                }

    return _in_steps(rows(), SECOND_SCHEMA)


# ---- end lists -----------------------------------------------------------------------------------


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's blocks, joined by commas; blocks come in order, a key's in one task."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("end_key"), batch.column("ids")):
            k, ids = k.as_py(), ids.as_py().encode()
            if k != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(key, state.hexdigest())])


def _digest_rows(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["end_key", "ends"]
    )


def end_digests(ended: DataFrame) -> DataFrame:
    """(end_key, ends) of (end_key, conv_id): the SHA-256 of each key's ids, ascending, joined by commas."""
    ship_package(ended.sparkSession)
    block = F.shiftright("conv_id", END_BITS).alias("block")
    blocks = ended.groupBy("end_key", block).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    return blocks.repartition("end_key").sortWithinPartitions("end_key", "block").mapInArrow(_list_digests, "end_key binary, ends string")


# ---- trie ----------------------------------------------------------------------------------------


def trie(seqs: DataFrame) -> DataFrame:
    """A row per node of the trie of (conv_id, sequence); conv_ids occur once.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends (SHA-256 of the ids that end here).
    """
    spark = seqs.sparkSession
    ship_package(spark)

    def stored(name: str, rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        return spark.read.parquet(path)

    keyed = stored("sequences", seqs.select("sequence", "conv_id").mapInArrow(_end_keys, "sequence binary, conv_id long, end_key binary"))
    distinct = stored(
        "distinct-sequences",
        keyed.groupBy("sequence", "end_key").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")),
    )
    prefixes = distinct.select("sequence", "conv_id").mapInArrow(_first, FIRST_SCHEMA)
    nodes = stored(
        "trie-nodes",
        prefixes.groupBy("key", "parent_key", "depth").agg(F.min("conv_id").alias("conv_id"), F.bool_or("interior").alias("interior")),
    )
    leaves = distinct.join(nodes.where("interior").select(F.col("key").alias("end_key")), "end_key", "left_anti")
    least = distinct.agg(F.min("conv_id")).head()[0]
    top = F.min(F.struct("depth", "parent_key")).alias("top")
    heads = nodes.groupBy("conv_id").agg(top).select("conv_id", F.col("top.depth").alias("own_depth"), F.col("top.parent_key").alias("key"))
    parents = nodes.where("depth > 0").select("key", F.col("conv_id").alias("parent_conv_id"))
    owners = (
        heads.where("own_depth > 1")
        .join(parents, "key")
        .unionByName(heads.where("own_depth <= 1").withColumn("parent_conv_id", F.when(F.col("own_depth") == 1, F.lit(least).cast("long"))))
        .drop("key")
    )
    weighted = (
        distinct.join(leaves.select("end_key", F.lit(True).alias("leaf")), "end_key", "left")
        .join(owners, "conv_id", "left")
        .join(end_digests(keyed.select("end_key", "conv_id")), "end_key")
        .select("sequence", "conv_id", "weight", F.coalesce("leaf", F.lit(False)).alias("leaf"), "own_depth", "parent_conv_id", "ends")
    )
    nothing = F.lit(hashlib.sha256().hexdigest())
    return (
        weighted.mapInArrow(_second, SECOND_SCHEMA)
        .groupBy("key", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("parent_conv_id").alias("parent_conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.coalesce(F.max("ends"), nothing).alias("ends"),
        )
        .drop("key")
    )
