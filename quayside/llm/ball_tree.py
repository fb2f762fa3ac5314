"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Candidates are dealt into shards of about ``SHARD_ROWS`` rows, queries into blocks of about
``BLOCK_ROWS``; a cell is one block against one shard. Within a cell a ball tree is built
on the shard; a node's upper bound for a query is <q, centre> + |q| * radius, and a
leaf's is the least on its path. Each query opens leaves by falling bound, and no leaf
whose bound is below its current k-th score.

The k-th score is shared: first each block searches its home shard; the k-th score found
there goes with the query to all other shards, as the score below which nothing is
opened or returned. The best of all shards are then merged by rank. Equal scores go to
the smaller id: leaves are cut off only when strictly below.

Components are floor(scale * x) as double; sums below 2^53 are exact in double, larger
ones are computed, and ranked, as Python integers, also those of components whose product
with the scale is beyond a double. Only the column score is held at the limits of a long.

Defined results: rows with null id, null or empty vectors, or null or non-finite
components take no part; queries meet candidates of the same dimension; a query's own
id is never its result, repeated rows of other ids are results of their own; a query
without candidates has no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path, ship_package

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 128
BEST_FIRST_ROUNDS = 3
_LONG = 2**63 - 1
#: Bits of a row's place beside its score; a shard of more rows (copies of one id) is searched in parts.
PLACE_BITS = 21
#: Rank of scores within a long; "a" and "p" begin those below and beyond it.
_WITHIN = "m"


def ball_tree(x: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """(order, leaves, nodes): row order; (start, end, path of node numbers) of leaves; centres; radii."""
    order, leaves, centres, radii = np.arange(len(x)), [], [], []
    stack = [(0, len(x), ())]
    while stack:
        a, b, path = stack.pop()
        rows = x[order[a:b]]
        centre = rows.mean(axis=0)
        apart = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        centres.append(centre)
        radii.append(apart.max())
        path = (*path, len(radii) - 1)
        if b - a <= leaf_rows or radii[-1] == 0:
            leaves.append((a, b, path))
            continue
        one = rows[np.argmax(apart)]
        other = rows[np.argmax(((rows - one) ** 2).sum(axis=1))]
        along = np.argsort(rows @ (other - one), kind="stable")
        order[a:b] = order[a:b][along]
        mid = (a + b) // 2
        stack += [(a, mid, path), (mid, b, path)]
    return order, leaves, np.array(centres), np.array(radii)


def search(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int):
    """The k best of x for each row of q, not below floor: (row of q, id, score, over) arrays."""
    n = len(x_ids)
    if n > 1 << PLACE_BITS:
        cuts = range(0, n, 1 << PLACE_BITS)
        parts = [search(q, q_ids, floor, x[a : a + (1 << PLACE_BITS)], x_ids[a : a + (1 << PLACE_BITS)], k) for a in cuts]
        return _best(*(np.concatenate(v) for v in zip(*parts)), k)
    by_id = np.argsort(x_ids, kind="stable")
    x, x_ids = x[by_id], x_ids[by_id]
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) >= 2.0 ** (62 - PLACE_BITS):
        return _search_big(_ints(q, 1), q_ids, floor, _ints(x, 1), x_ids, k)
    order, leaves, centres, radii = ball_tree(x)
    norms = np.sqrt((q**2).sum(axis=1))
    bound = q @ centres.T + norms[:, None] * radii[None, :]
    bound += 1e-9 * (1.0 + np.abs(bound))
    reach = np.stack([bound[:, path].min(axis=1) for _, _, path in leaves], axis=1)
    # score and place in one number: greater is better, and of equal scores the smaller id
    lowest = np.int64(-(2**62))
    best = np.full((len(q), k), lowest)
    kth = floor.astype(np.float64)

    def open_leaf(leaf: int, rows: np.ndarray) -> None:
        a, b, _ = leaves[leaf]
        at = order[a:b]
        score = (q[rows] @ x[at].T).astype(np.int64)
        key = score * (1 << PLACE_BITS) + (n - 1 - at)[None, :]
        key[(score < kth[rows][:, None]) | (x_ids[at][None, :] == q_ids[rows][:, None])] = lowest
        merged = np.concatenate([best[rows], key], axis=1)
        if merged.shape[1] > k:
            merged = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
        best[rows] = merged
        least = merged.min(axis=1)
        kth[rows] = np.where(least > lowest, np.maximum(kth[rows], least >> PLACE_BITS), kth[rows])
        reach[rows, leaf] = -np.inf

    for _ in range(min(BEST_FIRST_ROUNDS, len(leaves))):
        first = reach.argmax(axis=1)
        going = reach.max(axis=1) >= kth
        for leaf in np.unique(first[going]):
            open_leaf(leaf, np.flatnonzero(going & (first == leaf)))
    for leaf in np.argsort(-reach.max(axis=0, initial=-np.inf)):
        rows = np.flatnonzero((reach[:, leaf] >= kth) & np.isfinite(reach[:, leaf]))
        if len(rows):
            open_leaf(leaf, rows)
    row, col = np.nonzero(best > lowest)
    key = best[row, col]
    ids = x_ids[n - 1 - (key & ((1 << PLACE_BITS) - 1))]
    return row, ids, key >> PLACE_BITS, np.full(len(row), _WITHIN, object)


def _best(row, ids, scores, over, k: int):
    """The k best of each row: by score, then what is beyond a long, then the smaller id."""
    _, rank = np.unique(over.astype(str), return_inverse=True)
    order = np.lexsort((ids, -rank, -scores, row))
    row, ids, scores, over = row[order], ids[order], scores[order], over[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], ids[kept], scores[kept], over[kept]


def _beyond(score: int) -> str:
    """Text that sorts scores beyond a long as their numbers do."""
    if abs(score) <= _LONG:
        return _WITHIN
    digits = f"{abs(score):x}"
    text = f"{len(digits):08x}{digits}"
    if score > 0:
        return "p" + text
    return "a" + text.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def _search_big(q, q_ids, floor, x, x_ids, k):
    """As search, for lists of integers whose products may be inexact in double."""
    found = []
    for i, (vector, own) in enumerate(zip(q, q_ids)):
        each = ((sum(map(int.__mul__, vector, r)), int(d)) for r, d in zip(x, x_ids) if d != own)
        for score, d in sorted(each, key=lambda s: (-s[0], s[1]))[:k]:
            held = max(-_LONG, min(_LONG, score))
            if held >= floor[i]:
                found.append((i, d, held, _beyond(score)))
    row, ids, scores = (np.array([f[c] for f in found], np.int64) for c in range(3))
    return row, ids, scores, np.array([f[3] for f in found], object)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as double; infinite where that is beyond a double."""
    with np.errstate(over="ignore"):
        return np.floor(x * scale)


def _ints(x: np.ndarray, scale: int) -> list[list[int]]:
    """floor(scale * x) of finite doubles as integers; beyond 2^53 a double has no fraction."""
    return [[int(np.floor(c * scale)) if abs(c) < 2.0**53 else int(c) * scale for c in r] for r in x.tolist()]


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates.

    is_query: a condition on the column ``vec_id`` that tells the query rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    if scale & (scale - 1) == 0:  # the fraction that floor() drops need not travel; halving and doubling are exact
        v = F.transform(v, lambda c: F.when(F.abs(c * scale) < 2.0**52, F.floor(c * scale) / F.lit(float(scale))).otherwise(c))
    ready = vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("dim")
    )
    counts = ready.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).head()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block_rows))
    rows = ready.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(shards)))
    queries = ready.where(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(blocks)))
    block_list = F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")
    cells = rows.withColumn("block", F.explode(block_list))

    # a block's home shard
    home = F.pmod(F.col("block"), F.lit(shards))
    first = (
        queries.withColumn("shard", home)
        .groupBy("dim", "shard", "block")
        .cogroup(cells.where(F.col("shard") == home).groupBy("dim", "shard", "block"))
        .applyInArrow(
            lambda q, x: _home(q, x, k, scale),
            "vec_id long, v array<double>, dim int, block long, floor long, found array<struct<vec_id: long, score: long, over: string>>",
        )
    )
    where = scratch_path(spark, "top-k")
    first.write.parquet(where)  # the shared k-th scores; read by the second search and by the merge
    first = spark.read.parquet(where)
    hits = first.select(F.col("vec_id").alias("query_id"), F.inline("found"))
    if shards > 1:
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>"), lambda s: s != home)
        rest = (
            first.drop("found")
            .withColumn("shard", F.explode(others))
            .groupBy("dim", "shard", "block")
            .cogroup(cells.where(F.col("shard") != home).groupBy("dim", "shard", "block"))
            .applyInArrow(lambda q, x: _others(q, x, k, scale), "query_id long, vec_id long, score long, over string")
        )
        hits = hits.unionByName(rest)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("over"), "vec_id")
    return hits.select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _found(q: pa.Table, x: pa.Table, floor: np.ndarray, k: int, scale: int):
    ids = q["vec_id"].to_numpy()
    if not q.num_rows or not x.num_rows:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, object)
    q_raw, x_raw, x_ids = _matrix(q["v"]), _matrix(x["v"]), x["vec_id"].to_numpy()
    q_whole, x_whole = _whole(q_raw, scale), _whole(x_raw, scale)
    if np.isfinite(q_whole).all() and np.isfinite(x_whole).all():
        return search(q_whole, ids, floor, x_whole, x_ids, k)
    return _search_big(_ints(q_raw, scale), ids, floor, _ints(x_raw, scale), x_ids, k)


def _home(q: pa.Table, x: pa.Table, k: int, scale: int) -> pa.Table:
    n = q.num_rows
    row, ids, scores, over = _found(q, x, np.full(n, -(2.0**63)), k, scale)
    order = np.argsort(row, kind="stable")
    row, ids, scores, over = row[order], ids[order], scores[order], over[order]
    per = np.bincount(row, minlength=n)
    floor = np.full(n, -(2**63), np.int64)
    full = per >= k
    least = np.full(n, 2**63 - 1, np.int64)
    np.minimum.at(least, row, scores)
    floor[full] = least[full]
    columns = [pa.array(ids), pa.array(scores), pa.array(over.tolist(), pa.string())]
    found = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(per)).astype(np.int32)), pa.StructArray.from_arrays(columns, ["vec_id", "score", "over"])
    )
    own = q.select(["vec_id", "v", "dim", "block"])
    return own.append_column("floor", pa.array(floor)).append_column("found", found)


def _others(q: pa.Table, x: pa.Table, k: int, scale: int) -> pa.Table:
    floor = q["floor"].to_numpy() if q.num_rows else np.zeros(0)
    row, ids, scores, over = _found(q, x, floor, k, scale)
    found = pa.array(over.tolist(), pa.string())
    return pa.table({"query_id": q["vec_id"].to_numpy()[row], "vec_id": ids, "score": scores, "over": found})
