"""Periodic runs of words, by internal pattern matching.

A run of period q is a stretch of words in which words q apart are equal, q being its
smallest period, that no neighbouring word extends, of at least ``max(min_words, 2 * q)``
words. The documents of some Arrow batches are one sequence of word numbers that differ
between documents; per such sequence

* prefix doubling sorts the suffixes; the class of every block of 2^k words is kept, so that
  two places are compared forwards and backwards by halving steps;
* a dyadic block of m words asks for its own occurrences in the neighbouring window, that is
  at distances 2m-1 to 4m-2: range successors in a wavelet matrix over its stretch of the
  suffix array. A run of a period in this range holds a whole block within its first period,
  and that block again a period on. Blocks of four words serve all short periods but 6
  (a run has twelve words at least), blocks of two serve period 6;
* occurrences that lie closer than half a block go on in steps of the block's own period;
  such a progression's end is computed, not searched. A progression that belongs to the
  same smaller-period stretch as the block has no new period; of others each term is one;
* a candidate is extended to both sides. Candidates of the same stretch keep the smallest
  period, which is the stretch's own (periods that fit twice are multiples of the smallest).

Documents do not meet, so there is no shuffle; a task holds BATCH_WORDS words, or one
document that is longer. Null and empty texts have no words and no runs; a null doc_id is
kept; equal rows give equal results; other columns do not come through. ``min_words`` is
twelve at least, as the block sizes rest on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import ship_package

#: Words worked on at once.
BATCH_WORDS = 1 << 18
MIN_WORDS = 12

SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, n_words long, collapsed string"


# ---- suffix array with the classes of dyadic blocks -------------------------------------------


def block_classes(symbols: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(suffix array, classes per k, class ends per k).

    ``classes[k][i]`` is the place in the suffix array where suffixes begin that share the
    2^k words at i; it has one more entry, -1, for the end. ``ends[k]`` has, at that place,
    where they end. Symbols differ between documents, so a block that leaves its document
    is in a class of its own.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    starts = np.ones(n + 1, bool)
    starts[1:n] = symbols[sa[1:]] != symbols[sa[:-1]]
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(starts[:n], np.arange(n), 0))
    classes, ends, step = [], [], 1
    while True:
        classes.append(rank.astype(np.int32))
        at = np.flatnonzero(starts)
        end = np.zeros(n, np.int32)
        end[at[:-1]] = at[1:]
        ends.append(end)
        open_ = np.flatnonzero(~(starts[:n] & starts[1:]))
        if not len(open_):
            return sa, classes, ends
        place = sa[open_]
        after = place + step
        key = rank[place] * (n + 1) + np.where(after < doc_end[place], rank[np.minimum(after, n)] + 1, 0)
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        sa[open_] = place
        starts[open_[1:]] |= key[1:] != key[:-1]
        rank = rank.copy()
        rank[place] = np.maximum.accumulate(np.where(starts[open_], open_, 0))
        step *= 2


def same_ahead(classes: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words from x on equal those from y on (x < y, in one document)."""
    x, y, n = x.copy(), y.copy(), len(classes[0]) - 1
    begin = x.copy()
    for k in range(len(classes) - 1, -1, -1):
        again = k == len(classes) - 1  # the largest known block may fit more than once
        while True:
            equal = classes[k][np.minimum(x, n)] == classes[k][np.minimum(y, n)]
            equal &= y < n
            x += equal.astype(np.int64) << k
            y += equal.astype(np.int64) << k
            if not (again and equal.any()):
                break
    return x - begin


def same_behind(classes: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words before x equal those before y (x < y, in one document)."""
    x, y = x.copy(), y.copy()
    begin = x.copy()
    for k in range(len(classes) - 1, -1, -1):
        again = k == len(classes) - 1
        while True:
            a = x - (1 << k)
            equal = (classes[k][np.maximum(a, 0)] == classes[k][np.maximum(y - (1 << k), 0)]) & (a >= 0)
            x -= equal.astype(np.int64) << k
            y -= equal.astype(np.int64) << k
            if not (again and equal.any()):
                break
    return begin - x


class WaveletMatrix:
    """Values in given order, for the smallest value of a range of places that is not below a bound."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def _below(self, lo, hi, bound):
        count = np.zeros(len(lo), np.int64)
        for level, z in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            zl, zh = z[lo], z[hi]
            count += np.where(one, zh - zl, 0)
            lo = np.where(one, lo - zl + z[-1], zl)
            hi = np.where(one, hi - zh + z[-1], zh)
        return count

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Per query the smallest value >= bound among places lo to hi (exclusive); -1 where there is none."""
        over = bound >> self.bits > 0
        k = np.where(over, hi - lo, self._below(lo, hi, np.where(over, 0, bound)))
        found = k < hi - lo
        lo, hi, k = lo[found], hi[found], k[found]
        value = np.zeros(len(lo), np.int64)
        for z in self.zeros:
            zl, zh = z[lo], z[hi]
            one = k >= zh - zl
            value = value * 2 + one
            k = np.where(one, k - (zh - zl), k)
            lo = np.where(one, lo - zl + z[-1], zl)
            hi = np.where(one, hi - zh + z[-1], zh)
        out = np.full(len(found), -1, np.int64)
        out[found] = value
        return out


# ---- candidates and runs ------------------------------------------------------------------------


def _occurrences(tree: WaveletMatrix, classes, block, lo, hi, m, first, last):
    """Candidate (place, distance) pairs of blocks of m words whose class takes places lo to hi of the tree."""
    out = []
    bound, stop = block + first, block + last
    while len(block):
        a = tree.successor(lo, hi, bound)
        ok = (a >= 0) & (a <= stop)
        block, lo, hi, stop, a = (v[ok] for v in (block, lo, hi, stop, a))
        b = tree.successor(lo, hi, a + 1)
        step = np.where((b >= 0) & (b <= stop), b - a, 0)
        near = (step > 0) & (step <= m // 2)
        out.append((block[~near], (a - block)[~near]))
        bound = a + 1
        if near.any():
            x, s, c = a[near], step[near], block[near]
            terms = (same_ahead(classes, x, x + s) + s - m) // s + 1
            bound[near] = x + terms * s  # no occurrence of the block lies between the terms, nor this one behind the last
            terms = np.minimum(terms, (stop[near] - x) // s + 1)
            joined = same_ahead(classes, c, c + s) + s >= x + (terms - 1) * s + m - c
            own = joined & (x - c == s)  # the stretch's period itself
            out.append((c[own], s[own]))
            c, x, s, terms = (v[~joined] for v in (c, x, s, terms))
            number = np.arange(terms.sum()) - np.repeat(np.cumsum(terms) - terms, terms)
            out.append((np.repeat(c, terms), np.repeat(x - c, terms) + number * np.repeat(s, terms)))
    return [np.concatenate(v) if v else np.empty(0, np.int64) for v in zip(*out)] if out else [np.empty(0, np.int64)] * 2


def find_runs(symbols: np.ndarray, doc_end: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run, by start, then period."""
    if min_words < MIN_WORDS:
        raise ValueError(f"runs have {MIN_WORDS} words at least")
    none = np.empty(0, np.int64)
    if not len(symbols):
        return none, none, none
    sa, classes, ends = block_classes(symbols, doc_end)
    # Only blocks of two words or more that occur twice are asked for: the tree holds their part of the array.
    if len(classes) < 2:
        return none, none, none
    twice = np.zeros(len(sa) + 1, np.int64)
    rank = classes[1][:-1]
    twice[1:] = np.cumsum((ends[1][rank] - rank > 1)[sa])
    kept = sa[twice[1:] > twice[:-1]]
    if not len(kept):
        return none, none, none
    tree = WaveletMatrix(kept)
    found = []
    for k in range(1, len(classes)):
        m = 1 << k
        block = np.arange(0, len(symbols), m)
        lo = classes[k][block].astype(np.int64)
        hi = ends[k][lo].astype(np.int64)
        many = hi - lo > 1
        first, last = {1: (6, 6), 2: (1, 14)}.get(k, (2 * m - 1, 4 * m - 2))
        found.append(_occurrences(tree, classes, block[many], twice[lo[many]], twice[hi[many]], m, first, last))
    place, period = (np.concatenate(v) for v in zip(*found))
    behind = same_behind(classes, place, place + period)
    start = place - behind
    end = place + period + same_ahead(classes, place, place + period)
    long_ = end - start >= np.maximum(min_words, 2 * period)
    order = np.lexsort((period[long_], end[long_], start[long_]))
    start, end, period = (v[long_][order] for v in (start, end, period))
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


# ---- documents -----------------------------------------------------------------------------------


def repeat_some(doc_id: int | None, n: int) -> np.ndarray:
    """Which original word each of a document's n words becomes: some documents repeat a stretch to their end."""
    own = np.arange(n)
    if doc_id is None or not n:
        return own
    h = crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        own[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return own


def _solve(ids: list, words: list[list[bytes]], pick, min_words: int) -> pa.RecordBatch:
    counts = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(counts)
    begins = ends - counts
    all_words = np.empty(int(counts.sum()), object)
    all_words[:] = [w for doc in words for w in doc]
    codes = pd.factorize(all_words)[0].astype(np.int64)
    if pick is not None:
        shift = [b + pick(d, int(c)) for d, b, c in zip(ids, begins, counts)]
        origin = np.concatenate(shift) if shift else np.empty(0, np.int64)
        codes, all_words = codes[origin], all_words[origin]
    doc = np.repeat(np.arange(len(ids)), counts)
    start, end, period = find_runs(doc * (int(codes.max(initial=0)) + 1) + codes, ends[doc], min_words)
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, end, -1)
    keep = np.cumsum(cover)[:-1] == 0
    owner = doc[start] if len(start) else start
    split = np.searchsorted(owner, np.arange(len(ids) + 1))
    runs = pa.ListArray.from_arrays(
        pa.array(split, pa.int32()),
        pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start - begins[owner], end - start, period)], ["start", "length", "period"]),
    )
    collapsed = [b" ".join(all_words[b:e][keep[b:e]].tolist()) for b, e in zip(begins, ends)]
    columns = [pa.array(ids, pa.int64()), runs, pa.array(counts, pa.int64()), pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "n_words", "collapsed"])


def word_runs(docs: DataFrame, pick=None, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, runs, n_words, collapsed) of each row of docs (doc_id, text).

    ``collapsed`` is the text without the words that any run holds after its first period.
    ``pick`` (doc_id, number of words) gives, if set, the original word of every word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                split = (text.as_py() or b"").split()  # on bytes: blank, tab, line breaks, form feed
                if ids and size + len(split) > BATCH_WORDS:
                    yield _solve(ids, words, pick, min_words)
                    ids, words, size = [], [], 0
                ids.append(d)
                words.append(split)
                size += len(split)
        if ids:
            yield _solve(ids, words, pick, min_words)

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, SCHEMA)


def digests(runs: DataFrame) -> DataFrame:
    """Per document the longest run, and digests of all runs and of the collapsed text."""
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: long, length: long, period: long>), "
        "(a, r) -> if(a is null or r.length > a.length, r, a))"  # runs are by start, then period: the first longest
    )
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return runs.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
