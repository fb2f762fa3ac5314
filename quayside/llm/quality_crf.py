"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line that is not empty is described by binned shares (capitals, digits, signs,
bars, words that end in signs or exclamation marks, repeated words, ...), its own and
its neighbours'. The chain labels each line good or bad; forward-backward gives each
line's marginal, and their mean, weighted by line length, is the document's quality,
which one logistic step turns into a probability. A line's label in training is its
document's; long documents are cut into chains of CHAIN lines for that, none left out.

Training uses at most ``train_docs`` labelled documents, those with the smallest hash
of their id; their binned features, not their texts, reach the driver. Scoring is one
pass over all whole texts without a shuffle; only model weights are sent out.

Defined results: texts null, empty or of blank lines only get the share of good documents
among such texts of the training sample, and 0 if it has none; with no labels others get 0.5; null ids are scored like others, and
are never trained on; of several labels of an id the least counts; rows with equal ids
are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.spans import slices, text_buffer
from quayside.session import ship_package

TRAIN_DOCS = 6000
CHAIN = 32
STEPS = 120
SLICE = 2 << 20  # bytes of text at a time; a worker takes some 20 times as many
#: Bin edges of shares, and of lengths.
SHARE_EDGES = np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7])
LENGTH_EDGES = np.array([8, 20, 50, 120, 300, 800, 2500])
WORD_EDGES = np.array([2.0, 3.0, 4.0, 5.0, 6.5, 8.0, 11.0])
BINS = len(SHARE_EDGES) + 2  # the last one: no such neighbour
FEATURES = 10
_SPACE = b" \t\n\v\f\r"
_SIGNS = b"#$%&*+/<=>@[\\]^_`{|}~"


def _masks() -> dict[str, np.ndarray]:
    def of(chars) -> np.ndarray:
        m = np.zeros(256, bool)
        m[list(chars)] = True
        return m

    upper, lower = range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1)
    return {
        "space": of(_SPACE),
        "upper": of(upper),
        "letter": of([*upper, *lower, *range(0xC0, 0x100)]),
        "digit": of(b"0123456789"),
        "sign": of(_SIGNS),
        "end": of([*_SIGNS, *b"-"]),
        "shout": of(b"!"),
    }


MASK = _masks()
_FIELD = 32  # bits of a count: lines may have any length


def _packed(*names: str) -> np.ndarray:
    table = np.zeros(256, np.uint64)
    for k, n in enumerate(names):
        table |= MASK[n].astype(np.uint64) << np.uint64(_FIELD * k)
    return table


_LETTERS, _OTHERS = _packed("upper", "letter"), _packed("digit", "sign")
_BYTE_HASH = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5851F42D4C957F2D)
_BYTE_HASH[MASK["space"]] = 0


def line_bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x FEATURES bins, line lengths, document of each line) of texts; empty lines are left out."""
    n = len(data)
    if n == 0:
        return np.zeros((0, FEATURES), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.zeros(n + 1, bool)
    begin[offsets[:-1]] = True
    begin[1:] |= data == 10
    starts = np.flatnonzero(begin[:n])
    sizes = np.diff(np.append(starts, n))
    lengths = sizes - (data[starts + sizes - 1] == 10)
    field = np.uint64((1 << _FIELD) - 1)
    one, two = np.add.reduceat(_LETTERS[data], starts), np.add.reduceat(_OTHERS[data], starts)
    upper, letter, digit, sign = (((v >> np.uint64(_FIELD * k)) & field).astype(float) for v in (one, two) for k in range(2))

    space = MASK["space"][data]
    first = ~space
    first[1:] &= space[:-1] | begin[1:n]
    word_at = np.flatnonzero(first)
    lines = len(starts)
    if len(word_at):
        line = (np.cumsum(begin[:n], dtype=np.int64) - 1)[word_at]
        final = ~space
        final[:-1] &= space[1:] | begin[1:n]
        last_at = np.flatnonzero(final)
        size = last_at - word_at + 1
        mark = np.add.reduceat(_BYTE_HASH[data], word_at) + size.astype(np.uint64)
        again = np.zeros(len(word_at), bool)
        again[1:] = (mark[1:] == mark[:-1]) & (line[1:] == line[:-1])
        total = lambda w: np.bincount(line, weights=w, minlength=lines)
        words = np.bincount(line, minlength=lines).astype(float)
        ends, shouts = total(MASK["end"][data[last_at]] & (size > 1)), total(MASK["shout"][data[last_at]])
        bars, letters_in = total((size == 1) & MASK["sign"][data[word_at]]), total(size)
        repeats = total(again)
    else:
        words = ends = shouts = bars = letters_in = repeats = np.zeros(lines)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    text_mark = np.add.reduceat(_BYTE_HASH[data], starts) ^ (doc.astype(np.uint64) << np.uint64(40))
    _, inverse, times = np.unique(text_mark, return_inverse=True, return_counts=True)
    filled = lambda a, b: a / np.maximum(b, 1.0)
    shares = [
        filled(upper, letter),
        filled(digit, lengths),
        filled(sign, lengths),
        filled(bars, words),
        filled(ends, words),
        filled(shouts, words),
        filled(repeats, words),
    ]
    columns = [np.searchsorted(SHARE_EDGES, s, side="left") for s in shares]
    columns.append(np.searchsorted(LENGTH_EDGES, lengths, side="left"))
    columns.append(np.searchsorted(WORD_EDGES, filled(letters_in, words), side="left"))
    columns.append(np.minimum(times[inverse] - 1, 3))
    keep = (lengths > 0) & (words > 0)
    return np.stack(columns, axis=1).astype(np.uint8)[keep], lengths[keep], doc[keep]


def neighbour_bins(bins: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """(lines x 3 FEATURES) weight numbers: own, previous and next line's bins; chain: the chain of each line."""
    n, f = bins.shape
    none = np.full((1, f), BINS - 1, np.uint8)
    before, after = np.concatenate([none, bins[:-1]])[:n], np.concatenate([bins[1:], none])[:n]
    apart = np.append(True, chain[1:] != chain[:-1])[:n]
    before[apart] = BINS - 1
    after[np.append(apart[1:], True)[:n]] = BINS - 1
    wide = np.concatenate([bins, before, after], axis=1).astype(np.int32)
    return wide + BINS * np.arange(3 * f, dtype=np.int32)


@dataclass
class Model:
    """Weights: of line features for "good", of the four label pairs, of the first label; then the logistic step."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float
    shift: float
    base: float
    empty: float  # score of texts without lines


def chains(score: np.ndarray, chain: np.ndarray, pairs: np.ndarray):
    """Forward-backward over chains of lines whose label "good" has this score ("bad" has 0).

    Returns (marginal of good per line, expected label pairs (2 x 2 per chain), log of all weights per
    chain, chain numbers 0..)."""
    first = np.flatnonzero(np.append(True, chain[1:] != chain[:-1])[: len(chain)])
    sizes = np.diff(np.append(first, len(chain)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    running = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains longer than t
    move = np.exp(pairs)
    # the chance of good given all lines up to here: one number a line
    emit = np.clip(score, -30, 30)
    good = np.exp(-np.logaddexp(0, -emit))
    ahead = np.zeros((len(score), 2))
    scale = np.zeros(len(score))
    log_all = np.zeros(len(first))
    for t in range(longest):
        m = running[t]
        at = first[:m] + t
        prior = np.full((m, 2), 0.5) if t == 0 else ahead[at - 1] @ move
        a = prior * np.stack([1 - good[at], good[at]], axis=1)
        z = a.sum(axis=1)
        ahead[at], scale[at] = a / z[:, None], z
        log_all[:m] += np.log(z) + np.logaddexp(0, emit[at])
    behind = np.ones((len(score), 2))
    expected = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        m = running[t]
        at = first[:m] + t
        e = np.stack([1 - good[at], good[at]], axis=1) * behind[at] / scale[at][:, None]
        behind[at - 1] = e @ move.T
        expected += (ahead[at - 1].T @ e) * move
    both = ahead * behind
    marginal = both[:, 1] / both.sum(axis=1)
    return marginal, expected, log_all.sum(), len(first)


def fit(bins: np.ndarray, lengths: np.ndarray, doc: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Model:
    """Model of documents 0.. with these labels; doc: the document of each line, in order."""
    n_weights = 3 * FEATURES * BINS
    lined = np.zeros(len(label), bool)
    lined[doc] = True
    empty = float(label[~lined].mean()) if len(label) and not lined.all() else 0.0
    model = Model(np.zeros(n_weights), np.zeros((2, 2)), 1.0, 0.0, float(label.mean()) if len(label) else 0.5, empty)
    if not len(doc) or label.min() == label.max():
        return Model(np.zeros(n_weights), np.zeros((2, 2)), 0.0, _logit(model.base), model.base, empty)
    first = np.searchsorted(doc, doc, side="left")
    chain = doc * (1 << 32) + (np.arange(len(doc)) - first) // CHAIN
    numbers = neighbour_bins(bins, doc)
    y = label[doc].astype(float)
    cut = np.append(False, chain[1:] == chain[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1].astype(int)[cut[1:]], y[1:].astype(int)[cut[1:]]), 1)
    theta = np.zeros(n_weights + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        score = theta[:n_weights][numbers].sum(axis=1)
        marginal, expected, _, count = chains(score, chain, theta[n_weights:].reshape(2, 2))
        gradient = np.zeros_like(theta)
        gradient[:n_weights] = np.bincount(numbers.ravel(), weights=np.repeat(marginal - y, numbers.shape[1]), minlength=n_weights)
        gradient[n_weights:] = (expected - seen).ravel()
        gradient = gradient / count + 1e-4 * theta
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient**2
        theta -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    model.weights, model.pairs = theta[:n_weights], theta[n_weights:].reshape(2, 2)
    quality = document_quality(model, bins, lengths, doc, len(label))
    known = ~np.isnan(quality)
    x, t = _logit(quality[known]), label[known].astype(float)
    w = np.zeros(2)
    for _ in range(25):  # Newton steps of a logistic fit of (slope, shift)
        p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
        g = np.array([((p - t) * x).sum() + 1e-2 * w[0], (p - t).sum() + 1e-2 * w[1]])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
        w -= np.clip(np.linalg.solve(h, g), -2, 2)
    model.slope, model.shift = float(max(w[0], 0.0)), float(w[1])
    return model


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def document_quality(model: Model, bins: np.ndarray, lengths: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Length-weighted mean marginal of good lines; nan without lines."""
    if not len(doc):
        return np.full(docs, np.nan)
    score = model.weights[neighbour_bins(bins, doc)].sum(axis=1)
    marginal = chains(score, doc, model.pairs)[0]
    weight = np.bincount(doc, weights=lengths, minlength=docs)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.bincount(doc, weights=lengths * marginal, minlength=docs) / weight


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids are in none."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, bound: int) -> DataFrame:
    """doc_id, text, label of at most ``bound`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``bound`` rows


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS) -> Model:
    """Model of labelled documents that are not held out (crc32 of the id, modulo 5, is not 0)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            bins, lengths, doc = line_bins(*text_buffer(batch.column(1)))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([bins[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    pa.array([lengths[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                ],
                ["doc_id", "label", "bins", "lengths"],
            )

    sample = labelled_sample(docs, labels, label, in_fold(F.col("doc_id"), 5, 0), train_docs)
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "text", "label").mapInArrow(run, f"doc_id {kind}, label int, bins binary, lengths binary").toArrow()
    rows = rows.sort_by("doc_id")
    bins = [np.frombuffer(b, np.uint8).reshape(-1, FEATURES) for b in rows["bins"].to_pylist()]
    lengths = [np.frombuffer(b, "<i4") for b in rows["lengths"].to_pylist()]
    doc = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    none = np.zeros((0, FEATURES), np.uint8)
    return fit(np.concatenate([none, *bins]), np.concatenate([np.zeros(0), *lengths]), doc, rows["label"].to_numpy())


def chances(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, chance of label 1 of each), some at a time."""
    for batch in slices(batches, "text", SLICE):
        bins, lengths, doc = line_bins(*text_buffer(batch.column(batch.schema.get_field_index("text"))))
        quality = document_quality(model, bins, lengths, doc, batch.num_rows)
        chance = 1 / (1 + np.exp(-(model.slope * _logit(quality) + model.shift)))
        yield batch, np.where(np.isnan(quality), model.empty, chance)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (chance of label 1) of every whole text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, chance in chances(batches, model):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance)], ["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose text scores at least the threshold; all columns, unchanged."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, chance in chances(batches, model):
            yield batch.filter(pa.array(chance >= threshold))

    return docs.mapInArrow(run, docs.schema)
