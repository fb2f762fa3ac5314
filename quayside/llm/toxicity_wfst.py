"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words become symbols by a lexicon: insult, threat, target, negation, reporting verb, or
other. Three transducers rewrite a clause's symbols, each one's output being the next
one's input, composed into one machine:

* negation: an insult or threat at most three words after a negation is negated;
* reported speech: one that follows a reporting verb in its clause is reported;
* target: one in a clause with a target is personal, whichever comes first.

Arcs carry weights, which composition multiplies: a negated or reported insult or threat
weighs less than a bare one and a personal one more (ARC_WEIGHTS). The weight of a match is
its path's times the lexical weight of its word, summed per document by what the machine
writes (PATTERNS); the score is a logistic function of log(1 + sum) of each pattern and of the
rate of all patterns among the words. So a clause counts by its pattern, not a word by
itself. Only clauses that hold an insult or threat are run.

Fixed words start the lexicon. From labelled documents come stems, word beginnings of
STEM_SIZES letters that occur much more often in documents labelled toxic: in MIN_DOCS
of them at least, copies left out, and in MIN_WORDS different words, or in MIN_WORD_DOCS
documents. They are learned in rounds: words that a stem covers are set aside, and what is
left may make a shorter stem that such stems begin with, until no stem is found. A stem's
weight follows its odds. Pattern weights start from PRIOR and are
fitted on the same documents. Training uses at most ``train_docs`` labelled documents,
those with the smallest hash of their id.

Defined results: null and empty texts, and those without a match, get the least score;
null ids are scored like others, and are never trained on; of several labels of an id the
least counts; rows with equal ids are scored each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.quality_crf import in_fold, labelled_sample
from quayside.llm.spans import slices, text_buffer
from quayside.session import scratch_path, ship_package

TRAIN_DOCS = 10000
SLICE = 2 << 20  # bytes of text at a time; a worker takes some 25 times as many
STEM_SIZES = range(3, 10)
MIN_DOCS, MIN_WORDS, MIN_WORD_DOCS = 3, 3, 8
#: Toxic documents that a clean one with the same stem outweighs, both as shares of their kind. This and MIN_DOCS
#: were chosen by cross-validation among rows that are not held out.
CLEAN_COST = 4.0
#: Log odds at which a stem weighs as much as a fixed word.
FULL_ODDS = 6.0
NEGATION_REACH = 3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "oitynr"
WORDS = {
    INSULT: "idiot idiots idiotic moron morons moronic stupid dumb scum trash garbage loser losers pathetic worthless"
    " disgusting clown clowns fool fools imbecile ugly filth filthy vermin pig pigs coward cowards scumbag jerk",
    THREAT: "kill killing hurt destroy murder shoot stab strangle hang burn beat",
    TARGET: "you your yours yourself u he she they them him her those these people everyone everybody"
    " du dich dir ihr euch tu toi vous tú te usted ustedes",
    NEGATION: "not no never neither nor without cannot isn aren wasn weren don doesn nicht kein keine nie pas jamais nunca",
    REPORT: "said says say saying quote quoted quotes wrote writes called claims claimed reported reports according"
    " sagte schrieb dit écrit dijo escribió",
}
#: What the composed machine writes: an insult or threat as it stands (i, t), negated (a, b), reported
#: (c, d), personal because a target came before (I, T) or after (J, U).
PATTERNS = "itabcdITJU"
#: Weights of arcs that write these; an insult or threat as it stands weighs 1. J and U come on top of i and t.
ARC_WEIGHTS = {"a": 0.25, "b": 0.25, "c": 0.5, "d": 0.5, "I": 1.5, "T": 2.0, "J": 0.5, "U": 1.0}
#: Weight of each pattern's sum before fitting, and of no pattern at all.
PRIOR = dict(zip(PATTERNS, (3.0, 1.5, 1.5, 1.0, 1.5, 1.0, 3.0, 2.0, 1.0, 1.0)))
RATE, BIAS = 0.8, -3.5


@dataclass(frozen=True)
class Transducer:
    """Deterministic weighted letter transducer: (state, symbol) -> (state, written, weight); what is not
    listed keeps the state and writes the symbol with weight 1. State 0 starts; all states are final."""

    arcs: dict = field(default_factory=dict)

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def alphabet(self) -> set:
        return {c for _, c in self.arcs} | {c for _, c, _ in self.arcs.values()}

    def compose(self, other: "Transducer") -> "Transducer":
        """This transducer's output read by the other; a pair of arcs weighs their product."""
        symbols = self.alphabet() | other.alphabet() | set("oitynr")
        number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
        while todo:
            pair = todo.pop()
            for c in symbols:
                a, mid, one = self.step(pair[0], c)
                b, out, two = other.step(pair[1], mid)
                if (a, b) not in number:
                    number[a, b] = len(number)
                    todo.append((a, b))
                arcs[number[pair], c] = (number[a, b], out, one * two)
        return Transducer(arcs)


def _negation() -> Transducer:
    arcs = {}
    for k in range(NEGATION_REACH + 1):
        arcs[k, NEGATION] = (NEGATION_REACH, OTHER, 1.0)
        if k:
            arcs |= {(k, c): (k - 1, c, 1.0) for c in (OTHER, TARGET, REPORT)}
            arcs |= {(k, c): (k - 1, out, ARC_WEIGHTS[out]) for c, out in ((INSULT, "a"), (THREAT, "b"))}
    return Transducer(arcs)


def _reported() -> Transducer:
    heard = {(1, c): (1, out, ARC_WEIGHTS[out]) for c, out in ((INSULT, "c"), (THREAT, "d"))}
    return Transducer({(s, REPORT): (1, OTHER, 1.0) for s in (0, 1)} | heard)


def _target() -> Transducer:
    # 0: nothing yet; 1: a target; 2, 3: an insult or threat that waits for a target
    arcs = {(s, TARGET): (1, OTHER, 1.0) for s in (0, 1)}
    for s, c, out in ((2, TARGET, "J"), (3, TARGET, "U"), (1, INSULT, "I"), (1, THREAT, "T")):
        arcs[s, c] = (1, out, ARC_WEIGHTS[out])
    for s in (0, 2, 3):
        arcs |= {(s, INSULT): (2, INSULT, 1.0), (s, THREAT): (3, THREAT, 1.0)}
    return Transducer(arcs)


def grammar() -> Transducer:
    """The composed machine."""
    return _negation().compose(_reported()).compose(_target())


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(bytes that belong to words, bytes that end clauses)."""
    word, clause = np.zeros(256, bool), np.zeros(256, bool)
    word[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
    clause[list(b".,;:!?()\n")] = True
    return word, clause


_WORD, _CLAUSE = _tables()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words_of(data: np.ndarray, offsets: np.ndarray):
    """(lower-case words as an Arrow array, document of each word, clause of each word)."""
    n = len(data)
    word = _WORD[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[offsets[:-1][offsets[:-1] < n]] |= word[offsets[:-1][offsets[:-1] < n]]
    last[:-1] &= ~word[1:]
    ends = offsets[1:-1]
    ends = ends[ends > 0]
    last[ends - 1] |= word[ends - 1]
    at, to = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = _CLAUSE[data].copy()
    bounds[offsets[:-1][offsets[:-1] < n]] = True
    clause = np.cumsum(bounds, dtype=np.int64)[at] if n else at
    doc = np.searchsorted(offsets, at, side="right") - 1
    letters = _LOWER[data]
    capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    letters[capital] += 0x20  # Latin-1 capitals
    letters = np.ascontiguousarray(letters[word])
    where = np.append(0, np.cumsum(to - at)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(where), pa.py_buffer(letters)])
    return array, doc, clause


class Machine:
    """Lexicon and composed transducer, counting patterns of whole texts."""

    def __init__(self, stems: dict[bytes, float]):
        self.symbol = {w.encode(): (ord(c), 1.0) for c, ws in WORDS.items() for w in ws.split()}
        self.stems, self.sizes = stems, sorted({len(s) for s in stems}, reverse=True)
        self.arcs = {(s, ord(c)): to for (s, c), to in grammar().arcs.items()}
        self.memo: dict[bytes, tuple[int, float]] = {}

    def classify(self, word: bytes) -> tuple[int, float]:
        """(symbol, lexical weight) of a word."""
        found = self.symbol.get(word)
        if found is None:
            found = (ord(OTHER), 0.0)
            for k in self.sizes:
                weight = self.stems.get(word[:k]) if k <= len(word) else None
                if weight is not None:
                    return ord(INSULT), weight
        return found

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, PATTERNS and all words): lexical weights of what was written, all paths weighing alike."""
        return self.run(data, offsets)[0]

    def run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, sums): ``counts``, and the same with every match weighed by its path."""
        out = np.zeros((len(offsets) - 1, len(PATTERNS) + 1))
        sums = out.copy()
        if not len(data):
            return out, sums
        words, doc, clause = words_of(data, offsets)
        if not len(words):
            return out, sums
        out[:, -1] = sums[:, -1] = np.bincount(doc, minlength=len(out))
        coded = words.dictionary_encode()
        memo = self.memo
        if len(memo) > 300_000:
            memo.clear()
        kinds = []
        for w in coded.dictionary.to_pylist():
            c = memo.get(w)
            if c is None:
                c = memo[w] = self.classify(w)
            kinds.append(c)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        symbols = np.array([c for c, _ in kinds], np.uint8)[codes]
        weights = np.array([w for _, w in kinds])[codes]
        hit = (symbols == ord(INSULT)) | (symbols == ord(THREAT))
        matched = np.isin(clause, clause[hit])
        symbols, weights, doc, clause = symbols[matched], weights[matched], doc[matched], clause[matched]
        place, arcs = {p: k for k, p in enumerate(PATTERNS)}, self.arcs
        state, now = 0, -1
        waits = 0.0
        for c, d, s, weight in zip(clause.tolist(), doc.tolist(), symbols.tolist(), weights.tolist()):
            if c != now:
                state, now = 0, c
            state, written, path = arcs[state, s]
            k = place.get(written)
            if k is not None:
                if written in "it":
                    waits = weight
                elif written in "JU":  # written for the word that waited for its target
                    weight = waits
                out[d, k] += weight
                sums[d, k] += weight * path
        return out, sums


def features(sums: np.ndarray) -> np.ndarray:
    """What the weights apply to: log(1 + sum) of the patterns, and of their rate in a thousand words."""
    patterns = sums[:, :-1]
    rate = 1000 * patterns.sum(axis=1) / np.maximum(sums[:, -1], 1)
    return np.log1p(np.concatenate([patterns, rate[:, None]], axis=1))


@dataclass(frozen=True)
class Model:
    """Learned stems with their lexical weights, pattern weights (the rate's last) and the bias."""

    stems: dict[bytes, float]
    weights: tuple[float, ...]
    bias: float

    def machine(self) -> Machine:
        return Machine(self.stems)

    def chances(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features(sums) @ np.array(self.weights) + self.bias)))


def _prefixes(words) -> set[bytes]:
    return {w[:k] for w in words for k in STEM_SIZES if k <= len(w)}


def _uncovered(words, stems) -> list[bytes]:
    """The words that no stem begins."""
    return [w for w in words if not any(w[:k] in stems for k in STEM_SIZES)]


def without_copies(docs: list[list[bytes]], marks: int = 16, shared: int = 8) -> list[list[bytes]]:
    """Documents that share fewer than so many of their smallest word hashes with any one earlier document."""
    holders: dict[tuple[int, int], list[int]] = {}
    kept = []
    for n, words in enumerate(docs):
        if not words:
            continue
        own = [(k, min(zlib.crc32(w, k + 1) for w in words)) for k in range(marks)]
        met = Counter(chain.from_iterable(holders.get(m, ()) for m in own))
        if not met or met.most_common(1)[0][1] < shared:
            kept.append(words)
            for m in own:
                holders.setdefault(m, []).append(n)
    return kept


def learn_stems(toxic: list[list[bytes]], clean_counts, n_clean: int) -> dict[bytes, float]:
    """Stems of toxic documents' distinct words, and their weights. clean_counts(candidates, stems) tells how
    many clean documents hold each candidate in words that none of the stems covers."""
    toxic, chosen = without_copies(toxic), {}
    while True:
        found = _best_stems([_uncovered(ws, chosen) for ws in toxic], lambda c: clean_counts(c, set(chosen)), n_clean)
        if not found:
            return chosen
        chosen |= found


def _best_stems(toxic: list[list[bytes]], clean_counts, n_clean: int) -> dict[bytes, float]:
    """Stems none of which begins another, best first."""
    docs, variants = Counter(), {}
    for words in toxic:
        docs.update(_prefixes(words))
    often = {p for p, n in docs.items() if n >= MIN_DOCS}
    for words in toxic:
        for w in words:
            for k in STEM_SIZES:
                if k <= len(w) and w[:k] in often:
                    variants.setdefault(w[:k], set()).add(w)
    candidates = {p for p in often if len(variants[p]) >= MIN_WORDS or docs[p] >= MIN_WORD_DOCS}
    clean = clean_counts(candidates)
    share = len(toxic) / max(1, n_clean)
    net = {p: docs[p] - CLEAN_COST * share * clean.get(p, 0) for p in candidates}
    chosen, begun = {}, set()
    for p in sorted((p for p in candidates if net[p] >= MIN_DOCS), key=lambda p: (-net[p], -len(p), p)):
        if p in begun or any(p[:k] in chosen for k in STEM_SIZES):
            continue  # a better stem begins with it, or it with a better one
        odds = np.log((docs[p] + 0.5) / (share * (clean.get(p, 0) + 0.5)))
        chosen[p] = float(min(1.0, odds / FULL_ODDS))
        begun |= {p[:k] for k in STEM_SIZES}
    return chosen


def fit_weights(counts: np.ndarray, label: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Logistic weights of the features, held near PRIOR, and the bias: Newton's method."""
    x = np.concatenate([features(counts), np.ones((len(counts), 1))], axis=1)
    prior = np.array([PRIOR[p] for p in PATTERNS] + [RATE, BIAS])
    pull = np.diag([0.3] * len(PATTERNS) + [0.3, 0.05])
    w = prior.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - label) + pull @ (w - prior)
        h = (x * (p * (1 - p))[:, None]).T @ x + pull
        w -= np.clip(np.linalg.solve(h, g), -1, 1)
    return tuple(float(v) for v in w[:-1]), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """Model of labelled documents that are not held out (crc32 of the id, modulo 3, is not 1)."""
    spark = docs.sparkSession
    ship_package(spark)
    where = scratch_path(spark, "toxicity-sample")  # at most train_docs documents
    labelled_sample(docs, labels, label, in_fold(F.col("doc_id"), 3, 1), train_docs).select("text", "label").write.parquet(where)
    sample = spark.read.parquet(where)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_clean = sizes.get(0, 0)

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[list[set]]:
        for batch in slices(batches, "text", SLICE):
            words, doc, _ = words_of(*text_buffer(batch.column(0)))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).tolist()
            coded = words.dictionary_encode()
            listed, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            yield [[listed[i] for i in np.unique(codes[a:b])] for a, b in zip(cut, cut[1:])]

    def words(batches):
        for docs_words in distinct_words(batches):
            yield pa.RecordBatch.from_arrays([pa.array(docs_words, pa.list_(pa.binary()))], ["words"])

    toxic = sample.where("label = 1").select("text").mapInArrow(words, "words array<binary>").toArrow()["words"].to_pylist()

    def clean_counts(candidates: set[bytes], stems: set[bytes]) -> dict[bytes, int]:
        def count(batches):
            held = Counter()
            for docs_words in distinct_words(batches):
                for ws in docs_words:
                    held.update(_prefixes(_uncovered(ws, stems)) & candidates)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["p", "n"])

        if not candidates:
            return {}
        rows = sample.where("label = 0").select("text").mapInArrow(count, "p binary, n long").groupBy("p").agg(F.sum("n").alias("n"))
        return {bytes(r["p"]): r["n"] for r in rows.collect()}  # no more rows than candidates

    model = Model(learn_stems(toxic, clean_counts, n_clean), (*(PRIOR[p] for p in PATTERNS), RATE), BIAS)
    if len(sizes) < 2:
        return model
    rows = _count(sample.select("text", "label"), model, "label int").toArrow()
    counts = np.array(rows["counts"].to_pylist(), float).reshape(-1, len(PATTERNS) + 1)
    order = np.lexsort((*counts.T, rows["label"].to_numpy()))  # not the order of arrival
    weights, bias = fit_weights(counts[order], rows["label"].to_numpy()[order].astype(float))
    return Model(model.stems, weights, bias)


def pattern_sums(
    batches: Iterator[pa.RecordBatch], text: str, machine: Machine
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, counts, sums) of the machine over a text column, some rows at a time."""
    for batch in slices(batches, text, SLICE):
        yield batch, *machine.run(*text_buffer(batch.column(batch.schema.get_field_index(text))))


def _count(rows: DataFrame, model: Model, other: str) -> DataFrame:
    """Weighted pattern sums of the first column's texts, beside the second column."""
    text = rows.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.machine()
        for batch, _, sums in pattern_sums(batches, text, machine):
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(sums), pa.list_(pa.float64()))], [other.split()[0], "counts"])

    return rows.mapInArrow(run, f"{other}, counts array<double>")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (chance of being toxic), patterns (what the machine wrote, by count) of every whole text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.machine()
        for batch, counts, sums in pattern_sums(batches, "text", machine):
            shown = [" ".join(f"{p}:{n:.3g}" for p, n in zip(PATTERNS, row) if n) for row in counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.chances(sums)), pa.array(shown)], ["doc_id", "score", "patterns"]
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("patterns", T.StringType()),
        ]
    )
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose text scores below the threshold; all columns, unchanged."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.machine()
        for batch, _, sums in pattern_sums(batches, "text", machine):
            yield batch.filter(pa.array(model.chances(sums) < threshold))

    return docs.mapInArrow(run, docs.schema)
