"""Periodic runs, positional index and prefix trie, against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quayside.llm import periodic_runs, positional_index, prefix_trie, queries
from quayside.session import scratch_path

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- runs ----------------------------------------------------------------------------------------


def runs_by_force(words, least=12):
    """(start, length, period) of runs, by comparing all words at all distances."""
    n, best = len(words), {}
    codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if n else np.empty(0)
    for q in range(1, n // 2 + 1):
        equal = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(least, 2 * q):
                best.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def by_start(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def op11_by_force(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_start(runs_by_force(words))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    return (doc_id, len(runs), *best, milli, sha(listed), sha(collapse(words, runs)))


def some_words(rnd):
    kind, n, letters = rnd.random(), rnd.randrange(130), rnd.choice(["a", "ab", "abc", "abcdefgh"])
    words = [rnd.choice(letters) for _ in range(n)]
    if kind < 0.3:
        words[n // 3 : n // 3] = ([rnd.choice(letters) for _ in range(rnd.randint(1, 20))] * 40)[: rnd.randrange(90)]
    elif kind < 0.5:
        words = (words[:60] * 4)[: rnd.randrange(240)]
    elif kind < 0.6:  # Fibonacci words hold many runs
        a, b = "a", "ab"
        while len(b) < 200:
            a, b = b, b + a
        words = list(b[: rnd.randrange(200)])
    return words


@pytest.mark.parametrize("seed", range(60))
def test_find_runs_by_force(seed):
    rnd = random.Random(seed)
    docs = [some_words(rnd) for _ in range(rnd.randint(1, 7))]
    numbers = np.array([ord(w) + 1000 * d for d, doc in enumerate(docs) for w in doc], np.int64)
    ends = np.cumsum([len(d) for d in docs])
    start, end, period = periodic_runs.find_runs(numbers, np.repeat(ends, [len(d) for d in docs]))
    want = [(a + e - len(d), n, q) for d, e in zip(docs, ends) for a, n, q in by_start(runs_by_force(d))]
    assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_wavelet_successor():
    rnd = np.random.default_rng(2)
    values = rnd.permutation(300)[:200]
    tree = periodic_runs.WaveletMatrix(values)
    lo = rnd.integers(0, 200, 500)
    hi = np.minimum(lo + rnd.integers(0, 60, 500), 200)
    bound = rnd.integers(0, 700, 500)
    want = [min((int(v) for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(lo, hi, bound)]
    assert tree.successor(lo, hi, bound).tolist() == want


def test_runs_odd_rows(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \x0b\x0c\r\n\t ", "x"),
        (4, "a b " * 5 + "a c", "x"),  # 11 words: too short
        (5, "a b " * 6, "x"),
        (5, "a b " * 6, None),
        (None, " x y　 " * 9, "y"),  # no-break and wide spaces are no blanks
        (7, "w " * 300_000, "y"),  # beyond a batch
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.n_words, r.collapsed) for r in periodic_runs.word_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, [], 0, ""),
            (2, [], 0, ""),
            (3, [], 0, ""),
            (4, [], 12, " ".join(["a b"] * 5 + ["a c"])),
            (5, [(0, 12, 2)], 12, "a b"),
            (5, [(0, 12, 2)], 12, "a b"),
            (None, [(0, 18, 2)], 18, " x y　"),
            (7, [(0, 300_000, 1)], 300_000, "w"),
        ],
        key=str,
    )
    assert periodic_runs.digests(periodic_runs.word_runs(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(3, np.int64), np.full(3, 3), min_words=4)


def test_op11_whole_table_by_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    want = [op11_by_force(d, t) for d, t in zip(docs["doc_id"], docs["text"])]
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()]
    assert sorted(got) == sorted(want)


# ---- positional index ------------------------------------------------------------------------------


def lower_words(text):
    lowered = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def op12_by_force(docs, items, n=10):
    holders = defaultdict(set)
    for item, text in items:
        w = lower_words(text)
        if w and item is not None:
            for i in range(max(len(w) - n + 1, 1)):
                holders[tuple(w[i : i + n])].add(item)
    sizes = {len(p) for p in holders}
    out = []
    for doc, text in docs:
        w, hit, found = lower_words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if (p := tuple(w[i : i + m])) in holders:
                    hit |= set(range(i, i + m))
                    found |= holders[p]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def test_op12_whole_table_by_force(spark):
    docs, items = (pq.read_table(f"{SF}/{t}.parquet").to_pydict() for t in ("documents", "benchmark"))
    want = op12_by_force(zip(docs["doc_id"], docs["text"]), zip(items["item_id"], items["text"]))
    got = [tuple(r) for r in queries.op12_positional_index(spark, SF).collect()]
    assert sorted(got) == sorted(want) and any(w[-1] for w in want)


def random_texts(rnd, n, most):
    return [" ".join(rnd.choice(["a", "b", "the", "É", "x9"]) for _ in range(rnd.randrange(most))) for _ in range(n)]


def contaminated(spark, docs, items, n):
    d = spark.createDataFrame(docs, "doc_id long, text string, tag string")
    i = spark.createDataFrame(items, "item_id long, text string, term string")
    rows = positional_index.contamination(d, i, n).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, sha(r["items"]), r.n_hit > 0) for r in rows), key=str)


def test_contamination_small_blocks_and_parts(spark, monkeypatch):
    """Many blocks, parts and steps; items that share phrases, repeat, or are short, empty or null."""
    monkeypatch.setattr(positional_index, "PHRASES", 7)
    rnd = random.Random(5)
    docs = [(k, t, "x") for k, t in enumerate(random_texts(rnd, 60, 40))]
    docs += [(3, docs[3][1], "x"), (None, "The a B", None), (70, None, "x"), (71, "", "x"), (72, " -- ", "x"), (73, "a " * 5000, "x")]
    items = [(k, t, "y") for k, t in enumerate(random_texts(rnd, 12, 9))]
    items += [(2, "b a", "y"), (20, items[4][1], "y"), (21, "zzz", "y"), (22, None, "y"), (23, "", "y"), (None, "a", "y"), (-4, "THE-A", "y")]
    got = contaminated(spark, docs, items, 3)
    assert got == sorted(op12_by_force([r[:2] for r in docs], [r[:2] for r in items], 3), key=str)


def test_contamination_empty_tables(spark):
    docs, items = [(1, "a b", "x")], [(1, "a b", "y")]
    assert contaminated(spark, docs, [], 3) == [(1, 2, 0, 0, sha(""), False)]
    assert contaminated(spark, [], items, 3) == []
    assert contaminated(spark, docs, [(1, None, "y")], 3) == [(1, 2, 0, 0, sha(""), False)]


def near_by_force(words, phrase, slop):
    """Stretches from each first word through the next occurrence of each further one."""
    out = []
    for i, w in enumerate(words):
        at = i
        if w != phrase[0]:
            continue
        for p in phrase[1:]:
            at = next((j for j in range(at + 1, len(words)) if words[j] == p), None)
            if at is None:
                break
        if at is not None and at - i < len(phrase) + slop:
            out.append((i, at + 1))
    return out


@pytest.mark.parametrize("slop", [0, 2, 5])
def test_phrase_and_proximity_matches(spark, monkeypatch, slop):
    monkeypatch.setattr(positional_index, "BLOCK_WORDS", 50)
    monkeypatch.setattr(positional_index, "STEP", 16)
    rnd = random.Random(slop)
    texts = random_texts(rnd, 25, 60)
    phrases = sorted({" ".join(lower_words(t)) for t in random_texts(rnd, 25, 5)} - {""})
    path = scratch_path(spark, "index")
    positional_index.write_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), path)
    index = positional_index.read_index(spark, path)
    asked = spark.createDataFrame([(p, f"t{p}") for p in phrases], "phrase string, tag string")
    found = positional_index.matches(index, asked, slop).join(index.where("term is null").select("block", "ordinal", "doc_id"), ["block", "ordinal"])
    got = {(r.doc_id, r.tag): {i for a, b in r.hits for i in range(a, b)} for r in found.collect()}
    want = {}
    for d, text in enumerate(texts):
        for p in phrases:
            stretches = near_by_force(lower_words(text), p.split(" "), slop)
            if stretches:
                want[d, f"t{p}"] = {i for a, b in stretches for i in range(a, b)}
    assert got == want and want
    assert found.select("block").distinct().count() > 1


def test_index_holds_every_word(spark):
    path = scratch_path(spark, "index")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    positional_index.write_index(docs, path)
    index = positional_index.read_index(spark, path)
    text = [w for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist() for w in lower_words(t)]
    stored = index.where("term is not null").agg(F.sum("n_words"), F.sum(F.length("places")), F.count_distinct("term")).head()
    assert tuple(stored) == (len(text), 4 * len(text), len(set(text)))


# ---- trie ------------------------------------------------------------------------------------------


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            t = (role or "", text or "")
            digest = hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, t[0], digest, t))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_by_force(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[c] for c in children[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[c] for c in children[k])
    return sorted(
        (
            (
                min(m),
                len(k),
                min(members[k[:-1]]) if k else None,
                len(m),
                len(children[k]),
                leaves[k],
                saved[k],
                sha(",".join(map(str, sorted(ends[k])))),
            )
            for k, m in members.items()
        ),
        key=str,
    )


def trie_of(spark, rows):
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, key string")
    nodes = prefix_trie.trie(prefix_trie.shared_openings(prefix_trie.sequences(turns)))
    return sorted((tuple(r) for r in nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends").collect()), key=str)


def test_op13_whole_table_by_force(spark):
    t = pq.read_table(f"{SF}/conversations.parquet").to_pydict()
    want = trie_by_force(zip(t["conv_id"], t["turn"], t["role"], t["text"]))
    got = sorted((tuple(r) for r in queries.op13_prefix_trie(spark, SF).collect()), key=str)
    assert got == want


def test_trie_random_small(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "END_BITS", 3)
    rnd = random.Random(8)
    rows = []
    for c in rnd.sample(range(-60, 300), 200):
        for turn in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((c, turn, rnd.choice(["user", "bot", None]), rnd.choice(["hi", "hi there", "", None])))
    rows += [(400, k, "user", f"long {k % 3}\x0btalk") for k in range(300)]
    assert trie_of(spark, rows) == trie_by_force(rows)


def test_trie_ties_nulls_and_turnless(spark):
    rows = [(None, 0, "user", "lost"), (0, None, "b", "null first"), (0, 0, "a", "x"), (0, 0, "a", "x"), (0, 0, "A", "y")]
    turnless = next(c for c in range(101, 120) if crc32(str(c).encode()) % 4 == 3)  # its base, 100, is absent
    rows += [(turnless, 0, "user", "cut away"), (7, 2, None, None)]
    assert trie_of(spark, rows) == trie_by_force(rows)
    only = [(turnless, 0, "user", "cut away")]
    assert trie_of(spark, only) == [(turnless, 0, None, 1, 0, 1, 0, sha(str(turnless)))]
    assert trie_of(spark, []) == []


def test_end_lists_stream_over_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "END_BITS", 2)
    ids = list(range(-40, 3000, 3))
    ended = spark.createDataFrame([(b"k" * (1 + i % 2), i) for i in ids], "end_key binary, conv_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {bytes(r.end_key): r.ends for r in prefix_trie.end_digests(ended).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {b"k" * (1 + p): sha(",".join(str(i) for i in ids if i % 2 == p)) for p in (0, 1)}
