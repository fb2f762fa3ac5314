"""N-gram join, components, the two classifiers and the pipeline."""

import random
import re
import tracemalloc
import zlib
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import components, ngram_join, quality_crf, queries, toxicity_wfst
from quayside.llm.spans import text_buffer

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def shingles(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def classes(rows, n=3, percent=90):
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d)) for d in sets}


def near_copies(groups=4, copies=25, seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(3))
    passage = [word() for _ in range(40)]
    out = []
    for g in range(groups):
        base = [word() for _ in range(rnd.choice((12, 60, 150)))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randrange(5)):
                own[rnd.randrange(len(own))] = word()
            out.append(" ".join(own))
    out += [" ".join(passage + [word() for _ in range(20)]) for _ in range(40)]
    return list(enumerate(out))


def test_op3_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {tuple(r) for r in queries.op3_ngram_join(spark, SF).collect()} == classes(rows)


def test_ngram_join_near_copies(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "PART_GRAMS", 500)
    for block, n, percent in ((512, 3, 90), (7, 3, 90), (7, 5, 80)):
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
        got = {tuple(r) for r in ngram_join.jaccard_classes(docs, n, percent).collect()}
        assert got == classes(rows, n, percent), (block, n, percent)


def test_ngram_join_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a b c"), (None, "a b c"), (6, "\x0b"), (7, "x"), (7, "x"), (8, "b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    got = sorted((tuple(r) for r in ngram_join.jaccard_classes(docs).collect()), key=str)
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5), (None, 1, None), (6, 0, 6), (7, 1, 7), (7, 1, 7), (8, 1, 8)], key=str
    )
    assert ngram_join.jaccard_classes(docs.limit(0)).count() == 0
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7, 8]


def test_components_chain_star_and_empty(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(1, 1), (None, 3), (560, 30)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {k: 100 for k in range(101, 161)} | {k: 500 for k in range(501, 560)} | {560: 30}
    assert components.connected_components(df.limit(0)).count() == 0


def auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def held_out(spark, name, label, sf, folds, fold):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.QUERIES[name](spark, sf).join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % folds == fold) for d, h in zip(rows.doc_id, rows.held_out))
    rows = rows[rows.held_out]
    return rows, rows.score.to_numpy(), rows[label].to_numpy()


def test_op7_held_out(spark):
    rows, score, label = held_out(spark, "op7_quality_crf", "quality", "/root/testdata/sf0.1", 5, 0)
    assert auc(score, label) > 0.99 and ((score >= 0.3) == (rows.predicted == 1)).all()
    assert np.mean(rows.predicted == rows.quality) > 0.98 and score.min() >= 0 and score.max() <= 1


def test_op8_held_out(spark):
    rows, score, label = held_out(spark, "op8_toxicity_wfst", "toxic", "/root/testdata/sf0.1", 3, 1)
    assert auc(score, label) > 0.95 and ((score >= 0.7) == (rows.predicted == 1)).all()
    assert rows.predicted[rows.toxic == 0].mean() < 0.005


def test_chain_marginals_by_brute_force():
    rnd = np.random.default_rng(2)
    score, chain, pairs = rnd.normal(size=7), np.array([0, 0, 0, 0, 1, 2, 2]), rnd.normal(size=(2, 2))
    marginal = quality_crf.chains(score, chain, pairs)[0]
    for c in range(3):
        at = np.flatnonzero(chain == c)
        total = np.zeros(2 ** len(at))
        paths = [[k >> i & 1 for i in range(len(at))] for k in range(2 ** len(at))]
        for k, y in enumerate(paths):
            total[k] = np.exp(sum(score[a] * v for a, v in zip(at, y)) + sum(pairs[u, v] for u, v in zip(y, y[1:])))
        for i, a in enumerate(at):
            assert abs(marginal[a] - sum(t for t, y in zip(total, paths) if y[i]) / total.sum()) < 1e-9


def test_quality_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    for empty in (labels.limit(0), labels):
        model = quality_crf.train(odd_docs, empty)
        rows = quality_crf.score(odd_docs, model).collect()
        assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
        assert quality_crf.keep(odd_docs, model, 0.0).collect() == odd_docs.collect()
        tox = toxicity_wfst.train(odd_docs, empty)
        assert len(toxicity_wfst.score(odd_docs, tox).collect()) == 8
        assert toxicity_wfst.keep(odd_docs, tox, 1.1).columns == odd_docs.columns
    assert quality_crf.score(odd_docs.limit(0), model).count() == 0


def test_classifiers_take_little_memory_whatever_the_batch():
    """A batch of Arrow is 10,000 rows however long; what a worker takes follows the bytes in hand, not the batch."""
    texts = [("Some plain words, and more of them; you idiot.\n" * 20)] * 17_000
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    rng = np.random.default_rng(3)
    model = quality_crf.Model(rng.normal(size=3 * quality_crf.FEATURES * quality_crf.BINS), np.zeros((2, 2)), 1.0, 0.0, 0.5, 0.5)
    machine = toxicity_wfst.Machine({b"zork": 0.5})
    for rows in (lambda b: quality_crf.chances([b], model), lambda b: toxicity_wfst.pattern_sums([b], "text", machine)):
        tracemalloc.start()
        found = np.concatenate([r[-1] for r in rows(whole)])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80e6, peak
        assert len(found) == len(texts) and (found == next(rows(whole.slice(0, 1)))[-1][0]).all()


def patterns(text):
    machine = toxicity_wfst.Machine({b"zork": 0.5})
    sums = machine.counts(*text_buffer(pa.array([text], pa.string())))[0]
    return {p: n for p, n in zip(toxicity_wfst.PATTERNS, sums) if n}


def test_grammar_patterns():
    assert patterns("what an IDIOT") == {"i": 1}
    assert patterns("you are an idiot") == {"I": 1}
    assert patterns("idiot, you know") == {"i": 1}
    assert patterns("idiot that you are") == {"i": 1, "J": 1}
    assert patterns("you are not an idiot") == {"a": 1}
    assert patterns("he is not in any way at all an idiot") == {"I": 1}
    assert patterns("the man said idiot. idiot") == {"c": 1, "i": 1}
    assert patterns("I will kill you") == {"t": 1, "U": 1}
    assert patterns("they kill. never kill") == {"T": 1, "b": 1}
    assert patterns("a zorkish thing") == {"i": 0.5}
    assert patterns("plain words") == {} == patterns("") == patterns(None)


def test_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "pack"]
    good = corpus_pipeline.quality(spark, docs, SF)
    scores = {r.doc_id: r.score for r in quality_crf.score(docs, quality_crf.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    kept = good.collect()
    assert good.columns == docs.columns and {r.doc_id for r in kept} == {d for d, s in scores.items() if s >= 0.3}
    clean = corpus_pipeline.toxicity(spark, spark.createDataFrame(kept, docs.schema), SF).collect()
    rows = [(r.doc_id, r.text) for r in clean]
    one = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(clean, docs.schema), SF).collect()
    assert {r.doc_id for r in one} == {c for _, _, c in classes(rows, 5, 80)}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in one}
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
