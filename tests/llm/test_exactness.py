"""Exact results where numbers are large, lines long, or texts empty."""

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import ball_tree, ngram_join, quality_crf


def test_overlaps_beyond_single_precision():
    """671,121 shared of 745,690 in all is 90 %; one fewer is not."""
    for shared, linked in ((671_121, True), (671_120, False)):
        rest = 745_690 - shared
        one = np.arange(shared + rest // 2, dtype=np.int64)
        other = np.concatenate([np.arange(shared), np.arange(10**6, 10**6 + rest - rest // 2)]).astype(np.int64)
        found = ngram_join.cell_links(np.array([5, 3]), np.zeros(2, np.int64), [one, other], 90)
        assert found == ([(5, 3)] if linked else [])
        assert 100 * shared >= 90 * 745_690 or not linked


def ranks(rows, k, scale=64):
    out = set()
    for q, v in rows:
        if q % 5 == 0:
            exact = lambda c: int(np.floor(c * scale)) if abs(c) < 2.0**40 else int(c) * scale
            scores = [(sum(exact(a) * exact(b) for a, b in zip(v, w)), d) for d, w in rows if d != q]
            for n, (s, d) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k]):
                out.add((q, n + 1, d, max(-(2**63 - 1), min(2**63 - 1, s))))
    return out


def test_top_k_ranks_scores_beyond_a_long_exactly(spark):
    values = [1e308, 9e307, -1e308, 1e300, 2.0, -3.5, 1e18, -1e18, 4e9, 0.0]
    rows = [(d, [v, float(d % 3)]) for d, v in enumerate(values + values[::-1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (1000, 4):
        got = ball_tree.top_k(df, F.col("vec_id") % 5 == 0, k=6, shard_rows=shard_rows, block_rows=3)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert {tuple(r) for r in got.collect()} == ranks(rows, 6)


def test_more_rows_in_a_shard_than_places(monkeypatch):
    monkeypatch.setattr(ball_tree, "PLACE_BITS", 3)
    rnd = np.random.default_rng(0)
    q, x = rnd.integers(-4, 5, (7, 3)).astype(float), rnd.integers(-4, 5, (50, 3)).astype(float)
    x_ids, q_ids = rnd.integers(0, 9, 50), np.arange(7) + 100
    row, ids, scores, over = ball_tree.search(q, q_ids, np.full(7, -(2.0**63)), x, x_ids, 5)
    assert set(over) == {"m"}
    for i in range(7):
        best = sorted(((-int(s), int(d)) for s, d in zip(x @ q[i], x_ids)))[:5]
        assert sorted((-int(s), int(d)) for r, d, s in zip(row, ids, scores) if r == i) == best


def test_a_line_of_any_length_is_one_line():
    line = b"AB cd 12 ## " * 300_000 + b"\n"
    short = b"AB cd 12 ## " * 30 + b"\n"
    data = np.frombuffer(line + short, np.uint8)
    bins, lengths, doc = quality_crf.line_bins(data, np.array([0, len(line), len(data)]))
    assert lengths.tolist() == [len(line) - 1, len(short) - 1] and doc.tolist() == [0, 1]
    assert (bins[0][:7] == bins[1][:7]).all()


def test_texts_without_lines_score_low_unless_labelled_good(spark):
    docs = spark.createDataFrame(
        [(i, "good plain words here\n" * 3 if i % 2 else "$$$ BUY!!! ###\n" * 3) for i in range(40)] + [(40, ""), (41, None), (42, " \n ")],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality_crf.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality_crf.score(docs, model).collect()}
    assert scores[40] == scores[41] == 0.0 and scores[1] > 0.5
    kept = {r.doc_id for r in quality_crf.keep(docs, model, 0.3).collect()}
    assert not kept & {40, 41} and 1 in kept
    good = labels.unionByName(spark.createDataFrame([(i, 1) for i in range(100, 130)], "doc_id long, quality int"))
    more = docs.unionByName(spark.createDataFrame([(i, "") for i in range(100, 130)], "doc_id long, text string"))
    assert quality_crf.train(more, good).empty == 1.0
