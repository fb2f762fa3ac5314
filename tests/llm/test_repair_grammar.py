"""Re-Pair grammars: nothing frequent stays, repeated passages shrink, access touches only its own rules."""

from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from quayside.llm import repair_ids
from quayside.llm.queries import vocabulary
from quayside.llm.word_ids import word_ids
from quayside.session import scratch_path

SF = "/root/testdata/sf0.001"


def uses(symbols, ends):
    """Uses of each pair that do not overlap one of the same pair, document by document, from the left."""
    out = Counter()
    for a, b in zip(ends[:-1], ends[1:]):
        doc, taken = symbols[a:b].tolist(), {}
        for i, pair in enumerate(zip(doc, doc[1:])):
            if taken.get(pair) != i - 1:
                out[pair] += 1
                taken[pair] = i
    return out


def packed(ids, tokens=None, min_count=repair_ids.MIN_COUNT):
    tokens = np.array([len(ids)]) if tokens is None else tokens
    return repair_ids.Shard.read(repair_ids.pack_shard(list(range(len(tokens))), tokens, ids.astype("<u4"), min_count))


@pytest.mark.parametrize("min_count", [2, 5, 48])
def test_no_pair_at_the_floor_stays(min_count):
    texts = pq.read_table(f"{SF}/documents.parquet", columns=["text"]).column(0).combine_chunks()
    ids, at = word_ids(vocabulary("word_bpe_49k.json")).encode_ended(texts, 2)
    shard = packed(ids, np.diff(at), min_count)
    assert max(uses(ids, at).values()) >= min_count
    assert max(uses(shard.symbols, shard.symbol_at).values(), default=0) < min_count
    assert (shard.ids() == ids).all() and len(shard.left)


def test_counts_equal_a_plain_count():
    rnd = np.random.default_rng(5)
    ids = rnd.integers(0, 4, 3000).astype(np.uint64)
    last = np.zeros(3000, bool)
    last[[0, 500, 501, 2999]] = True
    _, number, n, pairs, _ = repair_ids.frequent_pairs(ids, np.flatnonzero(~last), 1)
    got = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(c) for p, c in zip(pairs, n)}
    assert got == uses(ids.astype(np.int64), np.append(0, np.flatnonzero(last) + 1))


def test_a_repeated_passage_shrinks_below_a_tenth():
    ids = np.tile(np.random.default_rng(0).permutation(400) + 10, 500)
    shard = packed(ids)
    assert len(shard.data) // shard.width + 3 * len(shard.left) < len(ids) // 10
    assert (shard.ids() == ids).all()
    one = packed(np.full(100_000, 7))
    assert len(one.symbols) <= 2 * repair_ids.MIN_COUNT and (one.ids() == 7).all()


def test_access_expands_only_the_rules_of_its_range():
    ids = np.tile(np.random.default_rng(0).permutation(400) + 10, 500)
    shard = packed(ids)
    for start, length in ((0, 1), (12_345, 10), (199_990, 50)):
        shard.expanded = 0
        assert (shard.document(0, start, length) == ids[start : start + length]).all()
        assert shard.expanded < 60  # two paths down the grammar, of a few dozen rules
    shard.expanded = 0
    assert len(shard.document(0, 5, 0)) == len(shard.document(0, 200_000, 5)) == shard.expanded == 0


def test_only_the_documents_own_symbols_are_checked():
    tokens, rnd = np.array([50, 60, 70]), np.random.default_rng(2)
    ids = rnd.integers(3, 2000, 180)
    payload = bytearray(repair_ids.pack_shard([1, 2, 3], tokens, ids.astype("<u4")))
    payload[-5] ^= 1  # the last symbol's last byte
    shard = repair_ids.Shard.read(bytes(payload))
    assert (shard.document(0) == ids[:50]).all() and (shard.document(1) == ids[50:110]).all()
    for broken in (lambda: shard.document(2), lambda: shard.document(2, 0, 1), shard.ids):
        with pytest.raises(ValueError):
            broken()


def test_ids_beyond_three_bytes():
    ids = np.tile(np.array([1 << 24, (1 << 31) + 5, 3]), 200)
    shard = packed(ids)
    assert shard.width == 4 and (shard.ids() == ids).all() and len(shard.symbols) < 100
    with pytest.raises(ValueError):
        packed(np.full(200, 0xFFFFFFFF))


def test_rows_of_one_id_are_split_and_stay_in_order(spark, monkeypatch):
    monkeypatch.setattr(repair_ids, "PARTITION_ROWS", 200)
    rows = [(None, f"w{k % 977:03d} some words of a text") for k in range(4000)] + [(k, "other") for k in range(50)]
    path = scratch_path(spark, "ids")
    repair_ids.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, vocabulary("word_bpe_49k.json"))
    assert spark.read.parquet(path).select("part").distinct().count() > 8
    back = sorted(repair_ids.read_ids(spark, path).collect(), key=lambda r: r.start)
    enc = word_ids(vocabulary("word_bpe_49k.json"))
    want = [enc.library.encode(t, add_special_tokens=False).ids + [2] for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in back] == want
