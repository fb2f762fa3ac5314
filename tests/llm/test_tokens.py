"""SentencePiece codec, packing and Re-Pair files against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import packing, queries, repair_ids, sentencepiece_codec
from quayside.llm.queries import vocabulary
from quayside.session import scratch_path

SF = "/root/testdata/sf0.001"
LETTERS = list("ab  \u2581\n\t\u00e9\u0300\u65e5\u672c\u00f1\u03a3\u03c2\u0130<s>0\x00\x01.'t|>9#-") + ["<|endoftext|>", "'re", "  "]


def texts(n=400, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(80))) for _ in range(n)] + ["", " ", "ab" * 200]


@pytest.fixture(scope="module")
def piece():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_agenda_equals_library(spark, piece):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    rows = sentencepiece_codec.encode(docs, vocabulary("piece_bpe_32k.model")).collect()
    for r, t in zip(sorted(rows, key=lambda r: r.doc_id), texts()):
        ids = [piece.bos_id(), *piece.encode(t), piece.eos_id()]
        assert (bytes(r.ids), r.n_tokens, r.decoded) == (u32(ids), len(ids), piece.decode(ids))


def test_heap_and_joint_agendas_agree(piece):
    enc = sentencepiece_codec.encoder(vocabulary("piece_bpe_32k.model"))
    for t in texts(100, 9):
        assert enc.encode_span(" " + t.replace("\u2581", " ") if t else "") == piece.encode(t)


def test_op1_whole_table(spark, piece):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_sentencepiece(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = [piece.bos_id(), *piece.encode(docs[r.doc_id]), piece.eos_id()]
        assert r.ids_sha256 == hashlib.sha256(u32(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(piece.decode(ids).encode()).hexdigest()


def test_sentencepiece_odd_rows(spark, odd_docs, piece):
    rows = sentencepiece_codec.encode(odd_docs, vocabulary("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted(
        (r.doc_id or 0, 2 + len(piece.encode(r.text or ""))) for r in odd_docs.collect()
    )
    assert sentencepiece_codec.encode(odd_docs.limit(0), vocabulary("piece_bpe_32k.model")).count() == 0


def check_pieces(rows, docs, words, end_id=1, max_len=2048):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= max_len
    assert len({r.sequence_id for r in rows}) == len(rows)
    for d, t in docs.items():
        ids = [*words.encode(t, add_special_tokens=False).ids, end_id]
        own = sorted(by_doc[d], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == len(ids) and all(r.doc_tokens == len(ids) for r in own)
        assert len(own) == len(ids) // max_len + bin(len(ids) % max_len).count("1")
        for r in own:
            assert r.ids_crc32 == zlib.crc32(u32(ids[r.start : r.start + r.length]))


def test_op5_whole_table(spark, words):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_pieces(queries.op5_packing(spark, SF).collect(), docs, words)


def test_packing_odd_rows(spark, odd_docs):
    pieces = packing.pack(odd_docs, vocabulary("word_bpe_49k.json"), max_len=64)
    rows = pieces.collect()
    assert sorted(r.length for r in rows if r.doc_id in (1, 2)) == [1, 1]
    assert len([r for r in rows if r.doc_id == 5 and r.start == 0]) == 2
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert packing.pack(odd_docs.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, vocabulary("word_bpe_49k.json"), max_len=100)
    path = scratch_path(spark, "buckets")
    packing.write_buckets(pieces, path)
    back = spark.read.parquet(path)
    assert back.where(F.log2("length").cast("int") != F.col("bucket")).count() == 0 and back.count() == len(rows)


def test_word_ids_equal_library(words):
    import pyarrow as pa

    from quayside.llm.word_ids import word_ids

    many = texts(3000, 2)
    ids, at = word_ids(vocabulary("word_bpe_49k.json")).encode_batch(pa.array([*many, None]))
    for k, t in enumerate(many):
        assert ids[at[k] : at[k + 1]].tolist() == words.encode(t, add_special_tokens=False).ids, t


def test_op6_whole_table(spark, words):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op6_repair_ids(spark, SF).collect()}
    before = 0
    for d, t in docs:
        ids = [*words.encode(t, add_special_tokens=False).ids, 2]
        assert (rows[d].start, rows[d].n_tokens, rows[d].ids_crc32) == (before, len(ids), zlib.crc32(u32(ids)))
        before += len(ids)


def test_repair_shard_round_trip_and_random_access():
    rnd = np.random.default_rng(1)
    tokens = np.array([1, 4000, 1, 7, 9000])
    ids = rnd.integers(3, 9, tokens.sum()).astype("<u4")
    payload = repair_ids.pack_shard([3, None, 5, 6, 7], tokens, ids)
    shard = repair_ids.Shard.read(payload)
    assert len(shard.left) and len(shard.symbols) < len(ids) and shard.doc_ids == [3, None, 5, 6, 7]
    assert (shard.ids() == ids).all()
    ends = np.append(0, np.cumsum(tokens))
    for k in range(5):
        own = ids[ends[k] : ends[k + 1]]
        assert (shard.document(k) == own).all()
        for start, length in ((0, 1), (3, 50), (100, 1000), (8999, 5)):
            assert (shard.document(k, start, length) == own[start : start + length]).all()
    with pytest.raises(ValueError):
        repair_ids.Shard.read(payload[:-1] + b"x")


def test_repair_odd_rows_small_shards(spark, odd_docs, words):
    path = scratch_path(spark, "ids")
    repair_ids.write_ids(odd_docs, path, vocabulary("word_bpe_49k.json"), shard_tokens=64)
    rows = sorted(repair_ids.read_ids(spark, path).collect(), key=lambda r: r.start)
    ordered = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert [r.doc_id for r in rows] == [r.doc_id for r in ordered]
    assert [bytes(r.ids) for r in rows] == [u32([*words.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in ordered]
    path = scratch_path(spark, "no-ids")
    repair_ids.write_ids(odd_docs.limit(0), path, vocabulary("word_bpe_49k.json"))
    assert repair_ids.read_ids(spark, path).count() == 0
