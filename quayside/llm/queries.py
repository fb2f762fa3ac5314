"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    ball_tree,
    ngram_join,
    packing,
    periodic_runs,
    positional_index,
    prefix_trie,
    quality_crf,
    quartile_digest,
    repair_ids,
    sentencepiece_codec,
    toxicity_wfst,
    url_filter,
    warc_derive,
)
from quayside.session import scratch_path


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per derived record: its links, digests and length, and the digest of its whole bytes."""
    derived = warc_derive.derive(warc_derive.response_records(_table(spark, sf_dir, "pages")))
    return derived.select(
        "page_id",
        "kind",
        "record_id",
        "refers_to",
        "target_uri",
        "block_digest",
        "payload_digest",
        "content_length",
        F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    repair_ids.write_ids(_table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    back = repair_ids.read_ids(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality_crf.score(docs, quality_crf.train(docs, _table(spark, sf_dir, "labels")))
    held_out = quality_crf.in_fold(F.col("doc_id"), 5, 0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_toxicity_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity_wfst.score(docs, toxicity_wfst.train(docs, _table(spark, sf_dir, "labels")))
    held_out = quality_crf.in_fold(F.col("doc_id"), 3, 1)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = quartile_digest.edited_pairs(_table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


#: Rules of the URL query (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Labels of hosts whose canonical URLs the URL query lists.
LISTED_HOST = r"(^|\.)(ads|adult|bets|casino|cheap|free|pills|spam)-"


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host, path = url_filter.url_parts(F.col("url"))
    listed = pages.where(host.rlike(LISTED_HOST)).select(url_filter.canonical_url(host, path).alias("canonical_url"))
    return url_filter.judge(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs.word_runs(_table(spark, sf_dir, "documents"), pick=periodic_runs.repeat_some)
    return periodic_runs.digests(runs)


def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2("items", 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = prefix_trie.sequences(_table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.trie(prefix_trie.shared_openings(seqs, group=20, kinds=4))
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )


_OP10_SQL = """
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT page_id, row_number() OVER () AS rid,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
urls AS (SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/$', '') AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM urls
  WHERE regexp_matches(host, '(^|[.])(ads|adult|bets|casino|cheap|free|pills|spam)-')),
hits AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN l.canonical IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM urls LEFT JOIN hits USING (rid) LEFT JOIN listed l ON urls.canonical = l.canonical
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_exact_top_k,
        op3_ngram_join,
        op4_warc_derivatives,
        op5_packing,
        op6_repair_ids,
        op7_quality_crf,
        op8_toxicity_wfst,
        op9_quartile_digest,
        op10_url_filter,
        op11_periodic_runs,
        op12_positional_index,
        op13_prefix_trie,
    )
}

_OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = len(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([x[1] * x[2] FOR x IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

ORACLE_SQL = {"op2_exact_top_k": _OP2_SQL, "op10_url_filter": _OP10_SQL}
