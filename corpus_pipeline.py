"""A training-data pipeline over ``documents``: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet in the shared folder and reads again as the next stage's docs. All stages but the
last keep the columns of documents. A stage without rows gives the next one none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import ngram_join, packing, quality_crf, toxicity_wfst
from quayside.llm.queries import vocabulary
from quayside.session import scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the quality model calls good: score 0.3 at least."""
    return quality_crf.keep(docs, quality_crf.train(docs, _labels(spark, sf_dir)), 0.3)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores below 0.7."""
    return toxicity_wfst.keep(docs, toxicity_wfst.train(docs, _labels(spark, sf_dir)), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates (five words, similarity 0.8)."""
    return ngram_join.keep_first(docs, n=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their sequences."""
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pack", pack)]

#: SQL can express neither the learned models nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
