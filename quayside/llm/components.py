"""Connected components of a table of links, by alternating star operations.

A round joins every node's larger neighbours to its smallest one (large star), then
every node's smaller neighbours to its smallest one (small star), until nothing changes;
what is left are stars around each component's smallest node. Links are grouped with
partial sums before the shuffle, and joined on (node, salt), so that a node with very
many links is dealt over SALTS tasks. Each round's links are written to the shared
folder, which cuts the lineage and survives lost executors; only a count and a
checksum a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import scratch_path

SALTS = 8


def _with_smallest(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """edges (u, v) with the column m of their u."""
    salted = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["u", "salt"]).drop("salt")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node that is not its component's smallest one; links: columns a, b."""
    spark = links.sparkSession
    mark = None
    edges = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_smallest(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_smallest(large, least).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        path = scratch_path(spark, "components")
        small.select("e.u", "e.v").where("u <> v").distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).head()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
