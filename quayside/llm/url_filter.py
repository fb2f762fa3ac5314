"""URL filter: a blocked Bloom filter passes possible hits on to an exact hash join.

Listed entries are of two kinds: rules (host, path prefix, verdict) that fit a host, all
its subdomains and every path that starts with theirs, the longest rule winning; and
canonical URLs, which are blocked as a whole. A page is looked up under all keys that
could be listed for it: its host's suffixes with its path's prefixes of the lengths that
occur in rules, and its canonical URL.

The filter has one block of 256 bits for about 16 listed keys; a key sets eight bits of
the block that its hash chooses. It is a table (block, four longs), aggregated with
``bit_or``, and is broadcast only below ``BROADCAST_BYTES``, else joined by block. Keys
that pass are joined with the listed keys themselves, so no false positive remains.
Everything is DataFrame functions.

Defined results: null URLs and URLs without ``://`` have empty host and path and are
allowed; repeated pages are judged alike; entries with null fields are never hit; repeated
entries count once, and of rules with equal keys "block" wins; empty tables of pages or
entries give no rows, or "allow".
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import scratch_path

KEYS_PER_BLOCK = 16
BROADCAST_BYTES = 32 << 20
_WORDS = ("w0", "w1", "w2", "w3")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host in ASCII lower case; both empty without a scheme."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without its last slash; no scheme, query or fragment."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """The four words of a block with the key's eight bits set."""
    h = F.xxhash64(key, F.lit(2))
    places = [F.shiftrightunsigned(h, 8 * j).bitwiseAND(F.lit(255)) for j in range(8)]
    words = []
    for w in range(4):
        word = F.lit(0).cast("long")
        for p in places:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftright(p, 6) == w, bit).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def bloom_table(keys: DataFrame, key: str = "key") -> tuple[DataFrame, int]:
    """The filter of a column of keys: (table of blocks, number of blocks)."""
    blocks = max(1, -(-keys.count() // KEYS_PER_BLOCK))
    masks = [m.alias(w) for m, w in zip(_masks(F.col(key)), _WORDS)]
    table = keys.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), *masks)
    return table.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in _WORDS)), blocks


def possible(df: DataFrame, key: str, table: DataFrame, blocks: int) -> DataFrame:
    """Rows of df whose key passes the filter."""
    if blocks * 64 <= BROADCAST_BYTES:
        table = F.broadcast(table)
    names = [f"_{w}" for w in _WORDS]
    probe = df.withColumn("_block", _block(F.col(key), blocks))
    hit = probe.join(table.select(F.col("block").alias("_block"), *(F.col(w).alias(n) for w, n in zip(_WORDS, names))), "_block")
    for m, n in zip(_masks(F.col(key)), names):
        hit = hit.where(F.col(n).bitwiseAND(m) == m)
    return hit.drop("_block", *names)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Judge every page: page_id, host, path, rule (or null), listed (its canonical URL is), verdict.

    rules: host, path, verdict ("allow" or "block"); listed: canonical_url. The rule's verdict stands;
    without a rule, listed URLs are blocked and others allowed.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("row", F.monotonically_increasing_id())
    where = scratch_path(spark, "url-filter")
    parsed.write.parquet(where)  # row numbers must not change between the two uses
    parsed = spark.read.parquet(where)

    rule_keys = rules.where("host is not null and path is not null and verdict is not null").select(
        F.concat(F.lit("r"), "host", F.lit("\n"), "path").alias("key"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.length("path").alias("n"),
        F.size(F.split("host", r"\.")).alias("labels"),
    )
    # distinct path lengths and label counts: as many as URLs have characters, at most
    sizes = rule_keys.select("n", "labels").distinct().collect()
    entries = rule_keys.groupBy("key").agg(F.max(F.struct("verdict", "rule")).alias("v")).select(
        "key", F.col("v.rule").alias("rule"), F.col("v.verdict").alias("verdict")
    )
    if listed is not None:
        urls = listed.where("canonical_url is not null").select(F.concat(F.lit("u"), "canonical_url").alias("key")).distinct()
        entries = entries.unionByName(urls, allowMissingColumns=True)

    labels = F.split("host", r"\.")
    candidates = []
    for s in sorted(sizes):
        suffix = F.array_join(F.reverse(F.slice(F.reverse(labels), 1, s["labels"])), ".")
        fits = (F.size(labels) >= s["labels"]) & (F.length("path") >= s["n"])
        candidates.append(F.when(fits, F.concat(F.lit("r"), suffix, F.lit("\n"), F.substring("path", 1, s["n"]))))
    candidates.append(F.concat(F.lit("u"), canonical_url(F.col("host"), F.col("path"))))
    keys = parsed.select("row", F.explode(F.array_compact(F.array(*candidates))).alias("key"))
    hits = possible(keys, "key", *bloom_table(entries)).join(entries, "key")
    found = hits.groupBy("row").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("best"),
        F.bool_or(F.col("rule").isNull()).alias("listed"),
    )
    return parsed.join(found, "row", "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"),
    )
