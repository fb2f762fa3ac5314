"""Ball-tree search, URL filter, fingerprints and WARC derivatives."""

import hashlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from quayside.llm import ball_tree, quartile_digest, queries, url_filter, warc_derive
from quayside.session import local_path, scratch_path

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name, sf=SF):
    con = duckdb.connect()
    for t in ("embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    sql = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in sql.description]
    own = queries.QUERIES[name](spark, sf)
    assert sorted(own.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in own.select(names).collect()))) == sorted(map(str, sql.fetchall()))


def test_queries_equal_sql(spark):
    same_as_sql(spark, "op2_exact_top_k")
    same_as_sql(spark, "op10_url_filter")


def brute(rows, k):
    out = set()
    for q, v in rows:
        if q % 5 == 0:
            scores = sorted(((-int(np.dot(v, w)), d) for d, w in rows if d != q))[:k]
            out |= {(q, n + 1, d, -s) for n, (s, d) in enumerate(scores)}
    return out


def test_top_k_many_shards_and_ties(spark):
    rnd = np.random.default_rng(4)
    vectors = [rnd.integers(-6, 6, 4) for _ in range(300)] + [np.array([3, 3, 3, 3])] * 200
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(d, [float(c) / 64 for c in v]) for d, v in rows], "vec_id long, embedding array<double>")
    got = ball_tree.top_k(df, F.col("vec_id") % 5 == 0, k=7, shard_rows=60, block_rows=20)
    assert {tuple(r) for r in got.collect()} == brute(rows, 7)


def test_ball_tree_bounds():
    x = np.random.default_rng(1).normal(size=(500, 8))
    order, leaves, centres, radii = ball_tree.ball_tree(x, 16)
    assert sorted(order) == list(range(500)) and sum(b - a for a, b, _ in leaves) == 500
    for a, b, path in leaves:
        for p in path:
            assert (np.linalg.norm(x[order[a:b]] - centres[p], axis=1) <= radii[p] + 1e-9).all()


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    rows += [(5, [0.5, 0.5]), (5, [0.5, 0.5]), (20, [0.1, -0.2]), (40, [1.0]), (60, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = sorted(tuple(r) for r in ball_tree.top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 5, 6144), (0, 2, 5, 6144), (0, 3, 20, -1280), (20, 1, 5, -224), (20, 2, 5, -224), (20, 3, 0, -1280)]
    assert ball_tree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_url_filter_odd_rows(spark):
    urls = ["HTTP://A.Example.ORG/es/x?q", "http://org/", "http://notorg/", "x", None, "http://example.org/en/12#f", "http://example.org",
            "http://www.spam.net/a/", "https://spam.net/a?x=1", "http://spam.net/ab", "://x.com/de/", "a://b://c/d\ne"]
    pages = spark.createDataFrame([(1, u, "v") for u in urls], "page_id long, url string, verdict string")
    rules = spark.createDataFrame([*queries.URL_RULES, (None, "/", "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([("spam.net/a",), (None,)], "canonical_url string")
    got = {(r.host, r.path): (r.rule, r.verdict) for r in url_filter.judge(pages, rules, listed).collect()}
    assert got == {
        ("a.example.org", "/es/x"): ("example.org/es/", "block"),
        ("org", "/"): ("org/", "allow"),
        ("notorg", "/"): (None, "allow"),
        ("", ""): (None, "allow"),
        ("example.org", "/en/12"): ("example.org/en/1", "block"),
        ("example.org", ""): (None, "allow"),
        ("www.spam.net", "/a/"): (None, "block"),
        ("spam.net", "/a"): (None, "block"),
        ("spam.net", "/ab"): (None, "allow"),
        ("x.com", "/de/"): ("com/de/", "block"),
        ("b:", "//c/d\ne"): (None, "allow"),
    }
    assert url_filter.judge(pages.limit(0), rules, listed).count() == 0


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    table, blocks = url_filter.bloom_table(keys)
    assert url_filter.possible(keys, "key", table, blocks).count() == 5000
    others = spark.range(5000, 25000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert url_filter.possible(others, "key", table, blocks).count() < 600


def test_op9_whole_table(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op9_quartile_digest(spark, SF).collect()}
    assert len(rows) == len(docs)
    marks = {}
    for k, (d, t) in enumerate(docs):
        cut, nxt = len(t) // 4, docs[(k + 1) % len(docs)]
        edited = t[: len(t) - cut] + nxt[1][:cut]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert marks.setdefault(t, r.fingerprint) == r.fingerprint
        assert marks.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        near = quartile_digest.likeness(quartile_digest.unpack([r.fingerprint]), quartile_digest.unpack([rows[nxt[0]].fingerprint]))
        assert abs(near[0] - r.near_next) < 1e-12 and 0 <= r.near_edited <= 1
    edited, nexts = ([r[c] for r in rows.values()] for c in ("near_edited", "near_next"))
    assert np.mean([e > n for e in edited for n in nexts]) > 0.95


def test_fingerprint_odd_rows(spark, odd_docs):
    rows = quartile_digest.edited_pairs(odd_docs, parts=3).collect()
    ordered = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == sorted((r.doc_id or 0, len(r.text or "")) for r in ordered)
    ties = [r for r in rows if r.doc_id in (4, 5)]
    assert len({r.fingerprint for r in ties}) == 1
    assert quartile_digest.edited_pairs(odd_docs.limit(0)).count() == 0
    one = quartile_digest.edited_pairs(odd_docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_digest_counts_by_brute_force():
    text = "héllo wörld, this is a text".encode() * 3
    code = quartile_digest.codes(np.frombuffer(b"xx" + text, np.uint8), np.array([0, 2, 2 + len(text)]))[1]
    padded, counts = text + bytes(quartile_digest.REACH), np.zeros(quartile_digest.BUCKETS, int)
    for (b, c), table in zip(quartile_digest.TRIPLETS, quartile_digest._tables()):
        for i in range(len(text)):
            h = (int(table[0][padded[i]]) + int(table[1][padded[i + b]]) + int(table[2][padded[i + c]])) & 0xFFFF
            counts[(h * 40503 & 0xFFFF) >> 8] += 1
    order = np.sort(counts)
    assert [sum(int(n > order[q * 64 - 1]) for q in (1, 2, 3)) for n in counts] == code[:-1].tolist()


def test_op4_whole_table_by_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    expected = set()
    for p in pages:
        for r in warc_derive.derivatives(p.page_id, warc_derive.response(p.page_id, p.url, p.html)[8]):
            expected.add((*r[:3], r[3], r[5], r[7], hashlib.sha256(r[8].encode()).hexdigest()))
    rows = queries.op4_warc_derivatives(spark, SF).collect()
    own = {(r.page_id, r.kind, r.record_id, r.refers_to, r.block_digest, r.content_length, r.record_sha256) for r in rows}
    assert own == expected and len(rows) == 2 * len(pages)


def test_warc_links_digests_and_text():
    page = "<html><head><title>A &amp; B</title><style>x{}</style></head><body><p>One<br>two</p><script>no</script><!-- no -->  <b>th</b>ree é</body>"
    source = warc_derive.response(7, "http://x/\n", page)
    conversion, metadata = warc_derive.derivatives(7, source[8])
    headers, block = warc_derive.parse_record(conversion[8])
    headers = dict(headers)
    assert block.decode() == "A & B\nOne\ntwo\nthree é"
    assert headers["WARC-Refers-To"] == source[2] and headers["WARC-Type"] == "conversion"
    assert headers["WARC-Block-Digest"] == warc_derive.digest(block)
    about, notes = warc_derive.parse_record(metadata[8])
    notes = dict(x.split(": ", 1) for x in notes.decode().split("\r\n") if x)
    assert dict(about)["WARC-Refers-To"] == source[2] and notes["conversion-record-id"] == conversion[2]
    assert notes["payload-digest"] == notes["source-warc-payload-digest"] == warc_derive.digest(page.encode())
    assert notes["http-status"] == "HTTP/1.1 200 OK"


def test_warc_odd_rows_and_files(spark):
    import glob
    import gzip

    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>x"), (2, "u", "<p>x")], "page_id long, url string, html string")
    records = warc_derive.derive(warc_derive.response_records(pages))
    rows = records.collect()
    assert len(rows) == 8 and len({r.record_id for r in rows if r.page_id == 2}) == 2
    assert warc_derive.derive(warc_derive.response_records(pages.limit(0))).count() == 0
    path = scratch_path(spark, "warc")
    warc_derive.write_warc(records, path)
    files = glob.glob(local_path(path) + "/*.gz")
    text = "".join(gzip.open(f).read().decode() for f in files)
    assert len(text) == sum(len(r.record) for r in rows) and all(r.record in text for r in rows)
