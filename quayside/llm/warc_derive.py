"""WARC derivatives: responses become linked metadata and plain-text conversion records.

``response_records`` makes WARC response records of a table of pages (the source side);
``derive`` reads response records (their bytes, HTTP header block and body) and makes for
each a ``conversion`` record, the body's text, and a ``metadata`` record
(application/warc-fields) on what was converted. Both carry WARC-Refers-To and
WARC-Refers-To-Target-URI of the response and block digests of their own; the metadata
record keeps the source's record headers (as ``source-...`` fields), HTTP status and
headers, and its payload digest. Record ids are name-based UUIDs of the response's id and
the kind, so that a run repeated gives the same records.

Text: scripts, styles, comments and the head's other content are left out; block
elements and <br> end lines; character references are resolved; white space is
collapsed; the title comes first. Each record's bytes are UTF-8, so ``write_warc`` stores
them through Spark's text writer, one gzip file a partition.

Defined results: a null page is an empty body, a null URL an empty target; equal pages
give records with equal ids if their page ids are equal; null page ids are written as
"null"; a response without a blank line after its HTTP headers has no body, and one
without an HTTP status line is all body; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.spans import slices
from quayside.session import ship_package

#: Names of ids are made in this space.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:quayside:warc")
WARC_DATE = "2024-01-01T00:00:00Z"
_DROPPED = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!doctype[^>]*>")
_TITLE = re.compile(r"(?is)<title\b[^>]*>(.*?)(?:</title\s*>|\Z)")
_HEAD = re.compile(r"(?is)<head\b[^>]*>.*?</head\s*>")
_LINE = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre"
    r"|section|table|tbody|td|tfoot|th|thead|title|tr|ul|body|html)\b[^>]*>"
)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_BLANKS = re.compile(r"[^\S\n]{2,}|[^\S\n ]")
_LINES = re.compile(r" ?\n\s*")
RECORDS = (
    "page_id long, kind string, record_id string, refers_to string, target_uri string, block_digest string,"
    " payload_digest string, content_length long, record string"
)


def digest(block: bytes) -> str:
    """A WARC digest: sha1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def record(headers: list[tuple[str, str]], block: bytes) -> str:
    """A whole record, its two closing line ends included."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines) + block.decode() + "\r\n\r\n"


def parse_record(text: str) -> tuple[list[tuple[str, str]], bytes]:
    """(headers, block) of a record."""
    head, _, rest = text.partition("\r\n\r\n")
    headers = [tuple(x.split(": ", 1)) for x in head.split("\r\n")[1:]]
    block = rest.encode()
    return headers, block[: int(dict(headers)["Content-Length"])]


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, body) of a response's block."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], [(k, v) for k, _, v in (x.partition(": ") for x in lines[1:])], body


def plain_text(page: str) -> str:
    """Readable text of a page."""
    page = _DROPPED.sub(" ", page)
    title = _TITLE.search(page)
    page = (title[1] if title else "") + "\n" + _TITLE.sub("", _HEAD.sub("\n", page))
    page = _TAG.sub("", _LINE.sub("\n", page.replace("\r", " ")))
    page = _BLANKS.sub(" ", html.unescape(page))
    return _LINES.sub("\n", page).strip()


def _uri(url: str) -> str:
    """A URL as a header value: no line ends."""
    return re.sub(r"[\r\n]+", " ", url).strip()


def response(page_id, url: str, page: str, date: str = WARC_DATE) -> tuple:
    """RECORDS row of a page's response record."""
    body = page.encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    own, target = record_id(f"response {page_id} {url}"), _uri(url)
    whole, payload = digest(block), digest(body)
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", own),
        ("WARC-Target-URI", target),
        ("WARC-Date", date),
        ("WARC-Block-Digest", whole),
        ("WARC-Payload-Digest", payload),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return (page_id, "response", own, None, target, whole, payload, len(block), record(headers, block))


def derivatives(page_id, text: str) -> list[tuple]:
    """RECORDS rows of a response record's conversion and metadata records."""
    source, block = parse_record(text)
    known = dict(source)
    status, fields, body = parse_http(block)
    refers, target, date = known["WARC-Record-ID"], known.get("WARC-Target-URI", ""), known.get("WARC-Date", WARC_DATE)
    whole, payload = digest(block), digest(body)
    if known.get("WARC-Block-Digest", whole) != whole or known.get("WARC-Payload-Digest", payload) != payload:
        raise ValueError(f"a digest of {refers} does not fit its bytes")
    converted = plain_text(body.decode("utf-8", "replace")).encode()
    text_digest = digest(converted)
    ids = {kind: record_id(f"{kind} {refers}") for kind in ("conversion", "metadata")}
    notes = [
        ("http-status", status),
        *((f"http-{k.lower()}", v) for k, v in fields),
        *((f"source-{k.lower()}", v) for k, v in source),
        ("payload-digest", payload),
        ("conversion-record-id", ids["conversion"]),
        ("conversion-block-digest", text_digest),
        ("conversion-length", str(len(converted))),
    ]
    about = "".join(f"{k}: {v}\r\n" for k, v in notes).encode()
    rows = []
    for kind, content, own_digest, mime in (
        ("conversion", converted, text_digest, "text/plain; charset=utf-8"),
        ("metadata", about, digest(about), "application/warc-fields"),
    ):
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", ids[kind]),
            ("WARC-Refers-To", refers),
            ("WARC-Refers-To-Target-URI", target),
            ("WARC-Refers-To-Date", date),
            ("WARC-Target-URI", target),
            ("WARC-Date", date),
            ("WARC-Block-Digest", own_digest),
            ("Content-Type", mime),
        ]
        rows.append((page_id, kind, ids[kind], refers, target, own_digest, payload, len(content), record(headers, content)))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORDS.split(",")]
    kinds = [pa.int64() if f.split()[1] == "long" else pa.string() for f in RECORDS.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def response_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A response record of each page."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = zip(*(batch.column(k).to_pylist() for k in range(3)))
            yield _batch([response(i, u or "", h or "") for i, u, h in rows])

    chosen = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return chosen.mapInArrow(run, RECORDS)


def derive(responses: DataFrame) -> DataFrame:
    """Conversion and metadata records of response records; other kinds of records are passed over."""
    ship_package(responses.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "record"):
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield _batch([r for i, text in rows for r in derivatives(i, text)])

    return responses.where("kind = 'response' and record is not null").select("page_id", "record").mapInArrow(run, RECORDS)


def write_warc(records: DataFrame, path: str) -> None:
    """Write the records as gzip WARC files. A record's last line end is the writer's."""
    whole = records.select(F.expr("substring(record, 1, length(record) - 1)").alias("value"))
    whole.write.option("compression", "gzip").mode("overwrite").text(path)
