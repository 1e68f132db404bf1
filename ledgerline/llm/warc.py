"""WARC derivatives: linked metadata and plain-text conversion records of response records."""

from __future__ import annotations

import base64
import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import map_texts

VERSION = "WARC/1.1"
LINE = "\r\n"
CRAWLED = "2024-01-01T00:00:00Z"

HIDDEN = re.compile(r"<(script|style|noscript|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|footer|form|h[1-6]|head|header|hr|li|main|nav|ol|p|"
    r"pre|section|table|td|th|title|tr|ul)\b[^<>]*>",
    re.I,
)
TAG = re.compile(r"</?[a-z][^<>]*>|<![^<>]*>|<\?[^<>]*>", re.I)
BLANKS = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[ \n]*")
TITLE, TITLE_END = re.compile(r"<title\b[^<>]*>", re.I), re.compile(r"</title\s*>", re.I)
LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"<>]*)\"|'([^'<>]*)'|([^\s\"'<>]+))", re.I)
LANGUAGE = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)


def title_of(page: str) -> str:
    """What stands between the first opening tag and the closing tag after it; one that is never closed is no title."""
    opened = TITLE.search(page)
    closed = TITLE_END.search(page, opened.end()) if opened else None
    return page[opened.end() : closed.start()] if closed else ""


def plain_text(page: str) -> str:
    """Visible text of a page, one line for each block, blanks collapsed; an unclosed script hides the rest."""
    text = TAG.sub("", BREAKS.sub("\n", HIDDEN.sub(" ", page)))
    return LINES.sub("\n", BLANKS.sub(" ", html.unescape(text))).strip()


def one_line(text: str) -> str:
    return " ".join(text.split())


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(*parts: Column) -> Column:
    """A name made of the content, the same whenever it is made again."""
    h = F.md5(F.concat_ws("\u0000", *(F.coalesce(p.cast("string"), F.lit("\u0001")) for p in parts)))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, date: str = CRAWLED) -> DataFrame:
    """Response records of crawled pages: ``page_id, record_id, target_uri, date, http_headers, text``.

    A null page is an empty one; a null address is kept as it is.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length(text).cast("string"),
    )
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        record_id(F.lit("response"), F.col("page_id"), F.col("url"), text).alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.lit(date).alias("date"),
        http.alias("http_headers"),
        text.alias("text"),
    )


def derivatives(source: DataFrame) -> DataFrame:
    """Two records for each response: its metadata and its plain text.

    ``page_id, record_type, record_id, refers_to, target_uri, date, content_type, content_length, block_digest,
    source_payload_digest, source_headers, block``. Both refer to the response's id and keep its address, date, HTTP headers and
    the digest of its payload; the metadata also name the conversion. An empty
    page gives an empty conversion; repeated rows give the same records again.
    """

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        out: dict[str, list] = {n: [] for n in ("payload", "body", "body_digest", "body_bytes", "title", "language", "links")}
        for page in batch:
            body = plain_text(page)
            raw = body.encode("utf-8", "replace")
            title, language = title_of(page), LANGUAGE.search(page)
            out["payload"].append(digest(page.encode("utf-8", "replace")))
            out["body"].append(body)
            out["body_digest"].append(digest(raw))
            out["body_bytes"].append(len(raw))
            out["title"].append(one_line(html.unescape(TAG.sub("", title))))
            out["language"].append(language[1].lower() if language else "")
            found = dict.fromkeys(one_line(html.unescape(a or b or c)) for a, b, c in LINK.findall(page))
            out["links"].append([u for u in found if u])
        return out

    schema = "payload string, body string, body_digest string, body_bytes long, title string, language string, links array<string>"
    made = map_texts(source, per_batch, schema)
    made = made.withColumn("conversion_id", record_id(F.lit("conversion"), F.col("record_id")))
    fields = F.concat(
        *(
            F.when(value != "", F.concat(F.lit(f"{name}: "), value, F.lit(LINE))).otherwise("")
            for name, value in (
                ("title", F.col("title")),
                ("language", F.col("language")),
                ("payloadDigest", F.col("payload")),
                ("conversion", F.col("conversion_id")),
                ("conversionDigest", F.col("body_digest")),
                ("textLength", F.length("body").cast("string")),
            )
        ),
        F.array_join(F.transform("links", lambda u: F.concat(F.lit("outlink: "), u, F.lit(LINE))), ""),
    )
    made = made.withColumn("fields", fields)
    one = lambda kind, name, content, length, sha, block: F.struct(
        F.lit(kind).alias("record_type"),
        name.alias("record_id"),
        F.lit(content).alias("content_type"),
        length.cast("long").alias("content_length"),
        sha.alias("block_digest"),
        block.alias("block"),
    )
    both = F.array(
        one(
            "metadata",
            record_id(F.lit("metadata"), F.col("record_id")),
            "application/warc-fields",
            F.octet_length("fields"),
            F.concat(F.lit("sha256:"), F.sha2("fields", 256)),
            F.col("fields"),
        ),
        one("conversion", F.col("conversion_id"), "text/plain; charset=utf-8", F.col("body_bytes"), F.col("body_digest"), F.col("body")),
    )
    rows = made.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload").alias("source_payload_digest"), F.col("http_headers").alias("source_headers"), F.explode(both).alias("r"))
    return rows.select(
        "page_id", "r.record_type", "r.record_id", "refers_to", "target_uri", "date", "r.content_type", "r.content_length",
        "r.block_digest", "source_payload_digest", "source_headers", "r.block",
    )


HEADERS = (
    ("WARC-Type", "record_type"),
    ("WARC-Record-ID", "record_id"),
    ("WARC-Refers-To", "refers_to"),
    ("WARC-Target-URI", "target_uri"),
    ("WARC-Date", "date"),
    ("WARC-Block-Digest", "block_digest"),
    ("WARC-Source-Payload-Digest", "source_payload_digest"),
    ("Content-Type", "content_type"),
    ("Content-Length", "content_length"),
)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the records as WARC files, one for each partition, in any file system that Spark reaches."""
    fields = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{LINE}{n}: "), F.regexp_replace(F.col(c).cast("string"), r"[\r\n]+", " "))).otherwise("")
        for n, c in HEADERS
    ]
    whole = F.concat(F.lit(VERSION), *fields, F.lit(LINE * 2), F.col("block"))
    records.select(whole.alias("value")).write.option("lineSep", LINE * 2).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files as ``write_warc`` makes them: the columns of ``HEADERS``, ``block`` and ``intact``.

    Spark parts the files at the line that opens a record. A block that holds such a line itself comes in
    pieces; its length then differs from the stated one and ``intact`` is false.
    """
    raw = spark.read.option("lineSep", f"{LINE * 2}{VERSION}{LINE}").text(path)
    value = F.regexp_replace("value", rf"\A{re.escape(VERSION)}\r\n", "")
    rows = raw.where(F.col("value") != "").select(F.substring_index(value, LINE * 2, 1).alias("head"), value.alias("value"))
    header = lambda n: F.regexp_extract("head", rf"(?m)^{n}: ([^\r\n]*)", 1)
    cut = rows.withColumn("rest", F.expr(r"substring(value, length(head) + 5)"))
    cut = cut.withColumn("content_length", header("Content-Length").cast("long"))
    # The last record of a file still has its closing lines.
    last = F.regexp_replace("rest", r"\r\n\r\n\z", "")
    block = F.when(F.octet_length("rest") == F.col("content_length"), F.col("rest")).otherwise(last)
    named = [F.when(header(n) != "", header(n)).alias(c) for n, c in HEADERS if c != "content_length"]
    return cut.select(*named, "content_length", block.alias("block"), (F.octet_length(block) == F.col("content_length")).alias("intact"))


def page_derivatives(pages: DataFrame) -> DataFrame:
    """``derivatives`` of the response records of ``pages`` (page_id, url, html)."""
    return derivatives(responses(pages))
