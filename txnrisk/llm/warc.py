"""WARC derivatives: for every response, a linked metadata record and a plain-text conversion record.

Both carry their own identifier, WARC-Refers-To with the identifier of the response, its target
URI and date, and digests of their blocks; the metadata block keeps the source's HTTP headers and
payload digest, and the links found on the page.  :func:`write_warc` writes the records as WARC
files with Spark's own text writer: a record ends with two CRLFs, which is the line separator."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"

DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAG = re.compile(r"<(/?[a-zA-Z][a-zA-Z0-9-]*|[!?])(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>")
BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head "
                   "header hr html li main nav ol p pre section table td th title tr ul".split())
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
#: the date of a record that has none
NO_DATE = "1970-01-01T00:00:00Z"
LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
HREF = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACES = re.compile(r"[ \t\f\v\r\xa0]+")


def plain_text(page: str) -> str:
    """Visible text: comments, scripts and styles go, block tags end a line, entities are resolved."""
    text = TAG.sub(lambda m: "\n" if m[1].strip("/").lower() in BLOCKS else "", DROP.sub("", page))
    lines = (SPACES.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def digest(block: str) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block.encode()).digest()).decode()


def record_id(*parts) -> str:
    """The same identifier whenever the same record is built."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(chr(0).join(map(str, parts)).encode()).hexdigest())}>"


def metadata_block(page: str, http: str, payload: str) -> str:
    title, lang = TITLE.search(page), LANG.search(page)
    fields = [("payload-digest", payload)]
    fields += [(f"source-{k.strip().lower()}", v.strip()) for k, v in (x.split(":", 1) for x in http.split("\r\n")[1:] if ":" in x)]
    fields += [("source-status", http.split("\r\n")[0])]
    if title:
        fields.append(("title", SPACES.sub(" ", html.unescape(title[1])).replace("\n", " ").strip()))
    if lang:
        fields.append(("language", lang[1]))
    fields += [("outlink", html.unescape(a or b or c).replace("\r", "").replace("\n", "")) for a, b, c in HREF.findall(DROP.sub("", page))]
    return "".join(f"{k}: {v}\r\n" for k, v in fields)


RECORD = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, payload_digest string, block_digest string, content_length long, block string")


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response of (page_id, url, date, http, html).

    A null page counts as an empty one: its text block is empty, its metadata block has the source
    fields alone.  A null http leaves those out, a null url the target URI; a null date stays null here.
    Other columns are not read, whatever their names.  Repeated rows give equal records with
    equal identifiers; an empty table gives none.  Long pages are parsed in linear time."""
    names = [f.split()[0] for f in RECORD.split(", ")]

    def run(batches):
        for big in batches:
            for lo in range(0, big.num_rows, 500):
                rows = []
                for pid, url, date, http, page in zip(*(c.to_pylist() for c in big.slice(lo, 500).columns)):
                    page, http = page or "", http or ""
                    payload = digest(page)
                    source = record_id("response", pid, url, date, payload)
                    for kind, mime, block in (("metadata", "application/warc-fields", metadata_block(page, http, payload)),
                                              ("conversion", "text/plain; charset=utf-8", plain_text(page))):
                        rows.append((pid, kind, record_id(kind, source), source, url, date, mime, payload, digest(block), len(block.encode()), block))
                kinds = [pa.int64(), *[pa.string()] * 8, pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return responses.select("page_id", "url", "date", "http", "html").mapInArrow(run, RECORD)


def responses(pages: DataFrame, date: str = DATE, http: str = HTTP) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.lit(date).alias("date"), F.lit(http).alias("http"), "html")


def record_text(records: DataFrame) -> DataFrame:
    """``value``: header lines, an empty line and the block of each record.  The format demands a date, so
    a null one is written as :data:`NO_DATE`, and the date of what the record refers to is left out."""
    line = lambda name, c: F.concat(F.lit(f"{name}: "), c, F.lit("\r\n"))
    opt = lambda name, c: F.coalesce(line(name, c), F.lit(""))
    return records.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.coalesce("date", F.lit(NO_DATE))), line("WARC-Refers-To", F.col("refers_to")), opt("WARC-Target-URI", F.col("target_uri")),
        opt("WARC-Refers-To-Target-URI", F.col("target_uri")), opt("WARC-Refers-To-Date", F.col("date")), opt("WARC-Payload-Digest", F.col("payload_digest")),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    record_text(records).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(read_table(spark, sf_dir, "pages")))
