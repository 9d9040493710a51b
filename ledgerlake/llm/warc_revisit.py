"""WARC archives with revisit records for repeated payloads.

Records with equal payloads of at least ``least_bytes`` bytes form a class:
the one with the largest page id is written as a ``response``, the others as
``revisit`` records that refer to it. Only headers (page id, SHA-1, length)
are shuffled by payload digest, and only classes of several records are kept,
so payloads are not shuffled unless those classes are too many for Spark to
broadcast by its own size check.

Files are written by Spark's text writer: one record per row, with the
separator CR LF CR LF that ends a WARC record, at most ``records_per_file`` a
file. So a lost executor costs the retry of its files, and any storage Spark
writes to will do. A record has fresh WARC and HTTP headers; the payload
stands unchanged behind them, in UTF-8.

Reading parses whole files by Content-Length (a payload may hold anything),
takes the digest and length of the full payload from the response's bytes, and
joins each revisit to the response it refers to.

Defined cases: a NULL html is an empty payload (a response); a NULL page id
stays NULL, is smaller than any other and is written without a page-id field;
pages that repeat both page id and payload are written alike (all as
responses, if theirs is the largest id); control characters in a url become
spaces, so they cannot forge a header.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    digest = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("without id"))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def headers(pages: DataFrame) -> DataFrame:
    """page_id, digest (SHA-1 hex) and length of each payload."""
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    return pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("length"))


def repeated_payloads(heads: DataFrame, least_bytes: int) -> DataFrame:
    """digest and length of payloads that several records share, with the largest page id."""
    found = heads.filter(F.col("length") >= least_bytes).groupBy("digest", "length").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    return found.filter("n > 1").select("digest", "length", "keeper")


def records(pages: DataFrame, least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One text ``value`` per page: a WARC/1.1 record up to its closing separator."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    classes = cut(repeated_payloads(headers(pages), least_bytes), "payload_classes")
    html = F.coalesce("html", F.lit(""))
    body = F.encode(html, "utf-8")
    known = pages.select("page_id", "url", html.alias("html"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("length"))
    known = known.join(classes, ["digest", "length"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("length").cast("string"), F.lit("\r\n\r\n"))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    size = F.octet_length(http) + F.octet_length(payload)
    value = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", F.regexp_replace("url", "[\\x00-\\x1F\\x7F\\x85\\u2028\\u2029]", " "))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("keeper"))), line("X-Refers-To-Page", F.col("keeper").cast("string")))).otherwise(F.lit("")),
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(line("X-Page-Id", F.col("page_id").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", size.cast("string")),
        F.lit("\r\n"), http, payload,
    )
    return known.select(value.alias("value"))


SIZE_CLASSES = (1 << 16, 1 << 20, 1 << 24)  # payload bytes up to which a class goes; larger ones are the last class


def _size_class() -> Column:
    size = F.octet_length(F.encode(F.coalesce("html", F.lit("")), "utf-8"))
    return F.lit(0) + sum(F.when(size > most, 1).otherwise(0) for most in SIZE_CLASSES)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 2048, file_bytes: int = 1 << 27) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``.

    Files hold at most ``records_per_file`` records and about ``file_bytes`` of
    payload: pages are written by size class, each with as many records a file
    as its largest payloads allow (a record of the last class has a file of its
    own). Equal payloads are of one class, so classes are resolved apart; there
    are four at most, and only those that occur cost a pass.
    """
    present = sorted(r["c"] for r in pages.select(_size_class().alias("c")).distinct().collect())
    for at, place in enumerate(present or [0]):
        most = max(1, min(records_per_file, file_bytes // SIZE_CLASSES[place])) if place < len(SIZE_CLASSES) else 1
        some = pages if len(present) < 2 else pages.filter(_size_class() == place)
        records(some, least_bytes, date).write.mode("append" if at else "errorifexists").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", most).text(path)


def parse_archive(data: memoryview):
    """Yield (fields in lower case, payload) of the records of one archive; raise if it is cut short."""
    at = 0
    while at < len(data):
        end = _find(data, b"\r\n\r\n", at)
        lines = bytes(data[at:end]).decode("utf-8").split("\r\n")
        if not re.fullmatch(r"WARC/1\.\d", lines[0]):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block, stop = end + 4, end + 4 + int(fields["content-length"])
        if bytes(data[stop : stop + 4]) != b"\r\n\r\n":
            raise ValueError(f"WARC record at byte {at} has no end")
        yield fields, data[_find(data, b"\r\n\r\n", block) + 4 : stop]
        at = stop + 4


def _find(data: memoryview, what: bytes, start: int) -> int:
    """Place of ``what`` at or after ``start``, looked for in growing windows (headers are short)."""
    size = 1024
    while True:
        found = bytes(data[start : start + size]).find(what)
        if found >= 0:
            return start + found
        if start + size >= len(data):
            raise ValueError(f"no header end after byte {start}")
        size *= 4


def _read(batches):
    for batch in batches:
        out = {"page_id": [], "url": [], "record_type": [], "refers_to": [], "digest": [], "length": [], "stated": []}
        for content in batch.column(0):
            for fields, payload in parse_archive(memoryview(content.as_buffer())):
                kind = fields["warc-type"]
                page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
                out["page_id"].append(None if page is None else int(page))
                out["url"].append(fields.get("warc-target-uri"))
                out["record_type"].append(kind)
                out["refers_to"].append(None if refers is None else int(refers))
                full = kind == "response"
                out["digest"].append(hashlib.sha1(payload).hexdigest() if full else None)
                out["length"].append(len(payload) if full else None)
                out["stated"].append(fields["warc-payload-digest"].partition(":")[2])
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "length": pa.int64()}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, types.get(k, pa.string())) for k, v in out.items()})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record below ``path``.

    A revisit gets the length and digest computed from the bytes of the
    response it refers to (same page and stated digest).
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(_read, "page_id long, url string, record_type string, refers_to long, digest string, length long, stated string")
    found = cut(found, "warc_records")
    responses = found.filter("record_type = 'response'")
    revisits = found.filter("record_type = 'revisit'")
    full = responses.join(revisits.select(F.col("refers_to").alias("page_id"), "stated").distinct(), ["page_id", "stated"], "left_semi")
    full = full.select(F.col("page_id").alias("refers_to"), F.col("digest").alias("d"), F.col("length").alias("l"), "stated").distinct()
    resolved = revisits.join(full, ["refers_to", "stated"], "left").select(
        "page_id", "url", F.col("l").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to"
    )
    plain = responses.select("page_id", "url", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return plain.unionByName(resolved)
