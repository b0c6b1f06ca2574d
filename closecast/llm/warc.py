"""WARC archives: writing, reading and revisit resolution.

Archives are written by Spark's own text writer: a record is one value, the
line separator is the two line breaks that end every record, and the files are
gzip streams. Tasks that are lost and run again therefore leave whole
archives. Reading walks a file's records by Content-Length, one record in
memory at a time.

Revisit resolution: only headers (id, payload digest, payload length) are
shuffled by digest. Of the records with equal payloads of at least
``min_bytes`` bytes the one with the largest key stays a response; the others
become revisit records that name it. The answers return to the payloads by
key, so equal payloads never meet in one task. A revisit keeps its HTTP headers,
with the full payload's Content-Length, and no body.

Defined cases: a null payload is empty, and empty payloads are equal payloads;
payloads shorter than ``min_bytes`` are all responses; rows with equal keys
and payloads get the same type, and rows with a null key refer to the group's
largest key like others, or are responses where the group has no key; a null
url leaves an address made of the key; control characters in a url are
dropped; an empty table writes no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closecast.llm.common import KeyFilter, checkpointed
from closecast.session import ensure_checkpoint_dir

RECORDS_PER_FILE = 2000  # bounds a file for its reader
DATE = "1970-01-01T00:00:00Z"  # of pages that carry no capture time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
_ID = "urn:x-page:"
RECORD = "record_id string, record_type string, uri string, date string, payload_digest string, refers_to string, payload_bytes long, payload_ok boolean"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string or binary column."""
    digest = F.sha1(payload.cast("binary"))
    # five hex digits are four base-32 digits, first as 0-9A-V
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` (key, url, payload string) with payload, payload_bytes, payload_digest, record_type and refers_to.

    Shuffles headers by digest, then brings the revisits' answers back by key.
    """
    full = records.withColumn("payload", F.coalesce("payload", F.lit("")))
    full = full.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    headers = full.select("key", "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= min_bytes)
    # groups of one record need no answer; a hot digest is one partial row for each task
    groups = headers.groupBy("payload_digest", "payload_bytes").agg(F.max("key").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = headers.join(groups, ["payload_digest", "payload_bytes"]).where(F.col("keeper").isNotNull() & ~F.col("key").eqNullSafe(F.col("keeper")))
    revisits = checkpointed(revisits.select("key", "payload_digest", "keeper").distinct())
    split = KeyFilter(revisits.select("payload_digest")).split(full, "payload_digest")
    found = revisits.select(F.col("key").alias("__key"), F.col("payload_digest").alias("__digest"), "keeper")
    maybe = split.where("maybe").join(found, F.col("key").eqNullSafe(F.col("__key")) & (F.col("payload_digest") == F.col("__digest")), "left")
    alone = split.where("not maybe").withColumn("keeper", F.lit(None).cast(records.schema["key"].dataType))
    both = maybe.drop("maybe", "__key", "__digest").unionByName(alone.drop("maybe"))
    return both.withColumn("record_type", F.when(F.col("keeper").isNull(), "response").otherwise("revisit")).withColumnRenamed("keeper", "refers_to")


def _record(date: str) -> Column:
    """A record's text, but for the line breaks that end it."""
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", ""), F.concat(F.lit(_ID), F.coalesce(F.col("key").cast("string"), F.lit("none"))))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")), F.concat(F.lit("WARC-Record-ID: "), name(F.col("key"))),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")), F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), block)  # concat_ws leaves out nulls


def write_warc(resolved: DataFrame, path: str, date: str = DATE) -> None:
    """Archives of the records of ``resolve_revisits``, with fresh headers, under ``path``."""
    (resolved.select(_record(date).alias("value")).write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of a binary stream."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        for raw in iter(stream.readline, b""):
            if raw in (b"\r\n", b"\n"):
                break
            k, _, v = raw.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("a record ends before its Content-Length")
        yield headers, block


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c, pa.string()) for c in ("record_id", "record_type", "uri", "date", "payload_digest", "refers_to")] + [("payload_bytes", pa.int64()), ("payload_ok", pa.bool_())])
    for batch in batches:
        for content in batch.column("content"):
            raw = pa.BufferReader(content.as_buffer())
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b" else io.BytesIO(content.as_py()))
            rows = []
            for h, block in parse_records(stream):
                head, _, body = block.partition(b"\r\n\r\n")
                http = dict(x.split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
                size = next((int(v) for k, v in http.items() if k.strip().lower() == b"content-length"), len(body))
                digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                whole = h.get("warc-type") == "response"
                rows.append({"record_id": h.get("warc-record-id", "").strip("<>"), "record_type": h.get("warc-type"), "uri": h.get("warc-target-uri"),
                             "date": h.get("warc-date"), "payload_digest": digest, "refers_to": h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                             "payload_bytes": len(body) if whole else size, "payload_ok": not whole or (_sha1(body) == digest and len(body) == size)})
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: RECORD. payload_ok: a response's payload has its stated digest and length."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(_parsed, RECORD)


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) written as deduplicated archives under ``path`` and read back, one row per record.

    page_id, payload_bytes, payload_digest, record_type, refers_to, uri, payload_ok.
    """
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = pages.select(F.col("page_id").cast("long").alias("key"), F.col("url").cast("string").alias("url"), F.col("html").alias("payload"))
    write_warc(resolve_revisits(records, min_bytes), path)
    got = read_warc(spark, path)
    key = lambda c: F.expr(f"try_cast(substring({c}, {len(_ID) + 1}) AS BIGINT)")
    return got.select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to"), "uri", "payload_ok")
