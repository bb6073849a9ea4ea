"""WARC archives with revisit records for repeated payloads.

Headers (id, payload digest, length) are shuffled by digest. Of records with one digest and at least ``MIN_BYTES`` the
one with the smallest id is the original; the others become revisit records that refer to it and carry no payload. Every
record gets fresh headers. Archives are written by Spark's text writer: a record ends with two line breaks, which is the
writer's line separator, so records of any number go to splittable files on any store Spark reaches. The record id
stands first among the headers and starts with a random name of the run, so the reader can tell record starts from
payload content that looks like one.

Scale: only the digests that occur twice or more are joined back to the pages; a hot digest is one row there, and
adaptive execution splits its pages. Payloads of originals are written once.

Edge cases: a null payload is empty. Null ids never become originals while another id exists; records without an
original are responses. Records that tie in the smallest id are all responses. Line breaks and percent signs in a URL
are percent-encoded in the header. An empty table writes an empty archive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise, scratch_dir

MIN_BYTES = 100
RECORD_END = "\r\n\r\n"
# fixed values: header names and the revisit profile of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(run: str, page_id: Column, digest: Column) -> Column:
    """A record id that starts with the name of the run."""
    h = F.md5(F.concat_ws("/", F.lit(run), F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    parts = [F.lit(run[:8])] + [F.substring(h, a, n) for a, n in ((9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages with ``payload``, ``digest``, ``n_bytes`` and ``original`` (null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2(F.col("payload").cast("binary"), 256).alias("digest"),
        F.octet_length("payload").cast("long").alias("n_bytes"),
    )
    headers = rows.filter(F.col("n_bytes") >= min_bytes)
    shared = headers.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = materialise(shared.filter("n > 1 and first is not null").select("digest", "first"), "shared_payloads")
    original = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return rows.join(shared, "digest", "left").withColumn("original", original)


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, compression: str = "gzip") -> str:
    """Write archives below ``path``; returns the name of the run, which the reader needs."""
    run = uuid.uuid4().hex
    rows = resolve(pages, min_bytes)
    revisit = F.col("original").isNotNull()
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    fields = [
        F.lit(VERSION),
        line("WARC-Record-ID", _urn(run, F.col("page_id"), F.col("digest"))),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Profile: "), F.lit(PROFILE))),
        F.when(revisit, line("WARC-Refers-To", _urn(run, F.col("original"), F.col("digest")))),
        F.when(revisit, line("X-Refers-To-Page", F.col("original"))),
        line("X-Page-ID", F.col("page_id")),
        line("X-Payload-Length", F.col("n_bytes")),
        F.lit("Content-Type: text/html;charset=utf-8"),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))),
    ]
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", compression).text(path)
    return run


def read(spark: SparkSession, path: str, run: str) -> DataFrame:
    """Records of archives written by ``write``: ``headers`` (map) and ``payload`` (exactly Content-Length bytes)."""
    mark = f"{VERSION}\r\nWARC-Record-ID: <urn:uuid:{run[:8]}-"
    lines = spark.read.option("lineSep", mark).text(path).filter(F.length("value") > 0)
    cut = F.locate("\r\n\r\n", F.col("value"))
    # what follows the record start in the first line is the rest of its id
    head = F.concat(F.lit(f"WARC-Record-ID: <urn:uuid:{run[:8]}-"), F.substring(F.col("value"), F.lit(1), cut - 1))
    headers = F.str_to_map(head, F.lit("\r\n"), F.lit(": "))
    body = F.substring(F.col("value"), cut + 4, F.length("value")).cast("binary")
    length = F.element_at(headers, "Content-Length").cast("int")
    return lines.select(headers.alias("headers"), F.substring(body, F.lit(1), length).alias("payload"))


def records(archives: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_bytes`` and ``payload_digest`` of each record.

    For responses length and digest are taken from the payload that was read, for revisits from their headers.
    """
    get = lambda name: F.element_at("headers", name)
    own = get("WARC-Type") == "response"
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(get("WARC-Target-URI"), "%0A", "\n"), "%0D", "\r"), "%25", "%")
    return archives.select(
        get("X-Page-ID").cast("long").alias("page_id"), url.alias("url"), get("WARC-Type").alias("record_type"),
        get("X-Refers-To-Page").cast("long").alias("refers_to"),
        F.when(own, F.octet_length("payload")).otherwise(get("X-Payload-Length")).cast("long").alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.substring(get("WARC-Payload-Digest"), F.lit(8), F.lit(64)))
        .alias("payload_digest"),
    )


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages to fresh archives in the shared folder and read their records."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    run = write(pages, path, min_bytes)
    return records(read(spark, path, run))
