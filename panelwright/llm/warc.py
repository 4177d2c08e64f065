"""Web archives: deduplicated WARC files written and read by Spark, with revisit records resolved."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.tables import read
from panelwright.session import landed, scratch_path
from panelwright.sources.statistics import opened

#: Bytes of the smallest payload that is worth a revisit record.
LEAST_PAYLOAD = 100
#: Bytes that a file's records have on average before they are compressed, and those of a record besides its payload.
FILE_BYTES, HEAD_BYTES = 1 << 28, 600
#: Records handed on at a time.
BATCH = 10_000
#: Bytes of a payload read at a time.
CHUNK = 1 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
HTTP_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def page_headers(pages: DataFrame) -> DataFrame:
    """page_id, digest and bytes of every page's payload."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))


def decisions(headers: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, digest and refers_to (null for responses): the headers shuffled by payload digest.

    Of equal payloads of ``least`` bytes or more the smallest page_id keeps its
    response, the others refer to it.
    """
    groups = headers.filter(F.col("bytes") >= least).groupBy("digest")
    firsts = groups.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # written, so that the join is one of two plain tables, in which Spark splits a hot payload
    firsts = landed(firsts, "firsts")
    refers = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    return headers.join(firsts, "digest", "left").select("page_id", "digest", refers.alias("refers_to")).distinct()


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def records(pages: DataFrame, decided: DataFrame, date: str) -> DataFrame:
    """``record``: the text of each page's WARC record without the empty lines that end it.

    Headers are made anew.  A revisit holds the HTTP headers, not the payload.
    """
    payload = F.coalesce("html", F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    is_revisit = F.col("refers_to").isNotNull()
    block = F.concat(
        F.lit(HTTP_HEADERS), _line("Content-Length", F.octet_length(payload).cast("string")), F.lit("\r\n"),
        F.when(is_revisit, F.lit("")).otherwise(payload),
    )
    # a header is one line, whatever the address holds
    address = F.regexp_replace(F.coalesce("url", F.concat(F.lit(ID_PREFIX), page)), r"[\x00-\x1F\x7F]", "")
    referred = F.when(
        is_revisit,
        F.concat(
            F.lit(f"WARC-Refers-To: <{ID_PREFIX}"), F.col("refers_to").cast("string"), F.lit(">\r\n"),
            _line("WARC-Profile", REVISIT_PROFILE),
        ),
    ).otherwise(F.lit(""))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{ID_PREFIX}"), page, F.lit(">"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", address),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        referred,
        _line("Content-Type", "application/http;msgtype=response"),
        _line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    own = pages.select("page_id", "url", "html").withColumn("digest", F.sha2(payload, 256))
    chosen = decided.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    joined = own.join(chosen, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    return joined.withColumn("block", block).select(F.concat(head, F.col("block")).alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_PAYLOAD, date: str = "2026-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into gzipped WARC files below ``path``.

    Null html is an empty payload; payloads below ``least`` bytes are never
    revisits.  A null page_id is a response of its own, named ``null``; repeated
    rows give repeated records, responses all if they are those of the smallest
    id.  No rows give files without records.  Other columns are not read.

    How many records a file takes follows from the mean size of the payloads.
    """
    # written, so that payloads are hashed once for the decisions and the mean
    headers = landed(page_headers(pages), "headers")
    decided = decisions(headers, least)
    mean = headers.agg(F.avg("bytes")).first()[0] or 0
    (
        records(pages, decided, date)
        .write.option("compression", "gzip")
        .option("lineSep", END)
        .option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + HEAD_BYTES))))
        .text(path)
    )


def parse_archive(content: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], int, str]]:
    """(headers, bytes of the payload, SHA-256 of the payload) of every record of a gzipped archive, read as a stream.

    ``content`` is the archive or an open file of it.  Headers come with names in lower case.  A damaged record raises.
    """
    with gzip.GzipFile(fileobj=io.BytesIO(content) if isinstance(content, bytes) else content) as stream:
        while version := stream.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"not the start of a WARC record: {version[:40]!r}")
            headers = {}
            while (line := stream.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.strip().lower()] = value.strip()
            left = int(headers["content-length"])
            while left:
                line = stream.readline(left)
                left -= len(line)
                if line == b"\r\n":
                    break
                if not line:
                    raise ValueError("the archive ends inside a record")
            digest, size = hashlib.sha256(), left
            while left:
                part = stream.read(min(left, CHUNK))
                if not part:
                    raise ValueError("the archive ends inside a record")
                digest.update(part)
                left -= len(part)
            if stream.read(4) != END.encode():
                raise ValueError("a record does not end with two empty lines")
            yield headers, size, digest.hexdigest()


_RECORD = {
    "record_id": pa.string(), "record_type": pa.string(), "target": pa.string(), "refers_to_id": pa.string(),
    "stated_digest": pa.string(), "bytes": pa.int64(), "digest": pa.string(),
}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, target, refers_to_id, stated_digest, bytes and digest of every record below ``path``.

    ``bytes`` and ``digest`` are those of the payload that the record holds.  A
    file is read by one task, which opens it by its path and holds a chunk of it
    and ``BATCH`` rows, whatever its size.
    """

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in _RECORD]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RECORD.values())], list(_RECORD))


    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("path").to_pylist():
                rows = []
                with opened(place) as archive:
                    for headers, size, digest in parse_archive(archive):
                        rows.append((
                            headers["warc-record-id"].strip("<>"), headers["warc-type"], headers.get("warc-target-uri"),
                            headers.get("warc-refers-to", "").strip("<>") or None,
                            headers.get("warc-payload-digest", "").removeprefix("sha256:") or None, size, digest,
                        ))
                        if len(rows) == BATCH:
                            yield table(rows)
                            rows = []
                yield table(rows)

    # only the paths are selected, so no content is read here
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path")
    return files.mapInArrow(run, "record_id string, record_type string, target string, refers_to_id string, "
                                 "stated_digest string, bytes long, digest string")


def resolved(read_back: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: revisits with the payload of their response.

    Revisit records are joined to the responses they refer to by id and stated
    digest.  A revisit whose response is missing keeps its stated digest and has
    null bytes.
    """
    page = lambda name: F.substring(F.col(name), len(ID_PREFIX) + 1, 40).try_cast("long")
    responses = read_back.filter("record_type = 'response'").select(
        page("record_id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = read_back.filter("record_type = 'revisit'").select(
        page("record_id").alias("page_id"), "record_type", page("refers_to_id").alias("refers_to"), "stated_digest"
    )
    originals = (
        responses.select(F.col("page_id").alias("original"), "payload_bytes", "payload_digest").filter("original IS NOT NULL").distinct()
    )
    found = revisits.join(
        originals, (F.col("refers_to") == F.col("original")) & (F.col("stated_digest") == F.col("payload_digest")), "left"
    ).select(
        "page_id", "payload_bytes", F.coalesce("payload_digest", "stated_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.select(found.columns).unionByName(found)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path)
    return resolved(read_archives(spark, path))


OP7_SQL = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST_PAYLOAD} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts
"""
