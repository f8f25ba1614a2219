"""WARC archives with revisit records in place of repeated payloads, written and read back by Spark."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.session import fresh_path, staged

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
READ_SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean, payload string"
)


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: each ten hexadecimal digits are 40 bits, hence eight letters."""
    digest = F.sha1(payload.cast("binary"))
    letters = []
    for group in range(4):
        bits = F.conv(F.substring(digest, 10 * group + 1, 10), 16, 10).cast("long")
        for at in range(35, -1, -5):
            index = F.shiftright(bits, at).bitwiseAND(F.lit(31)).cast("int") + 1
            letters.append(F.substr(F.lit(BASE32), index, F.lit(1)))
    return F.concat(*letters)


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and ``refers_url``.

    Only headers (identifier, url, size, digest) are shuffled by digest, after each task has kept the
    smallest of each of its digests. Digests of one page need no lookup, so only repeated ones are
    staged and joined back; adaptive execution broadcasts that table when it is small and splits a
    digest that many pages share when it is not.
    """
    headed = pages.withColumn("_payload", F.coalesce("html", F.lit(""))).withColumns({
        "payload_bytes": F.octet_length("_payload").cast("long"), "payload_digest": payload_digest(F.col("_payload")),
    })
    originals = staged(
        headed.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("no"), F.col("page_id").alias("id"), F.col("url").alias("url"))).alias("_first"),
             F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select("_digest", F.col("_first.id").alias("_id"), F.col("_first.url").alias("_url")),
        "originals",
    )
    joined = headed.join(
        originals, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes), "left")
    again = F.col("_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_id"))
    return joined.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in ("payload_bytes", "payload_digest", "record_type", "refers_to", "refers_url")],
        "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_id")).alias("refers_to"),
        F.when(again, F.col("_url")).alias("refers_url"),
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line breaks in the value are percent-encoded."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def warc_record(date: str) -> Column:
    """Header and block of one record, without the two line breaks that end it."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    is_response = F.col("record_type") == "response"
    block = F.concat(http, F.when(is_response, F.coalesce("html", F.lit(""))).otherwise(F.lit("")))
    urn = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", urn(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(~is_response, F.lit(REVISIT_PROFILE))),
        _field("WARC-Refers-To", F.when(~is_response, urn(F.col("refers_to")))),
        _field("WARC-Refers-To-Target-URI", F.when(~is_response, F.col("refers_url"))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    return F.concat(head, block)


def write_archives(pages: DataFrame, path: str, *, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_records: int = 4_000) -> None:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``) as gzipped WARC files below ``path``.

    A record is one value of Spark's text sink with the end of a record as the line separator; so
    the sink's committer keeps exactly one attempt of each task, and a lost executor leaves nothing
    behind. Of equal payloads of at least ``min_bytes`` bytes the smallest ``page_id`` is the response and
    the others revisit it. Repeated rows of that page are all responses; a null identifier comes
    after all others; a null payload counts as an empty one; a null url leaves its field out.
    """
    rows = resolve_revisits(pages.select("page_id", "url", "html"), min_bytes)
    writer = rows.select(warc_record(date).alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", file_records).text(path)


def _records(body: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record, cut by Content-Length."""
    at = 0
    while at < len(body):
        end = body.index(RECORD_END.encode(), at)
        lines = body[at:end].decode().split(CRLF)
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        yield fields, body[start:stop]
        at = stop + 4


def _number(urn: str | None) -> int | None:
    value = urn.strip("<>").removeprefix(ID_PREFIX) if urn else "none"
    return None if value == "none" else int(value)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``, a file per task row: headers, whether a response's
    payload has the digest in its header (``intact``; null for revisits), and the payload itself."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                out = []
                for fields, block in _records(zlib.decompress(content, 31)):
                    head, _, payload = block.partition(RECORD_END.encode())
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = fields["WARC-Type"] == "response"
                    length = int(dict(x.split(": ", 1) for x in head.decode().split(CRLF)[1:])["Content-Length"])
                    intact = None
                    if response:
                        intact = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest and len(payload) == length
                    out.append((
                        _number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"], length, digest,
                        _number(fields.get("WARC-Refers-To")), intact, payload.decode() if payloads and response else None,
                    ))
                names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
                frame = pd.DataFrame(out, columns=names, dtype=object)
                yield frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(parse, READ_SCHEMA)


def archive_round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to a fresh folder of archives and read the headers back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes=min_bytes)
    return read_archives(pages.sparkSession, path, payloads=False)
