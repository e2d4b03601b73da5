"""WARC archives with revisit records for payloads that were captured before.

Writing: only headers (id, digest, length) are shuffled, by digest, to find the capture that
keeps the payload; payloads meet that decision by id and are written where they are. An archive
is plain WARC/1.1 in gzip: Spark's text writer puts each record, a text of header lines and
block, and the two line ends between records. So archives go wherever Spark can write.

Records go to files by size class (CLASSES), so a file is bounded in bytes: full files of any class
hold FILE_BYTES of payload at most, and a payload above that has a file of its own.

Reading: compressed files come from Spark's binaryFile reader, are unpacked as a stream and cut by
Content-Length, one record at a time; the headers are stored once, and revisit records are joined
there with the responses that they refer to.

Null html is an empty payload. Pages without id are always responses, with no page id. Rows equal in id
and payload are all responses, or all revisits of a larger id; one id with several payloads is a page
for each. Own columns beside page_id, url and html are left out.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.storage import keep

LEAST_BYTES = 1000  # smaller payloads are always stored
FILE_BYTES = 256 << 20
CLASSES = (64 << 10, 1 << 20, 16 << 20, FILE_BYTES, None)  # payload bytes up to which a record is of a class
SENT_BYTES, SENT_ROWS = 8 << 20, 1000  # of records that a reader gathers before they are sent off
DATE = "2024-07-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest (lower-case hex SHA-1)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"))


def revisits(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, payload_digest, refers_to: the captures whose payload a larger page_id keeps.

    Largest ids are found with map-side combine, and only digests that several ids share are
    joined back, so a digest with a third of all pages is one row of the sums; the join's rows
    for it can be split, as nothing above the join needs them together.
    """
    large = headers.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", "payload_digest")
    originals = large.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("_least")).where("_least < refers_to").drop("_least")
    return large.join(originals, "payload_digest").where("page_id < refers_to").distinct()


def record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(END)) for name, value in fields])


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, stored: payloads are hashed once to find revisits."""
    return keep(digests(pages).select("page_id", "payload_bytes", "payload_digest"), "warc-headers")


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES, date: str = DATE, seen: DataFrame | None = None) -> DataFrame:
    """value: one WARC record per page, without the two line ends that follow it.

    Control characters and spaces in a URL are percent-encoded; a null URL has no target field.
    ``seen`` has the revisits, if ``pages`` are only a part of those that may repeat each other.
    """
    all_pages = digests(pages)
    seen = revisits(headers(pages), least_bytes) if seen is None else seen
    rows = all_pages.join(seen, ["page_id", "payload_digest"], "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END + END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), r"[\x00-\x20]", "%20")
    head = _lines(
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(again, PROFILE)),
        ("WARC-Refers-To", F.when(again, record_id(F.col("refers_to"), F.col("payload_digest")))),
        ("WARC-Refers-To-Date", F.when(again, date)),
        ("WARC-Page-ID", F.col("page_id").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(F.lit(f"WARC/1.1{END}"), head, F.lit(END), block).alias("value"))


def records_per_file(up_to: int | None) -> int:
    """So many records of at most ``up_to`` bytes hold FILE_BYTES; one, without that limit."""
    return 1 if up_to is None else max(1, FILE_BYTES // up_to)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Archives of each size class that occurs, at least one a task. An empty table leaves no record."""
    heads = headers(pages)
    seen = keep(revisits(heads, least_bytes), "warc-revisits")
    longest = heads.agg(F.max("payload_bytes").alias("longest")).first().longest or 0
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    above = -1
    for up_to in CLASSES:
        of_class = (size > above) if up_to is None else (size > above) & (size <= up_to)
        (records(pages.where(of_class), least_bytes, seen=seen).write.mode("error" if above < 0 else "append")
         .option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file(up_to)).text(path))
        if up_to is None or longest <= up_to:
            break
        above = up_to


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, read one by one."""
    while version := archive.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:80]!r}")
        fields = {}
        while line := archive.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = archive.read(length)
        if len(block) < length or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record without end: {fields.get('warc-record-id')}")
        yield fields, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, url, record_type, refers_to_id, payload (null in revisits), payload_bytes,
    payload_digest; the last two are taken anew from a response's payload."""

    def sent(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
        out["page_id"], out["payload_bytes"] = (out[c].astype("Int64") for c in ("page_id", "payload_bytes"))
        return out

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch.content:
                rows, gathered = [], 0
                with gzip.open(io.BytesIO(content)) as archive:
                    for fields, block in parse(archive):
                        kind, page = fields["warc-type"], fields.get("warc-page-id")
                        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        rows.append((fields["warc-record-id"], page and int(page), fields.get("warc-target-uri"), kind, fields.get("warc-refers-to"), payload, None if payload is None else len(payload), None if payload is None else hashlib.sha1(payload).hexdigest()))
                        gathered += len(block)
                        if gathered >= SENT_BYTES or len(rows) >= SENT_ROWS:
                            yield sent(rows)
                            rows, gathered = [], 0
                if rows:
                    yield sent(rows)

    schema = "record_id string, page_id long, url string, record_type string, refers_to_id string, payload binary, payload_bytes long, payload_digest string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(read, schema)


def resolve(read: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to: each capture with the
    figures of its full payload; revisits take them from the response that they refer to. Archives are
    read once: what remains without payloads is stored."""
    read = keep(read.drop("payload"), "warc-read")
    responses = read.where("record_type = 'response'").select("page_id", "url", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    back = read.where("record_type = 'revisit'").select("page_id", "url", "record_type", F.col("refers_to_id").alias("record_id"))
    kept = read.where("record_type = 'response'").groupBy("record_id").agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    return responses.unionByName(back.join(kept, "record_id").drop("record_id"))
