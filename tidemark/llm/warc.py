"""WARC archives with revisit records for repeated payloads.

Writing: only headers (id, digest, length) are shuffled, by payload digest. Of the records with equal
payloads of at least ``min_bytes``, that with the largest id becomes the response; the others become
revisit records, joined to it by the digest, and carry no payload. All records get fresh headers and are
written through Spark's text writer, gzip-compressed, to the shared folder: a record is one value and the
record separator (two line ends) is the writer's separator, so every file is a valid archive, and lost
executors are covered by the commit protocol.

Reading: each file (of at most ``PER_FILE`` records) is read whole by one task and cut by its headers'
lengths; revisit records get the payload's length and owner by a join to the responses on the digest.

Defined results: a null payload is empty; payloads below ``min_bytes`` are always responses; a null id
counts as the smallest, and is written as an empty id; of repeated rows with the largest id all are
responses; other columns are not looked at; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.storage import saved
from tidemark.session import scratch_dir

PER_FILE = 5_000
SEPARATOR = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
MIN_BYTES = 1000
HEADER_SCHEMA = ("page_id bigint, url string, record_id string, record_type string, payload_digest string, "
                 "payload_bytes bigint, refers_to_id string, payload binary")


def headers(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """id, url, digest and length of every payload."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    return pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))


def revisits(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, digest, response id) of the records that revisit another; ``rows`` are headers."""
    large = rows.filter(F.col("size") >= min_bytes)
    owners = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1")
    joined = large.join(owners.drop("n").hint("rebalance"), "digest")  # so that a hot digest is split
    return joined.filter(~F.col("page_id").eqNullSafe(F.col("response"))).select("page_id", "url", "digest", "response")


def _record_id(page_id: Column) -> Column:
    """A name-based UUID of the id."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _lines(kind: str, extra: dict[str, Column], length: Column) -> Column:
    """Fresh header lines; a line end inside a value would break the record and becomes a blank."""
    fields = {"WARC-Type": F.lit(kind), "WARC-Record-ID": _record_id(F.col("page_id")),
              "WARC-Date": F.lit(DATE), "WARC-Target-URI": F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " "),
              "X-Source-ID": F.coalesce(F.col("page_id").cast("string"), F.lit("")),
              "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")), **extra,
              "Content-Type": F.lit("text/html; charset=utf-8"), "Content-Length": length.cast("string")}
    lines = [part for name, value in fields.items() for part in (F.lit(f"{name}: "), value, F.lit("\r\n"))]
    return F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = MIN_BYTES) -> None:
    """Write responses and revisit records of all pages below ``folder``."""
    rows = headers(pages, id_col, url_col, payload_col)
    again = saved(revisits(rows.drop("payload"), min_bytes), "revisits")
    known = again.select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    full = rows.join(known, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left_anti")
    body = F.concat(_lines("response", {}, F.col("size")), F.col("payload"))
    _put(full.select(body.alias("value")), f"{folder}/responses")
    extra = {"WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
             "WARC-Refers-To": _record_id(F.col("response"))}
    _put(again.select(_lines("revisit", extra, F.lit(0)).alias("value")), f"{folder}/revisits")


def _put(records: DataFrame, path: str) -> None:
    records.write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", PER_FILE).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        begin = end + 4
        at = begin + int(fields["content-length"])
        yield fields, data[begin:at]
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record of the archives below ``folder``, payload included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(folder).select("content")
    names = [f.split()[0] for f in HEADER_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parse(zlib.decompress(content.as_buffer(), wbits=31)):
                    source = fields["x-source-id"]
                    rows.append((int(source) if source else None, fields["warc-target-uri"], fields["warc-record-id"], fields["warc-type"],
                                 fields["warc-payload-digest"].removeprefix("sha1:"), len(block), fields.get("warc-refers-to"), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield _batch(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, HEADER_SCHEMA)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def resolve(records: DataFrame) -> DataFrame:
    """Headers of all records; revisits take length and owner from the response they refer to."""
    plain = records.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    owners = records.filter("record_type = 'response'").groupBy("record_id", "payload_digest").agg(
        F.max("page_id").alias("owner"), F.max("payload_bytes").alias("bytes")).withColumnRenamed("record_id", "refers_to_id").hint("rebalance")
    again = records.filter("record_type = 'revisit'").drop("payload", "payload_bytes").join(
        owners, ["payload_digest", "refers_to_id"], "left")
    return plain.unionByName(again.select(
        "page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("owner").alias("refers_to")))


def of_pages(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and return each record's resolved header."""
    folder = scratch_dir(pages.sparkSession, "warc")
    write(pages, folder)
    return resolve(read(pages.sparkSession, folder))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
     g AS (SELECT d, max(page_id) AS top FROM h WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM h LEFT JOIN g USING (d)"""
