"""Exact deduplication by two-pass Bloom filtering, with DataFrame functions only.

The first pass sets, for every text's hash, two bits in one bucket of a blocked Bloom filter, and keeps
the bits that two or more rows set. The second pass tests every hash against that filter: a row whose
bits are not all kept has no equal and passes straight through; only the others shuffle, where the full
SHA-256 decides. The filter is broadcast; it has 16 bits a row, at most 128 MB. A larger table only
sends more rows through the shuffle, with the same result.

Texts are equal when identical after lower-casing A-Z. Defined results: null counts as empty; of equal
texts the row with the largest id stays, a null id counting as the smallest; of repeated rows with that
id one stays; columns other than id and text are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.bloom import bitmaps, bits_of, bucket_count, bucket_of, flag
from tidemark.llm.storage import ascii_lower, saved

def _normal(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def repeated_filter(hashes: DataFrame, key: str, buckets: int) -> DataFrame:
    """First pass: (bucket, bitmap) of the bits that two or more rows set."""
    slots = hashes.select(bucket_of(key, buckets).alias("bucket"), F.explode(F.array_distinct(F.array(*bits_of(key)))).alias("bit"))
    return bitmaps(slots.groupBy("bucket", "bit").agg(F.count("*").alias("n")).filter("n > 1"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, SHA-256 and 64-bit hash of every normalised text, kept in the shared folder."""
    normal = docs.select(F.col(f"`{id_col}`").alias("id"), _normal(text_col).alias("normal"))
    return saved(normal.select("id", F.sha2("normal", 256).alias("text_sha256"), F.xxhash64("normal").alias("key")), "digests")


def decide(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """keep_id, group_size and kept for every row of ``digests``; also the filter and its buckets."""
    buckets = bucket_count(rows.count())
    seen = saved(repeated_filter(rows, "key", buckets), "bloom")
    flagged = flag(rows.withColumn("row", F.monotonically_increasing_id()), "key", seen, buckets, "maybe")
    alone = flagged.filter("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    some = flagged.filter("maybe")
    groups = some.groupBy("text_sha256").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
    joined = some.join(groups.hint("rebalance"), "text_sha256").select(  # a shuffle of its own, so that a hot text is split
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
    return alone.unionByName(joined), seen, buckets


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept and text_sha256 of every row."""
    return decide(digests(docs, id_col, text_col))[0].withColumnRenamed("id", id_col)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rows without an equal don't shuffle."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    decisions, seen, buckets = decide(digests(docs, id_col, text_col))
    flagged = flag(docs.withColumn("__key", F.xxhash64(_normal(text_col))), "__key", seen, buckets, "__maybe")
    some = flagged.filter("__maybe").withColumn("__sha", F.sha2(_normal(text_col), 256))
    stay = decisions.filter("kept").select(F.col("id").alias("__id"), F.col("text_sha256").alias("__kept_sha"))
    return flagged.filter("not __maybe").select(*columns).unionByName(
        some.join(stay, (F.col("__sha") == F.col("__kept_sha")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left_semi")
        .dropDuplicates(["__sha", id_col]).select(*columns))


def of_documents(docs: DataFrame) -> DataFrame:
    """Every document's group and whether it stays."""
    return exact_groups(docs)


ORACLE = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
     g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN g USING (x)"""
