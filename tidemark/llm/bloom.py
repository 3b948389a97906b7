"""A blocked Bloom filter made of DataFrame functions: build it, test it, and use it to spare shuffles.

A hash picks one bucket of 32,768 bits and ``BITS_PER_ROW`` bits in it; the filter is a table (bucket,
bitmap) of at most ``MAX_BITS`` (128 MB) and is broadcast. A larger table of ids only fills it more, so
that more rows take the longer way, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.storage import saved

BUCKET = 32_768
MAX_BITS = 1 << 30
BITS_PER_ROW = 2


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.col(key), 32), F.lit(buckets))


def bits_of(key: str) -> list[Column]:
    return [F.shiftright(F.col(key), 15 * k).bitwiseAND(BUCKET - 1) for k in range(BITS_PER_ROW)]


def bucket_count(rows: int) -> int:
    """Power of two; 16 bits a row, within the bound of the broadcast."""
    return 1 << max(0, (min(max(16 * rows, BUCKET), MAX_BITS) - 1).bit_length() - 15)


def bitmaps(bits: DataFrame) -> DataFrame:
    """(bucket, bitmap) of a frame (bucket, bit)."""
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def flag(rows: DataFrame, key: str, seen: DataFrame, buckets: int, out: str) -> DataFrame:
    """Add whether all of a row's bits are in the filter."""
    found = F.lit(True)
    for bit in bits_of(key):
        byte = F.substring("bitmap", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        found = found & (value.bitwiseAND(F.element_at(F.lit([1 << k for k in range(8)]), bit.bitwiseAND(7).cast("int") + 1)) != 0)
    looked = rows.withColumn("__bucket", bucket_of(key, buckets)).join(
        F.broadcast(seen.withColumnRenamed("bucket", "__bucket")), "__bucket", "left")
    return looked.withColumn(out, F.coalesce(found, F.lit(False))).drop("__bucket", "bitmap")


def among(rows: DataFrame, id_col: str, ids: DataFrame, out: str = "__maybe") -> DataFrame:
    """Flag the rows whose id may be one of ``ids`` (a saved frame with a column id); no other row is."""
    buckets = bucket_count(ids.count())
    keys = ids.select(F.xxhash64("id").alias("key"))
    slots = keys.select(bucket_of("key", buckets).alias("bucket"), F.explode(F.array(*bits_of("key"))).alias("bit"))
    seen = saved(bitmaps(slots), "bloom")
    return flag(rows.withColumn("__key", F.xxhash64(F.col(f"`{id_col}`"))), "__key", seen, buckets, out).drop("__key")


def without(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is not in ``ids``; only rows that the filter can't clear are shuffled."""
    flagged = among(rows, id_col, ids)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    left = flagged.filter("__maybe").join(ids.select(F.col("id").alias("__id")), F.col(f"`{id_col}`") == F.col("__id"), "left_anti")
    return flagged.filter("not __maybe").select(*columns).unionByName(left.select(*columns))
