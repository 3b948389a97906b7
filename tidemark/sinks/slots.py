"""Idempotent slot writes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.sources.partitions import register_partition, slot_dir

# The formats of the receivers.
FORMATS = {
    "parquet": ("parquet", {"compression": "snappy"}),
    "json": ("json", {"compression": "gzip"}),
    "tsv": ("csv", {"sep": "\t", "compression": "gzip"}),
}


@dataclass(frozen=True)
class Written:
    path: str
    rows: int


def write_slot(df: DataFrame, path: str, at, fmt: str = "parquet", on_empty: str = "keep",
               bucket_by: str | None = None, buckets: int = 10, spread: int = 1, table: str | None = None) -> Written:
    """Replace one slot; running it again gives the same files' worth of rows.

    Rows are written beside the slot and counted on the way; only then the policy for an empty result
    (``on_empty`` = keep | skip | fail) decides, so a skipped or failed run leaves the old slot as it
    was. ``bucket_by`` writes one file per hash bucket, or ``spread`` files for each when single values
    hold a large share of the rows. With ``table`` the slot is registered as its partition.
    """
    kind, options = FORMATS[fmt]
    base = path.rstrip("/")
    target = f"{base}/{slot_dir(at)}"
    staging = f"{base}/_staging/{uuid.uuid4().hex}"
    counted = Observation(f"slot {at}")
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if bucket_by:
        salt = [F.pmod(F.xxhash64(*df.columns), F.lit(spread))] if spread > 1 else []
        rows = rows.repartition(buckets * spread, bucket_by, *salt)
    rows.write.format(kind).options(**options).mode("overwrite").save(staging)
    n = counted.get["rows"]
    if n == 0 and on_empty in ("skip", "fail"):
        _delete(df.sparkSession, staging)
        if on_empty == "fail":
            raise ValueError(f"slot {at} has no rows")
        return Written(target, 0)
    replace_folder(df.sparkSession, staging, target)
    if table:
        register_partition(df.sparkSession, table, df.schema.simpleString()[7:-1].replace(":", " "), at, target, kind, base)
    return Written(target, n)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the function that makes paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _delete(spark: SparkSession, path: str) -> None:
    fs, make = _file_system(spark, path)
    fs.delete(make(path), True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a folder in another's place; every rename is checked, and the old folder is deleted last.

    Between the two renames the path does not exist for a moment; a refused rename puts it back.
    """
    fs, make = _file_system(spark, path)
    old = f"{new}.old"

    def moved(a: str, b: str) -> bool:
        try:
            return fs.rename(make(a), make(b))
        except Py4JJavaError:
            return False

    fs.mkdirs(make(path).getParent())
    had = fs.exists(make(path))
    if had and not moved(path, old):
        raise OSError(f"{path} could not be moved away; the new files are in {new}")
    if not moved(new, path):
        if had and not moved(old, path):
            raise OSError(f"{path} could not be put back; its files are in {old}, the new ones in {new}")
        raise OSError(f"{new} could not be moved to {path}, which is as it was")
    if had:
        fs.delete(make(old), True)


def overwrite_slots(df: DataFrame, path: str, slot: str = "partition_timestamp") -> None:
    """Replace exactly the slots that occur in the frame; large slots get several writers."""
    (df.hint("rebalance", F.col(slot)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(slot).parquet(path))


def fan_out(df: DataFrame, col: str, values: list, path: str, fmt: str = "parquet") -> None:
    """One folder per listed value, written in a single pass over the input."""
    kind, options = FORMATS[fmt]
    (df.filter(F.col(col).isin(*values)).write.format(kind).options(**options)
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).save(path))


def swap_table(df: DataFrame, path: str) -> None:
    """Write a new full table beside the old one and swap the folders.

    The job may read the old table while it runs; a crash before the swap leaves it untouched.
    """
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(staging)
    replace_folder(df.sparkSession, staging, path)
