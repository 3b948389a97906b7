"""Hourly partitions over external paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import NTZ, to_datetime
from tidemark.operators.slots import SLOT


def slot_dir(ts) -> str:
    """Directory of an hour slot below the table path."""
    return to_datetime(ts).strftime("year=%Y/month=%m/day=%d/hour=%H")


def create_slot_table(spark: SparkSession, table: str, schema: str, root: str, fmt: str = "parquet", slot: str = SLOT) -> None:
    """Create the external table of hour slots if it is missing."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}, {slot} TIMESTAMP_NTZ) USING {fmt} "
              f"PARTITIONED BY ({slot}) LOCATION '{root}'")


def register_partition(spark: SparkSession, table: str, schema: str, at, location: str,
                       fmt: str = "parquet", base: str | None = None, slot: str = SLOT) -> None:
    """Create the external table if it is missing and add one slot; repeating it changes nothing.

    The slot's value and its directory are independent, as the location is given.
    """
    create_slot_table(spark, table, schema, base or location.rsplit("/year=", 1)[0], fmt, slot)
    value = to_datetime(at).strftime("%Y-%m-%d %H:%M:%S")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({slot}='{value}') LOCATION '{location}'")


def read_slots(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet",
               slot: str = SLOT) -> DataFrame:
    """Path-only form: year/month/day/hour directories become the slot column.

    Filters on the directory columns prune; ``slot_filter`` builds them from a time range.
    """
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    made = F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    return df.withColumn(slot, made.cast(NTZ))


def slot_filter(start, end):
    """Directory predicate of the slots in [start, end); combine it with the exact slot predicate."""
    lo, hi = to_datetime(start), to_datetime(end)
    stamp = F.col("year") * 1000000 + F.col("month") * 10000 + F.col("day") * 100 + F.col("hour")
    return (stamp >= int(lo.strftime("%Y%m%d%H"))) & (stamp < int(hi.strftime("%Y%m%d%H")) + (hi.minute > 0))


def expand_catalog(template, entries: list[dict]) -> DataFrame:
    """One table spec applied to many logs: ``template(**entry)`` gives a frame, tagged by its alias."""
    frames = [template(**{k: v for k, v in e.items() if k != "alias"}).withColumn("alias", F.lit(e["alias"]))
              for e in entries]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
