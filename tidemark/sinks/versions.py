"""Commits by pointer: new files first, then the table's partition is pointed at them.

A partition of an external table has a location. Every commit writes a folder of its own and then sets the
location, which the catalog does in one step: readers see the old files or the new ones, nothing is renamed
and nothing is copied, on an object store as well. Old folders stay for readers that have begun with them,
until ``expire`` deletes those that no partition points to.

A table in key ranges is the same with one partition for each range of its first key. A merge then reads and
writes the ranges that staged keys fall into, and leaves the others as they are.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.times import to_datetime
from tidemark.operators.merges import load
from tidemark.operators.ordered import _as_number
from tidemark.operators.slots import SLOT
from tidemark.sinks.slots import FORMATS, _delete, _file_system
from tidemark.sources.partitions import create_slot_table, slot_dir

RANGE = "key_range"
_BOUNDS, _KEYS = "key_range.bounds", "key_range.keys"


@dataclass(frozen=True)
class Commit:
    """What a commit wrote: its folder, the rows in it, and the partitions that point to it now."""
    path: str
    rows: int
    partitions: tuple


def _version() -> str:
    return f"version-{uuid.uuid4().hex}"


def _point(spark: SparkSession, table: str, partition: str, location: str) -> None:
    """Set the location of one partition in one step; a new partition is added with it."""
    known = not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({partition})").isEmpty()
    spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION '{location}'" if known
              else f"ALTER TABLE {table} ADD PARTITION ({partition}) LOCATION '{location}'")


def commit_slot(df: DataFrame, path: str, at, table: str, fmt: str = "parquet", on_empty: str = "keep", slot: str = SLOT) -> Commit:
    """Replace one slot of a registered table without a moment in which it is missing.

    ``on_empty`` = keep | skip | fail decides on an empty result before anything points to it. A run that
    ends early leaves the slot as it was, and running it again gives the same rows.
    """
    spark, (kind, options) = df.sparkSession, FORMATS[fmt]
    base = path.rstrip("/")
    folder = f"{base}/{slot_dir(at)}/{_version()}"
    counted = Observation(f"slot {at}")
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(kind).options(**options).save(folder)
    rows = counted.get["rows"]
    if rows == 0 and on_empty in ("skip", "fail"):
        _delete(spark, folder)
        if on_empty == "fail":
            raise ValueError(f"slot {at} has no rows")
        return Commit(folder, 0, ())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != slot)
    create_slot_table(spark, table, columns, base, kind, slot)
    value = to_datetime(at).strftime("%Y-%m-%d %H:%M:%S")
    _point(spark, table, f"{slot}='{value}'", folder)
    spark.catalog.refreshTable(table)
    return Commit(folder, rows, (value,))


def locations(spark: SparkSession, table: str) -> dict[str, str]:
    """Folder of every partition of a table, by the partition's spec."""
    found = {}
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        names = ", ".join(f"{k}='{v}'" for k, v in (p.split("=", 1) for p in _unescaped(spec).split("/")))
        told = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({names})").collect()
        found[spec] = next(r["data_type"] for r in told if r["col_name"] == "Location")
    return found


def _unescaped(spec: str) -> str:
    from urllib.parse import unquote
    return unquote(spec)


def expire(spark: SparkSession, table: str, path: str) -> list[str]:
    """Delete the version folders below ``path`` that no partition points to; returns them.

    To be run when no reader or writer of an older version is left, as a retention job.
    """
    fs, make = _file_system(spark, path)
    used = {make(p).toUri().getPath() for p in locations(spark, table).values()}
    gone, todo = [], [make(path)]
    while todo:
        for status in fs.listStatus(todo.pop()):
            at = status.getPath()
            if not status.isDirectory():
                continue
            if not at.getName().startswith("version-"):
                todo.append(at)
            elif not any(u == at.toUri().getPath() or u.startswith(at.toUri().getPath() + "/") for u in used):
                fs.delete(at, True)
                gone.append(at.toString())
    return gone


def _range(bounds: list[float], df: DataFrame, key: str) -> Column:
    """Number of the range a key falls into; rows without a key have one of their own."""
    x = _as_number(df.schema[key].dataType, key)
    known = F.size(F.filter(F.lit(bounds).cast("array<double>"), lambda b: b < x))
    return F.when(F.col(key).isNull(), -1).otherwise(known).cast("int").alias(RANGE)


def _write_ranges(rows: DataFrame, folder: str) -> int:
    """One folder for each range; a large range gets several writers."""
    counted = Observation(folder)
    (rows.hint("rebalance", F.col(RANGE)).observe(counted, F.count(F.lit(1)).alias("rows"))
     .write.partitionBy(RANGE).parquet(folder))
    return counted.get["rows"]


def create_ranged(df: DataFrame, table: str, path: str, keys: list[str], ranges: int = 64) -> Commit:
    """Create a table in about ``ranges`` ranges of the first key, cut at approximate quantiles."""
    spark, base = df.sparkSession, path.rstrip("/")
    grid = [i / ranges for i in range(1, ranges)]
    x = _as_number(df.schema[keys[0]].dataType, keys[0])
    found = df.agg(F.percentile_approx(x, grid, F.lit(20 * ranges)).alias("q")).first()["q"] if grid else None
    bounds = sorted(set(found or []))
    folder = f"{base}/{_version()}"
    rows = _write_ranges(df.withColumn(RANGE, _range(bounds, df, keys[0])), folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}, {RANGE} INT) USING parquet PARTITIONED BY ({RANGE}) LOCATION '{base}' "
              f"TBLPROPERTIES ('{_BOUNDS}' = '{json.dumps(bounds)}', '{_KEYS}' = '{json.dumps(keys)}')")
    return _switch(spark, table, folder, rows)


def _switch(spark: SparkSession, table: str, folder: str, rows: int) -> Commit:
    """Point the ranges written below ``folder`` at it, one after the other."""
    fs, make = _file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(make(folder)) if s.isDirectory()]
    numbers = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{RANGE}="))
    for number in numbers:
        _point(spark, table, f"{RANGE}={number}", f"{folder}/{RANGE}={number}")
    spark.catalog.refreshTable(table)
    return Commit(folder, rows, tuple(numbers))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def merge_ranges(table: str, path: str, src: DataFrame, mode: str = "upsert", dedup_keys: list[str] | None = None,
                 order: list | None = None) -> Commit:
    """Merge staged rows into a table in key ranges (``mode``: upsert or dedup_upsert of ``merges.load``).

    Only the ranges of staged keys are read, rewritten and pointed at. Each range changes in one step; a
    run that ends between two of them is finished by running it again, as a merge repeated changes nothing
    (staged rows without a key are the exception: they are added each time, as the plain load modes do).
    """
    spark, base = src.sparkSession, path.rstrip("/")
    about = _properties(spark, table)
    bounds, keys = json.loads(about[_BOUNDS]), json.loads(about[_KEYS])
    target = spark.table(table)
    staged_at = f"{base}/{_version()}/staged"
    shaped = src.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns if c != RANGE])
    shaped.withColumn(RANGE, _range(bounds, shaped, keys[0])).write.parquet(staged_at)
    staged = spark.read.schema(target.schema).parquet(staged_at)
    touched = [r[RANGE] for r in staged.select(RANGE).distinct().collect()]  # one number for each range at most
    old = target.filter(F.col(RANGE).isin(touched)) if touched else target.limit(0)
    merged = load(old, staged, mode, keys, dedup_keys, order)
    folder = f"{base}/{_version()}"
    commit = _switch(spark, table, folder, _write_ranges(merged, folder))
    _delete(spark, staged_at)
    return commit
