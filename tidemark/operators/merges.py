"""Load modes: each returns the complete new target, to be written to a new path and swapped in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import ts
from tidemark.operators.joins import anti_join
from tidemark.operators.ordered import top_n

MODES = ("replace", "incremental", "upsert", "dedup_upsert")


def load(target: DataFrame, src: DataFrame | None, mode: str, keys: list[str] = (),
         dedup_keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """Apply one load mode; a missing source leaves an incremental target as it is."""
    if mode == "replace":
        return src
    if src is None:
        return target
    if mode == "incremental":
        return target.unionByName(src)
    if mode == "upsert":
        return upsert(target, src, keys)
    if mode == "dedup_upsert":
        return upsert(target, top_n(src, list(dedup_keys or keys), order, 1), keys)
    raise ValueError(f"mode {mode!r} is not one of {MODES}")


def upsert(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not staged, plus all staged rows.

    Equality never matches NULL, so a target row with a NULL key always stays; ``anti_join`` splits
    the task that NULL or hot keys fall to.
    """
    return anti_join(target, src, keys).unionByName(src)


def transform_reload(target: DataFrame, src: DataFrame, delete: Column | None, keys: list[str],
                     order: list, dedup_keys: list[str] | None = None) -> DataFrame:
    """Delete a window of the target, then upsert the newest staged row of each key."""
    return load(_without(target, delete), src, "dedup_upsert", keys, dedup_keys, order)


def replace_slot(target: DataFrame, src: DataFrame, delete: Column) -> DataFrame:
    """Delete the rows of a slot and append the new ones."""
    return _without(target, delete).unionByName(src)


def _without(df: DataFrame, delete: Column | None) -> DataFrame:
    # A row on which the condition is unknown is not deleted.
    return df if delete is None else df.filter(~F.coalesce(delete, F.lit(False)))


def upsert_snapshot(previous: DataFrame, new: DataFrame, keys: list[str], slot_value,
                    slot: str = "partition_timestamp") -> DataFrame:
    """Next snapshot of a dimension: rows without news, plus the news, stamped with the next slot."""
    merged = anti_join(previous, new, keys).unionByName(new)
    return merged.withColumn(slot, ts(slot_value))


def merge_latest(previous: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Newest new row per key wins, other keys carry their previous row.

    Equal to the full outer join on the keys, written as anti join and union: adaptive
    execution splits hot and NULL keys there, and no column needs a per-side choice.
    """
    latest = top_n(new, keys, order, 1)
    nothing = F.lit(True)
    for k in keys:
        nothing = nothing & F.col(k).isNull()
    # A new row without any key value cannot win: the side test sees no new row there.
    latest = latest.select(*[F.when(~nothing, F.col(c)).alias(c) for c in previous.columns])
    return anti_join(previous, latest, keys).unionByName(latest)


def merge_rank(previous: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Newest version of each key from both sides; among identical times the greatest row is taken.

    An aggregate instead of a window: partial results combine before the shuffle.
    """
    rows = new.unionByName(previous)
    others = [c for c in rows.columns if c not in (key, order)]
    best = rows.groupBy(key).agg(F.max(F.struct(order, *others)).alias("__b"))
    return best.select(*[F.col(key) if c == key else F.col(f"__b.{c}").alias(c) for c in rows.columns])


def rebuild_merge(rebuilt: DataFrame, live: DataFrame, increment: str, mark, keys: list[str]) -> DataFrame:
    """Bring a rebuilt copy up to date with the live rows at or above the high-water mark."""
    return upsert(rebuilt, live.filter(F.col(increment) >= mark), keys)


def query_load(query: DataFrame, target: DataFrame, mode: str, **options) -> DataFrame:
    """Load the result of a query into a target table."""
    return load(target, query.select(*target.columns), mode, **options)


def last_increment_value(target: DataFrame, key: str) -> DataFrame:
    """High-water mark of a target as one row; NULL when the target is empty."""
    return target.agg(F.max(key).alias("last_value"))
