"""Latest-state and one-row-per-key operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import trunc_ts, ts
from tidemark.operators.ordered import top_n
from tidemark.operators.slots import SLOT, scan_late


def status_version(col: str, ordered: list[str]) -> Column:
    """Position in the ordered status list; unknown or NULL counts as the first."""
    out = F.when(F.col(col) == ordered[0], 0)
    for i, value in enumerate(ordered[1:], start=1):
        out = out.when(F.col(col) == value, i)
    return out.otherwise(0)


def dedup_latest(df: DataFrame, keys: list[str], version: str, updated_at: str = "updated_at",
                 ordered_values: list[str] | None = None, tiebreak: list[str] = ()) -> DataFrame:
    """One row per key: highest version, then newest update, then the tiebreak columns.

    ``ordered_values`` makes the version a status name; without it the column itself is ordered.
    """
    rank = status_version(version, ordered_values) if ordered_values else F.col(version)
    order = [("__v", "desc"), (updated_at, "desc"), *[(c, "desc") for c in tiebreak]]
    return top_n(df.withColumn("__v", rank), keys, order, 1).drop("__v")


def compact_slot(stream: DataFrame, keys: list[str], version: str, window: dict, created_at: str = "created_at",
                 updated_at: str = "updated_at", ordered_values: list[str] | None = None,
                 tiebreak: list[str] = (), slot: str = SLOT) -> DataFrame:
    """Dedup the events created in the window wherever they landed; the output slot is the creation hour."""
    rows = scan_late(stream, created_at, window["start"], window["end"], window["scan_end"], slot=slot)
    kept = dedup_latest(rows.drop(slot), keys, version, updated_at, ordered_values, tiebreak)
    return kept.withColumn(slot, trunc_ts(created_at, "hour"))


def recent_plus_compacted(stream: DataFrame, gold: DataFrame, keys: list[str], version: str, cut,
                          end, updated_at: str = "updated_at", created_at: str = "created_at",
                          ordered_values: list[str] | None = None, distinct: bool = True,
                          slot: str = SLOT) -> DataFrame:
    """Recent events deduplicated on the fly, older ones from the compacted table.

    ``cut`` separates the two exactly: recent rows are created at or after it, compacted rows before.
    Ties on (version, update time) are all kept; ``distinct`` removes identical copies.
    """
    rows = scan_late(stream, created_at, cut, end, end, slack=timedelta(hours=1), slot=slot)
    rank = status_version(version, ordered_values) if ordered_values else F.col(version)
    recent = top_n(rows.drop(slot).withColumn("__v", rank), keys,
                   [("__v", "desc"), (updated_at, "desc")], 1, ties="keep").drop("__v")
    recent = recent.distinct() if distinct else recent
    recent = recent.withColumn(slot, trunc_ts(created_at, "hour"))
    return recent.unionByName(gold.filter(F.col(created_at) < ts(cut)))


def latest_per_key(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Newest values of each key; ties with different values are all kept."""
    return top_n(df, keys, [(order, "desc")], 1, ties="keep").select(*keys, *values).distinct()


def one_per_key(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """Any one row per key; an order makes the choice repeatable."""
    return top_n(df, keys, order, 1) if order else df.dropDuplicates(keys)


def distinct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def finalise(stream: DataFrame, keys: list[str], version: str, now, horizon: tuple[int, str] = (7, "day"),
             created_at: str = "created_at", updated_at: str = "updated_at",
             tiebreak: list[str] = ()) -> DataFrame:
    """Events old enough to be final, deduplicated."""
    from tidemark.functions.times import since
    return dedup_latest(stream.filter(F.col(created_at) < since(now, *horizon)),
                        keys, version, updated_at, tiebreak=tiebreak)
