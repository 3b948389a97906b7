"""Reading hour slots, snapshots and event-time windows.

A slot column is a partition column, so every predicate here prunes directories.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import business_day, shift_ts, to_datetime, trunc_ts, ts

SLOT = "partition_timestamp"


def between_half_open(col: str, start, end) -> Column:
    return (F.col(col) >= ts(start)) & (F.col(col) < ts(end))


def scan_slot(df: DataFrame, start, end, shift: timedelta = timedelta(0),
              lookback: tuple[int, str] | None = None, slot: str = SLOT) -> DataFrame:
    """Rows of the slots in [start, end), moved by ``shift``, reaching ``lookback`` further back."""
    lower, upper = to_datetime(start) + shift, to_datetime(end) + shift
    low = shift_ts(ts(lower), -lookback[0], lookback[1]) if lookback else ts(lower)
    return df.filter((F.col(slot) >= low) & (F.col(slot) < ts(upper)))


def scan_snapshot(df: DataFrame, at, within: timedelta | None = None, slot: str = SLOT) -> DataFrame:
    """A dimension as of one slot, or the slots in (at - within, at]."""
    if within is None:
        return df.filter(F.col(slot) == ts(at))
    return df.filter((F.col(slot) > ts(to_datetime(at) - within)) & (F.col(slot) <= ts(at)))


def scan_late(df: DataFrame, event_ts: str, start, end, scan_end=None,
              slack: timedelta = timedelta(hours=1), slot: str = SLOT) -> DataFrame:
    """Events of [start, end) wherever they landed: partition slack prunes, event time is exact."""
    low = to_datetime(start) - slack
    high = to_datetime(scan_end) if scan_end is not None else to_datetime(end) + slack
    return df.filter(between_half_open(slot, low, high) & between_half_open(event_ts, start, end))


def drop_late(df: DataFrame, event_ts: str, slot: str = SLOT) -> DataFrame:
    """Drop events older than the slot they arrived in."""
    return df.filter(F.col(event_ts) >= F.col(slot))


def pin_snapshot(df: DataFrame, at, name: str, slot: str = SLOT) -> DataFrame:
    """View over the snapshot of one slot."""
    view = scan_snapshot(df, at, slot=slot)
    view.createOrReplaceTempView(name)
    return view


def switch_if_nonempty(df: DataFrame, at, name: str, slot: str = SLOT) -> DataFrame:
    """Point the view at a new slot, but only if that slot holds rows."""
    view = scan_snapshot(df, at, slot=slot)
    if view.isEmpty():
        raise ValueError(f"slot {at} of {name} is empty, the view stays where it is")
    view.createOrReplaceTempView(name)
    return view


def dedup_window(run: datetime, next_run: datetime, scan_days: int) -> dict[str, datetime]:
    """Compaction bounds: events of the slot ``scan_days`` ago, read up to now."""
    back = timedelta(days=scan_days)
    return {"start": run - back, "end": next_run - back, "scan_end": next_run}


def tumbling(df: DataFrame, col: str, unit: str, keys: list, aggs: dict[str, Column],
             out: str = "data_at", offset_hours: int = 0) -> DataFrame:
    """Aggregates per hour, day, week or month; an offset gives local business periods."""
    local = shift_ts(col, offset_hours, "hour") if offset_hours else F.col(col)
    return df.groupBy(trunc_ts(local, unit).alias(out), *keys).agg(
        *[c.alias(n) for n, c in aggs.items()])


def lookback_agg(df: DataFrame, col: str, end, length: tuple[int, str], keys: list[str],
                 aggs: dict[str, Column]) -> DataFrame:
    """Aggregates over the last ``length`` before ``end``, recomputed per slot."""
    low = shift_ts(ts(end), -length[0], length[1])
    rows = df.filter((F.col(col) >= low) & (F.col(col) < ts(end)))
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def month_to_date(df: DataFrame, col: str, day, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates from the month's first day through ``day``."""
    d = to_datetime(day)
    rows = df.filter(between_half_open(col, d.replace(day=1), d + timedelta(days=1)))
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def kst_day(col: str) -> Column:
    return business_day(col, 9)
