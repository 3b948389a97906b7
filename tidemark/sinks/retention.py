"""Snapshot retention."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import to_datetime, ts
from tidemark.operators.quality import guard


def expirable_slots(df: DataFrame, at, keep_hours: int, slot: str = "partition_timestamp") -> DataFrame:
    """The slot ``keep_hours`` before ``at``, with how many non-empty slots follow it up to ``at``.

    ``expire`` says whether more than ``keep_hours`` of them exist, so that newer data remains.
    """
    old = to_datetime(at) - timedelta(hours=keep_hours)
    kept = df.filter(F.col(slot).between(ts(old), ts(at))).select(slot).distinct()
    return kept.agg(F.count("*").alias("slots")).select(
        ts(old).alias("slot"), "slots", (F.col("slots") > keep_hours).alias("expire"))


def expire_snapshot(df: DataFrame, at, keep_hours: int, slot: str = "partition_timestamp"):
    """The slot to drop; raises when too few newer slots exist."""
    row = expirable_slots(df, at, keep_hours, slot).first()
    guard(row["slots"], "le", keep_hours)
    return row["slot"]
