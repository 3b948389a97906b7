"""Distinct counts from stored partials that can be merged.

A partial is an exact set of user numbers as bitmaps: one row for each hour, key and bucket of 32,768 numbers.
An hour is computed once, from its own events. Days, months to date and any run of hours are unions of the
bitmaps, so no raw event is read again, and no grain is limited to sums.

Users are numbers. Where they are texts, ``number_users`` keeps a dictionary that only grows.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import business_day, to_datetime, trunc_ts, ts
from tidemark.operators.aggregates import merge_measures
from tidemark.operators.joins import anti_join
from tidemark.operators.ordered import add_row_number
from tidemark.operators.slots import SLOT, between_half_open, scan_slot
from tidemark.sinks.versions import Commit, commit_slot

BUCKET, USERS = "bucket", "users"


def number_users(known: DataFrame, users: DataFrame, user: str, number: str = "number") -> DataFrame:
    """The dictionary (user, number) with the users it lacks, numbered on; numbers once given stay."""
    new = anti_join(users.select(user).filter(F.col(user).isNotNull()).distinct(), known, [user])
    placed = add_row_number(new, [], [user], "__at")
    last = known.agg(F.coalesce(F.max(number), F.lit(-1)).cast("bigint")).scalar()
    return known.select(user, number).unionByName(placed.select(user, (F.col("__at") + last).cast("bigint").alias(number)))


def hour_partials(events: DataFrame, keys: list[str], user: str, time: str = "time", hour: str = SLOT) -> DataFrame:
    """(hour, keys, bucket, users) of all events; tasks send one bitmap for each of their groups."""
    known = events.filter(F.col(user).isNotNull())
    return known.groupBy(trunc_ts(time, "hour").alias(hour), *keys, F.bitmap_bucket_number(user).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias(USERS))


def store_hour(events: DataFrame, at, keys: list[str], user: str, table: str, path: str, time: str = "time") -> Commit:
    """Compute one hour's partial from that hour's slot alone and put it in its place in ``table``."""
    end = to_datetime(at) + timedelta(hours=1)
    rows = scan_slot(events, at, end, slot=time)
    return commit_slot(hour_partials(rows, keys, user, time).drop(SLOT), path, at, table)


def union_of(partials: DataFrame, groups: list[str | Column]) -> DataFrame:
    """One bitmap for each group and bucket."""
    return partials.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(USERS).alias(USERS))


def distinct_users(partials: DataFrame, keys: list[str], out: str, grain: Column | None = None, as_name: str = "data_at") -> DataFrame:
    """Distinct users of each key and, if a grain of the hour is given, of each of its values."""
    groups = [*keys] if grain is None else [grain.alias(as_name), *keys]
    names = [*keys] if grain is None else [as_name, *keys]
    return union_of(partials, groups).groupBy(*names).agg(F.sum(F.bitmap_count(USERS)).alias(out))


def distinct_between(partials: DataFrame, keys: list[str], start, end, out: str, hour: str = SLOT) -> DataFrame:
    """Distinct users of the hours in [start, end)."""
    return distinct_users(partials.filter(between_half_open(hour, start, end)), keys, out)


def day_and_month(partials: DataFrame, keys: list[str], day, daily: str, monthly: str, hour: str = SLOT) -> DataFrame:
    """Distinct users of a local day and of its month up to that day, in one pass over the month's partials."""
    d = to_datetime(day)
    local = partials.withColumn("__day", business_day(hour)).filter(between_half_open("__day", d.replace(day=1), d + timedelta(days=1)))
    days = union_of(local, [*keys, "__day"])
    today = F.max(F.when(F.col("__day") == ts(d), F.bitmap_count(USERS))).alias("__today")
    buckets = days.groupBy(*keys, BUCKET).agg(today, F.bitmap_or_agg(USERS).alias(USERS))
    return buckets.groupBy(*keys).agg(F.coalesce(F.sum("__today"), F.lit(0)).alias(daily), F.sum(F.bitmap_count(USERS)).alias(monthly))


def activity_metrics(actives: DataFrame, views: DataFrame, nru: DataFrame, units: DataFrame, day, locked: DataFrame | None = None,
                     locked_type: str = "L", dims: list[str] = ("unit_id", "unit_name", "unit_type")) -> DataFrame:
    """``reach.activity_metrics`` with actives and viewers as hourly partials per unit_id."""
    d, dims = to_datetime(day), list(dims)
    until = d + timedelta(days=1)
    open_units = units.filter(F.col("unit_type") != locked_type)

    def counts(partials: DataFrame, daily: str, monthly: str, kept: DataFrame) -> tuple:
        found = day_and_month(partials, ["unit_id"], d, daily, monthly).join(kept, "unit_id")
        return found, {daily: F.col(daily), monthly: F.col(monthly)}

    joined = nru.filter(between_half_open("created_at", d, until)).join(open_units, "unit_id")
    sources = [counts(actives, "dau", "mau", open_units), counts(views, "dua", "mua", units),
               (joined.groupBy(*dims).agg(F.count("ifa").alias("nru")), {"nru": F.col("nru")})]
    if locked is not None:
        only = units.filter(F.col("unit_type") == locked_type)
        sources.append((locked.filter(between_half_open("data_at", d, until)).join(only, "unit_id"), {"dau": F.col("dau"), "nru": F.col("nru")}))
    return merge_measures(sources, dims).select(ts(d).alias("kst_at"), *dims, "dau", "dua", "nru", "mau", "mua")
