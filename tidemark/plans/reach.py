"""Reach, activity and demographics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import clean_demographics
from tidemark.functions.times import business_day, to_datetime, trunc_ts, ts
from tidemark.operators.aggregates import merge_measures
from tidemark.operators.joins import anti_join
from tidemark.operators.ordered import range_count
from tidemark.operators.slots import between_half_open

GRAINS = {
    "hour": lambda c: trunc_ts(c, "hour"),
    "day": lambda c: business_day(c, in_utc=True),
}


def unique_reach(events: DataFrame, dim: DataFrame | None, grain: str, entity: str = "ad_group_id",
                 user: str = "viewer_id", time: str = "time", out: str = "unique_users",
                 via: DataFrame | None = None, via_key: str = "click_id") -> DataFrame:
    """Distinct users per entity and hour, local day, or over everything (grain "all").

    ``dim`` is (id, entity) at one snapshot; without it the event's own column is the entity. ``via``
    is a log (play, landing) that carries only the click id: its rows count for the click's user.
    """
    facts = events
    if via is not None:
        clicks = events.select(F.col(via_key).alias("__click"), user)
        facts = via.join(clicks, F.col(via_key) == F.col("__click")).drop("__click")
    if dim is not None:
        facts = facts.join(dim.filter(F.col(entity).isNotNull()).select(F.col("id").alias("__id"), entity),
                           F.col("lineitem_id") == F.col("__id"))
    keys = [entity] if grain == "all" else [GRAINS[grain](time).alias("data_at"), entity]
    return facts.groupBy(*keys).agg(F.count_distinct(user).alias(out))


def daily_active(events: DataFrame, attrs: list[str], order: list[str], user: str = "viewer_id",
                 unit: str = "unit_id", time: str = "time", last: bool = False) -> DataFrame:
    """One row per local day, user and unit, with the attributes of the first (or last) event."""
    pick = F.max_by if last else F.min_by
    found = events.groupBy(business_day(time).alias("created_at"), user, unit).agg(
        pick(F.struct(*attrs), F.struct(*order)).alias("__a"))
    return found.select("created_at", user, unit, *[F.col(f"__a.{a}").alias(a) for a in attrs])


def new_users(dau: DataFrame, known: DataFrame, keys: list[str], start, end) -> DataFrame:
    """Daily actives of the window never registered before."""
    return anti_join(dau.filter(between_half_open("created_at", start, end)), known, keys)


def activity_metrics(dau: DataFrame, views: DataFrame, nru: DataFrame, units: DataFrame, day,
                     locked: DataFrame | None = None, locked_type: str = "L",
                     dims: list[str] = ("unit_id", "unit_name", "unit_type")) -> DataFrame:
    """DAU, viewers, new users, and month-to-date distinct counts per unit for one day.

    Inputs are (created_at day, unit_id, ifa); units (unit_id, unit_name, unit_type[, country]).
    Units of ``locked_type`` take their counts from ``locked`` (data_at, unit_id, dau, nru). Each
    table is read once: the day's count and the month's distinct count share one aggregate.
    """
    d = to_datetime(day)
    until = d + timedelta(days=1)
    dims = list(dims)

    def counts(df: DataFrame, daily: str, monthly: str, kept: DataFrame) -> tuple:
        month = df.filter(between_half_open("created_at", d.replace(day=1), until))
        rows = month.join(kept, "unit_id").groupBy(*dims).agg(
            F.count_if(F.col("created_at") >= ts(d)).alias(daily),
            F.count_distinct("ifa").alias(monthly))
        return rows, {daily: F.col(daily), monthly: F.col(monthly)}

    open_units = units.filter(F.col("unit_type") != locked_type)
    joined = nru.filter(between_half_open("created_at", d, until)).join(open_units, "unit_id")
    sources = [
        counts(dau, "dau", "mau", open_units),
        counts(views, "dua", "mua", units),
        (joined.groupBy(*dims).agg(F.count("ifa").alias("nru")), {"nru": F.col("nru")}),
    ]
    if locked is not None:
        day_rows = locked.filter(between_half_open("data_at", d, until))
        only = units.filter(F.col("unit_type") == locked_type)
        sources.append((day_rows.join(only, "unit_id"), {"dau": F.col("dau"), "nru": F.col("nru")}))
    merged = merge_measures(sources, dims)
    return merged.select(ts(d).alias("kst_at"), *dims, "dau", "dua", "nru", "mau", "mua")


def weekly_frequency(actives: DataFrame, opens: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Days with an open per weekly active user; 0 for users who opened nothing.

    Weeks and days are local; the opens are reduced to a count per user and week before the join.
    """
    week = F.date_trunc("week", business_day(time)).cast("timestamp_ntz").alias("week_joined")
    wau = actives.select(*keys, week).distinct()
    days = opens.select(*keys, week, business_day(time).alias("d")).distinct().groupBy(
        *keys, "week_joined").agg(F.count("*").alias("days_active"))
    return wau.join(days, [*keys, "week_joined"], "left").fillna(0, ["days_active"])


def unique_clickers(clicks: DataFrame, units: DataFrame, name_like: str, grain: str,
                    unit_filter: Column | None = None, time: str = "time") -> DataFrame:
    """Distinct clickers per unit name and local day or month, for units whose name matches."""
    kept = units.filter(F.col("unit_name").like(name_like))
    kept = kept.filter(unit_filter) if unit_filter is not None else kept
    local = business_day(time) if grain == "day" else F.date_trunc(
        "month", business_day(time)).cast("timestamp_ntz")
    return clicks.join(kept.select("unit_id", "unit_name"), "unit_id").groupBy(
        local.alias("data_at"), "unit_name").agg(F.count_distinct("ifa").alias("clickers"))


def page_views(imps: DataFrame, allocs: DataFrame, units: DataFrame) -> DataFrame:
    """Distinct first allocations seen per unit and local day.

    Impressions and allocations meet in one shuffle by allocation, in parts that aren't merged into larger ones,
    and are made distinct there. What follows are plain counts, so a task holds only its part's pairs, once.
    """
    key = "initial_allocation_id"
    part = lambda df: df.filter(F.col(key).isNotNull()).repartition(range_count(df), key).distinct()
    seen = part(imps.select("unit_id", key))
    served = part(allocs.select(F.col("request_id").alias(key), business_day("created_at").alias("kst_at")))
    counts = seen.join(served, key).groupBy("kst_at", "unit_id").agg(F.count("*").alias("pv"))
    names = units.select("unit_id", "unit_name", "unit_type").distinct()
    return counts.join(names, "unit_id").select("kst_at", "unit_id", "unit_name", "unit_type", "pv")


def daily_demographics(events: DataFrame, start, end, dims: list[str], out: str,
                       slot: str = "partition_timestamp") -> DataFrame:
    """Event counts per local day and cleaned demographics."""
    rows = events.filter(between_half_open(slot, start, end))
    clean = clean_demographics(rows, to_datetime(start).year)
    return clean.groupBy(business_day(slot).alias("date_at"), *dims, "year_of_birth", "sex").agg(
        F.count("*").alias(out))


def user_sessions(actions: DataFrame, keys: list[str], gap_seconds: int, kinds: dict[str, str],
                  devices: DataFrame | None = None, device_key: str | None = None) -> DataFrame:
    """Sessions of (keys, created_at, action) with duration and counts per action kind.

    Identical actions at the same instant count once. Devices are unique by their key.
    """
    from tidemark.functions.times import diff_boundaries
    from tidemark.operators.ordered import sessionize
    numbered = sessionize(actions.select(*keys, "created_at", "action").distinct(), keys, "created_at",
                          gap_seconds, source=actions)
    rows = numbered.groupBy(*keys, "session_id").agg(
        F.min("created_at").alias("start_time"), F.max("created_at").alias("end_time"),
        *[F.count_if(F.col("action") == kind).alias(n) for n, kind in kinds.items()])
    rows = rows.withColumn("duration", diff_boundaries("second", "start_time", "end_time"))
    return rows if devices is None else rows.join(devices, device_key, "left")
