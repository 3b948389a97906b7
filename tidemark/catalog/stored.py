"""Jobs on stored state: commits by pointer, merges of key ranges, distinct counts from partials.

Each must equal the SQL of the job that computes the same from whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import REGISTRY, add
from tidemark.catalog import jobs_activity, merges as loads, times, writers
from tidemark.functions.times import business_day, trunc_ts
from tidemark.operators.slots import scan_slot
from tidemark.plans import partials
from tidemark.session import scratch_dir
from tidemark.sinks import versions


def _named(t, name: str) -> tuple[str, str]:
    path = scratch_dir(t.spark, name)
    return f"{name}_{path.rsplit('-', 1)[1][:12]}", path


def _slots(t):
    """Half a month per slot; the first one is committed with other rows before."""
    table, path = _named(t, "pointed")
    parts = [("2024-01-01 00:00:00", "2024-01-16 00:00:00"), ("2024-01-16 00:00:00", "2024-02-01 00:00:00")]
    versions.commit_slot(t.events.select(*writers.COLS).limit(10), path, parts[0][0], table)
    for start, end in parts:
        versions.commit_slot(scan_slot(t.events, start, end, slot="ts").select(*writers.COLS), path, start, table)
    return t.spark.table(table)


add("K01_slot_pointer", _slots, REGISTRY["K01_slot_write"].sql)


def _merged(name, target, source, mode, keys, **options):
    def run(t):
        table, path = _named(t, name)
        versions.create_ranged(target(t), table, path, keys, 16)
        versions.merge_ranges(table, path, source(t), mode, **options)
        return t.spark.table(table).drop(versions.RANGE)
    return run


add("U03_upsert_ranges", _merged("upserted", lambda t: loads._null_keys(loads.target(t)), lambda t: loads._null_keys(loads.source(t)), "upsert", ["o_orderkey"]),
    REGISTRY["U03_upsert"].sql)
add("U04_dedup_upsert_ranges", _merged("deduplicated", loads.old_lines, loads.new_lines, "dedup_upsert", loads.LINE_KEYS, order=loads.NEWEST),
    REGISTRY["U04_dedup_upsert"].sql)


def _hours(t, kind, keys, frame=None):
    rows = t.logs(kind) if frame is None else frame
    return partials.hour_partials(rows, keys, "user_id")


def _reach(t):
    views = t.logs("view").join(jobs_activity.dim(t), F.col("lineitem_id") == F.col("id")).filter(F.col("ad_group_id").isNotNull())
    return partials.distinct_users(_hours(t, "view", ["ad_group_id"], views), ["ad_group_id"], "unique_users", business_day("partition_timestamp", in_utc=True))


add("B01_unique_reach_day_partials", _reach, REGISTRY["B01_unique_reach_day"].sql)


def _metrics(t):
    nru = t.logs("signup").groupBy("unit_id", "ifa").agg(trunc_ts(F.min("time"), "day").alias("created_at"))
    locked = t.logs("signup").groupBy("unit_id", trunc_ts("time", "day").alias("data_at")).agg(
        F.count("*").alias("dau"), F.count_distinct("ifa").alias("nru"))
    return partials.activity_metrics(_hours(t, "click", ["unit_id"]), _hours(t, "view", ["unit_id"]), nru, t.units.drop("organization_id"), "2024-01-24",
                                     locked, locked_type="ASIA")


add("B04_activity_metrics_partials", _metrics, REGISTRY["B04_activity_metrics"].sql)


def _clickers(t):
    """Users are texts here: they get numbers from a dictionary that already holds some of them."""
    clicks, kept = t.logs("click"), t.units.filter(F.col("unit_name").like("NATION__")).select("unit_id", "unit_name")
    known = partials.number_users(t.spark.createDataFrame([], "ifa string, number bigint"), clicks.filter("user_id % 2 = 0"), "ifa")
    numbers = partials.number_users(known, clicks, "ifa")
    rows = clicks.join(kept, "unit_id").join(numbers, "ifa")
    hours = partials.hour_partials(rows, ["unit_name"], "number")
    month = F.date_trunc("month", business_day("partition_timestamp")).cast("timestamp_ntz")
    return partials.distinct_users(hours, ["unit_name"], "clickers", month)


add("B31_unique_clickers_month_partials", _clickers, REGISTRY["B31_unique_clickers_month"].sql)
add("X02_lookback_partials", lambda t: partials.distinct_between(
    partials.hour_partials(t.actions, ["lineitem_id"], "user_id"), ["lineitem_id"], "2024-01-03 00:00:00", "2024-01-31 00:00:00", "users"),
    REGISTRY["X02_lookback"].sql)
add("X04_month_to_date_partials", lambda t: partials.distinct_between(
    partials.hour_partials(t.orders, ["o_orderstatus"], "o_custkey", "o_orderdate"), ["o_orderstatus"], "2000-03-01 00:00:00", "2000-03-18 00:00:00", "customers"),
    REGISTRY["X04_month_to_date"].sql)
