"""Distinct counts from stored hourly bitmaps."""

import uuid

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import partials
from tidemark.session import scratch_dir


def events(spark, n=3000):
    ids = spark.range(n)
    return ids.select((F.col("id") * 7919 % 701 * 401).alias("user"), (F.col("id") % 3).alias("k"),
                      F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 137 % 360_000).cast("timestamp_ntz").alias("time"))


def test_any_grain_from_hours(spark):
    df = events(spark)
    hours = partials.hour_partials(df, ["k"], "user")
    for grain in ("hour", "day", "month"):
        got = partials.distinct_users(hours, ["k"], "n", F.date_trunc(grain, "partition_timestamp"))
        want = df.groupBy(F.date_trunc(grain, "time").alias("data_at"), "k").agg(F.count_distinct("user").alias("n"))
        assert rows(got, "data_at", "k", "n") == rows(want, "data_at", "k", "n")
    found = partials.distinct_between(hours, [], "2024-01-01 05:00:00", "2024-01-03 02:00:00", "n").first()["n"]
    assert found == df.filter("time >= timestamp_ntz'2024-01-01 05:00:00' and time < timestamp_ntz'2024-01-03 02:00:00'").select("user").distinct().count()


def test_day_and_month(spark):
    df = events(spark)
    got = partials.day_and_month(partials.hour_partials(df, ["k"], "user"), ["k"], "2024-01-03", "day", "month")
    local = df.withColumn("d", F.date_trunc("day", F.col("time") + F.expr("interval 9 hours")))
    want = local.filter("d <= '2024-01-03'").groupBy("k").agg(
        F.count_distinct(F.when(F.col("d") == "2024-01-03", F.col("user"))).alias("day"), F.count_distinct("user").alias("month"))
    assert rows(got) == rows(want)


def test_a_new_hour_scans_only_itself(spark):
    path = scratch_dir(spark, "raw")
    events(spark).withColumn("hour", F.date_trunc("hour", "time").cast("string")).write.partitionBy("hour").parquet(path)
    raw = spark.read.parquet(path)
    table, store = f"p_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "partials")
    for hour in range(4):
        partials.store_hour(raw, f"2024-01-01 0{hour}:00:00", ["k"], "user", table, store)
    before = set(spark.table(table).inputFiles())
    partials.store_hour(raw, "2024-01-01 03:00:00", ["k"], "user", table, store)  # again, after late events
    after = set(spark.table(table).inputFiles())
    assert len(before & after) >= 3 * len(before) / 4 and len(after - before) >= 1  # the other hours stay as they are
    got = partials.distinct_users(spark.table(table), ["k"], "n")
    assert rows(got) == rows(raw.filter("time < timestamp_ntz'2024-01-01 04:00:00'").groupBy("k").agg(F.count_distinct("user").alias("n")))
    one = partials.hour_partials(raw.filter("time >= timestamp_ntz'2024-01-01 03:00:00' and time < timestamp_ntz'2024-01-01 04:00:00'"), ["k"], "user")
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in one._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {table}")


def test_numbers_stay_and_nulls_are_left_out(frame):
    known = partials.number_users(frame("u string, number bigint"), frame("u string", ("b",), ("a",), (None,), ("a",)), "u")
    assert rows(known) == [("a", 0), ("b", 1)] or rows(known) == [("a", 1), ("b", 2)]
    more = partials.number_users(known, frame("u string", ("c",), ("a",), ("aa",)), "u")
    assert rows(known)[0] in rows(more) and len({n for _, n in rows(more)}) == 4
    df = frame("u bigint, time timestamp_ntz")
    assert partials.distinct_users(partials.hour_partials(df, [], "u"), [], "n").first()["n"] is None
