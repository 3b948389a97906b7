"""Numbering over cut keys equals the plain window, also when one key holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import rows
from tidemark.operators import ordered

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one key, some without a key or a time, ties broken by id."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = "hot" if i % 2 else rng.choice(["a", "b", None])
        at = None if rng.random() < 0.05 else T0 + timedelta(seconds=rng.randrange(0, 40000))
        data.append((i, key, at, rng.choice([None, 1, 2, 3])))
    return spark.createDataFrame(data, "id bigint, k string, at timestamp_ntz, v bigint").cache()


@pytest.mark.parametrize("way", ["asc", "desc"])
@pytest.mark.parametrize("part", [["k"], []])
def test_running_sum(skewed, part, way):
    order = [("at", way), "id"]
    got = ordered.running_sum(skewed, "v", part, order, "s")
    window = Window.partitionBy(*part).orderBy(*ordered.order_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got, "id", "s") == rows(skewed.withColumn("s", F.sum("v").over(window)), "id", "s")


@pytest.mark.parametrize("way", ["asc", "desc"])
def test_number_rank_lag(skewed, way):
    order = [("at", way), "id"]
    window = Window.partitionBy("k").orderBy(*ordered.order_columns(order))
    ties = Window.partitionBy("k").orderBy(ordered.order_columns(order)[0])
    assert rows(ordered.add_row_number(skewed, ["k"], order), "id", "row_num") == rows(
        skewed.withColumn("row_num", F.row_number().over(window)), "id", "row_num")
    assert rows(ordered.add_rank(skewed, ["k"], order[:1]), "id", "rank") == rows(
        skewed.withColumn("rank", F.rank().over(ties)), "id", "rank")
    assert rows(ordered.add_lag(skewed, "v", ["k"], order, "p"), "id", "p") == rows(
        skewed.withColumn("p", F.lag("v").over(window)), "id", "p")


def test_numeric_order(skewed):
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(ordered.running_sum(skewed, "v", ["k"], ["id"], "s"), "id", "s") == rows(
        skewed.withColumn("s", F.sum("v").over(window)), "id", "s")


def test_sessions_against_brute_force(skewed):
    events = skewed.filter("at IS NOT NULL")
    got = {(r.id): (r.k, r.session_id) for r in ordered.sessionize(events, ["k"], "at", 120).collect()}
    by_key: dict = {}
    for r in sorted(events.collect(), key=lambda r: (r.at, r.id)):
        by_key.setdefault(r.k, []).append(r)
    for key, found in by_key.items():
        number, last = 0, None
        for r in found:
            if last is None or (r.at - last).total_seconds() > 120:
                number += 1
            last = r.at
            assert got[r.id] == (key, number)


def test_gap_of_exactly_the_limit_stays(frame):
    df = frame("k int, at timestamp_ntz", (1, T0), (1, T0 + timedelta(seconds=120)), (1, T0 + timedelta(seconds=241)))
    assert rows(ordered.sessionize(df, ["k"], "at", 120), "session_id") == [(1,), (1,), (2,)]


def test_ties_are_kept_or_dropped(frame):
    df = frame("k int, v int, id int", (1, 5, 1), (1, 5, 2), (1, 4, 3))
    assert rows(ordered.last_n(df, ["k"], ["v"], 1), "id") == [(1,), (2,)]
    assert rows(ordered.top_n(df, ["k"], [("v", "desc"), "id"], 1), "id") == [(1,)]


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    a = ordered.sample_per_group(df, ["k"], "id", 7, 1)
    assert rows(a) == rows(ordered.sample_per_group(df.repartition(5), ["k"], "id", 7, 1))
    assert rows(a.groupBy("k").count()) == [(0, 7), (1, 7), (2, 7)]
    assert rows(a) != rows(ordered.sample_per_group(df, ["k"], "id", 7, 2))


def test_group_limit_runs_before_the_shuffle(spark):
    df = ordered.top_n(spark.range(1000).withColumn("k", F.col("id") % 3), ["k"], ["id"], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_odd_values_do_not_undo_the_split(spark):
    """One row of 1970 and one of 2100 in a hot key: no range holds more than three times its share."""
    n = 20_000
    at = F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    hot = spark.range(n).select("id", F.lit("hot").alias("k"), at.alias("at"))
    odd = spark.createDataFrame([(n, "hot", datetime(1970, 1, 1)), (n + 1, "hot", datetime(2100, 1, 1))], "id bigint, k string, at timestamp_ntz")
    df = hot.unionByName(odd)
    grouped = ordered._grouped(df, ["k"], ["at"], None)
    sizes = [r["count"] for r in grouped.groupBy("__bucket").count().collect()]
    assert len(sizes) > ordered.RANGES // 2 and max(sizes) <= 3 * n / ordered.RANGES
    numbered = ordered.add_row_number(df, ["k"], ["at"])
    assert numbered.agg(F.max("row_num"), F.count_distinct("row_num")).first()[:] == (n + 2, n + 2)


def test_text_order_is_cut_too(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.format_string("%07d-é", F.col("id")).alias("t"))
    assert ordered._grouped(df, ["k"], ["t"], None).select("__bucket").distinct().count() > ordered.RANGES // 2
    got = ordered.running_sum(df.withColumn("one", F.lit(1)), "one", ["k"], ["t"], "s")
    assert got.filter(F.col("s") != F.substring("t", 1, 7).cast("int") + 1).count() == 0


def test_without_hot_keys_it_is_a_plain_window(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), "id")
    assert ordered._grouped(df, ["k"], ["id"], None) is None
    plan = ordered.running_sum(df, "id", ["k"], ["id"], "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1 and "Join" not in plan
