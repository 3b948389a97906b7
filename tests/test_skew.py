"""Hot and NULL join keys are really split: the executed plan of a join with a third of all rows on one key."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, joins, merges
from tidemark.plans import popularity

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
N = 240_000


@pytest.fixture
def tables(spark):
    """Rows of which a third have one key (or none), and a table with all keys, the hot one often too."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    ids = spark.range(N)
    key = F.when(F.col("id") % 3 > 0, F.col("id") % 30_000 + 10)
    hot = ids.select(F.coalesce(key, F.lit(7)).alias("k"), F.rand(1).alias("v"))
    null = ids.select(key.alias("k"), F.rand(1).alias("v"))
    other = spark.range(N // 2).select((F.col("id") % 20_000 + 3).alias("k"), F.rand(2).alias("v"))
    yield hot.repartition(16), null.repartition(16), other
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split(df):
    rows = df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    return rows


@pytest.mark.parametrize("how", ["hot", "null"])
def test_anti_semi_not_in_and_upsert(tables, how):
    left, right = tables[how == "null"], tables[2]
    rows = left.count()
    gone = left.filter(F.col("k").isNotNull() & (F.col("k") >= 3) & (F.col("k") < 20_003)).count()
    assert len(split(joins.anti_join(left, right, ["k"]))) == rows - gone
    if how == "hot":  # rows with a NULL key can't match, Spark filters them before these joins
        assert len(split(joins.semi_join(left, right, ["k"]))) == gone
        assert len(split(joins.not_in(left, right, "k"))) == rows - gone
    assert len(split(merges.upsert(left, right, ["k"]))) == rows - gone + N // 2


def test_lists_of_a_hot_group(tables):
    listed = aggregates.item_list(tables[0], ["k"], "v")
    found = split(listed)
    assert len(found) == N and max(r["position"] for r in found) == N // 3
    assert {r["n"] for r in found if r["k"] == 7} == {N // 3}


def test_products_of_a_hot_person(spark, tables):
    events = tables[0].select(F.col("k").alias("viewer_id"), F.lit(1).alias("product_feed_id"), F.monotonically_increasing_id().alias("product_id"),
                              F.lit("view").alias("event_type"), F.lit("2024-01-05 00:00:00").cast("timestamp_ntz").alias("event_time"))
    found = split(popularity.recent_products(events, {"viewed": "view"}, "2024-01-06 00:00:00"))
    assert len(found) == N and {r["action_count"] for r in found if r["viewer_id"] == 7} == {N // 3}


def test_only_nulls_keep_one_row(frame):
    df = frame("k string, v int", ("a", 1), ("a", None), ("b", None), (None, 3), (None, None))
    got = sorted(((r["k"], r["position"], r["item"], r["n"]) for r in aggregates.item_list(df, ["k"], "v").collect()), key=str)
    assert got == sorted([("a", 1, 1, 1), ("b", None, None, 0), (None, 1, 3, 1)], key=str)
