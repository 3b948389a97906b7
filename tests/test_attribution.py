"""Last-touch attribution, checks in one pass and balanced extracts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import joins, quality
from tidemark.operators.ordered import bounds_of, carry_last
from tidemark.sources import extract

START = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


def last_touch(effects, causes, within):
    """By search over all causes of an effect."""
    out = []
    for eid, key, when in effects:
        fits = [(c, v) for k, c, v in causes if None not in (key, when, k, c) and k == key and c <= when]
        found = max(fits) if fits else None
        hit = found is not None and when < found[0] + within
        out.append((eid, found[1] if hit else None, found[0] if hit else None))
    return sorted(out)


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_last_touch_equals_search_with_a_hot_key(spark, frame, hot):
    draw = random.Random(5)

    def key():
        return 1 if draw.random() < hot else draw.choice([None, *range(2, 9 if hot else 200)])

    causes = [(key(), at(draw.choice([None, *range(0, 4000, 7)])), i) for i in range(1500)]
    causes += causes[:50]
    effects = [(i, key(), at(draw.choice([None, *range(0, 4000, 5)]))) for i in range(1500)]
    c = frame("k int, seen timestamp_ntz, v int", *causes)
    e = frame("id int, k int, bought timestamp_ntz", *effects)
    if hot:
        assert bounds_of(e, ["k"], "bought")
    for within in (20, 90):
        got = joins.attribute_last(e, c, ["k"], "bought", "seen", {"v": "v", "seen": "seen"}, (within, "minute"))
        assert got.columns == ["id", "k", "bought", "v", "seen"]
        want = last_touch(effects, causes, timedelta(minutes=within))
        assert sorted(tuple(r) for r in got.select("id", "v", "seen").collect()) == want
        inner = joins.attribute_last(e, c, ["k"], "bought", "seen", {"v": "v"}, (within, "minute"), "inner")
        assert sorted(tuple(r) for r in inner.select("id", "v").collect()) == [w[:2] for w in want if w[1] is not None]
    none = joins.attribute_last(e, c.limit(0), ["k"], "bought", "seen", {"v": "v"}, (1, "day"))
    assert none.count() == 1500 and none.filter("v IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        joins.attribute_last(e, c, ["k"], "bought", "seen", {"v": "v"}, (1, "day"), "outer")


def test_last_touch_forms_no_pairs(spark):
    """With one key, pairs would be 10 to the power 10."""
    both = spark.range(100_000).select(F.lit(1).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), "id")
    got = joins.attribute_last(both.withColumnRenamed("t", "bought"), both, ["k"], "bought", "t", {"last": "id"}, (1, "hour"))
    assert got.filter("last = id").count() == 100_000


def test_carry_last_over_ranges_without_a_value(frame):
    df = frame("k int, n int, v int", *[(1, i, i if i in (3, 500) else None) for i in range(1000)])
    want = [(i, None if i < 3 else 3 if i < 500 else 500) for i in range(1000)]
    for bucket in (None, False, F.floor(F.col("n") / 10)):
        assert sorted(tuple(r) for r in carry_last(df, "v", ["k"], ["n"], "last", bucket).select("n", "last").collect()) == want


def test_checks_of_a_table_scan_it_once(spark, tmp_path):
    for name, n in (("a", 100), ("b", 90)):
        spark.range(n).withColumn("v", F.when(F.col("id") > 10, F.col("id"))).write.parquet(str(tmp_path / name))
    a, again, b = (spark.read.parquet(str(tmp_path / n)) for n in "aab")
    read = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    checks = [quality.exists(f"e{i}", a if i % 2 else again, F.col("id") >= 95 + i) for i in range(8)]
    checks += [quality.reconcile("rows", a, b, F.count("*"), F.count("*")),
               quality.Check("sum", (again, F.sum("v")), "ge", 1, (b, F.count_distinct("v")), 2, -0.5),
               quality.Check("null", (a, F.sum(F.when(F.col("id") < 0, 1))), "eq")]
    got = quality.check_all(spark, checks)
    result = {r["name"]: (r["lhs"], r["passed"]) for r in got.collect()}
    assert result == {f"e{i}": (max(5.0 - i, 0.0), i < 5) for i in range(8)} | {
        "rows": (10.0, False), "sum": (2.0 * sum(range(11, 100)) - 0.5 * 79, True), "null": (0.0, True)}
    one_by_one = [quality.check_exists(c.name, c.x1[0], F.col("id") >= 95 + i) for i, c in enumerate(checks[:8])]
    assert rows(joins.union_all(*one_by_one)) == rows(got.filter(F.col("name").startswith("e")))
    counted = b.mapInArrow(tally, b.schema)
    fused = [quality.exists(f"e{i}", counted, F.col("id") >= i) for i in range(8)]
    assert quality.check_all(spark, [*fused, quality.reconcile("same", counted, a, F.count("*"), F.count("*"))]).count() == 9
    assert quality.check_all(spark, fused).filter("passed").collect() and read.value == 90 * 2


def test_checks_report_missing_values_and_operators(spark, frame):
    none = frame("v int")
    with pytest.raises(Exception, match="check gone: no result"):
        quality.check_all(spark, [quality.Check("gone", (none, F.sum("v")), "eq", null_as_zero=False)]).collect()
    with pytest.raises(ValueError):
        quality.Check("x", (none, F.sum("v")), "ne")
    with pytest.raises(ValueError, match="late"):
        quality.require(quality.check_all(spark, [quality.exists("late", none, F.col("v") > 0)]))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_balanced_ranges_of_an_uneven_key(spark, parts):
    df = spark.range(20_000).select(F.pow("id", F.lit(3)).cast("bigint").alias("k"))
    wide = extract.extract_table(extract.FrameReader(df), ["k"], "numeric", "k", parts=parts, number="part")
    even = extract.extract_table(extract.FrameReader(df), ["k"], "numeric", "k", parts=parts, number="part", balanced=True)
    sizes = [[r["count"] for r in f.groupBy("part").count().collect()] for f in (wide, even)]
    assert sum(sizes[0]) == sum(sizes[1]) == 20_000 and len(sizes[1]) == parts
    assert max(sizes[1]) <= 2 * 20_000 / parts
    if parts == 16:
        assert max(sizes[0]) > 2 * 20_000 / parts


def test_balanced_ranges_with_a_hot_key_and_bounds(frame):
    df = frame("k bigint", *[(i if i % 3 else 7,) for i in range(900)])
    reader = extract.FrameReader(df)
    got = extract.extract_table(reader, ["k"], "dump", "k", parts=10, number="part", balanced=True)
    assert got.count() == 900 and got.filter("k = 7").select("part").distinct().count() == 1
    assert extract.extract_table(reader, ["k"], "numeric", "k", 100, 200, parts=4, balanced=True).count() == df.filter("k >= 100 AND k < 200").count()
    assert extract.extract_table(extract.FrameReader(df.limit(0)), ["k"], "numeric", "k", parts=4, balanced=True).count() == 0
    assert extract.balanced_ranges(0, 10, [0, 3, 3, 7, 10, 12]) == [(0, 3), (3, 7), (7, 10)] and extract.balanced_ranges(5, 5, [5]) == [(5, 5)]
    for bad in ({"mode": "numeric"}, {"mode": "timestamp", "parts": 3}):
        with pytest.raises(ValueError):
            extract.extract_table(reader, ["k"], key="k", lower=0, upper=9, balanced=True, **bad)
    with pytest.raises(ValueError):
        extract.balanced_ranges(2, 1, [])


def test_the_store_cuts_the_tiles():
    reader = extract.JdbcReader(None, "jdbc:x", "orders", {})
    assert reader.splits_query("id", 8, 0, 100) == (
        "(SELECT min(k) AS k FROM (SELECT id AS k, ntile(8) OVER (ORDER BY id) AS tile FROM orders WHERE id >= 0 AND id < 100) t GROUP BY tile) s")
