from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import dedup, joins, merges

D = datetime


def test_upsert_keeps_null_keys_and_staged_duplicates(frame):
    target = frame("k int, v string", (1, "old"), (2, "old"), (None, "old"))
    src = frame("k int, v string", (2, "new"), (2, "new2"), (None, "new"))
    got = merges.load(target, src, "upsert", ["k"])
    assert rows(got) == [(None, "new"), (None, "old"), (1, "old"), (2, "new"), (2, "new2")]


def test_load_modes(frame):
    target, src = frame("k int, v int", (1, 1)), frame("k int, v int", (1, 2), (1, 3))
    assert rows(merges.load(target, src, "replace")) == [(1, 2), (1, 3)]
    assert rows(merges.load(target, None, "incremental")) == [(1, 1)]
    assert rows(merges.load(target, src, "dedup_upsert", ["k"], order=[("v", "desc")])) == [(1, 3)]
    with pytest.raises(ValueError):
        merges.load(target, src, "append", ["k"])


def test_unknown_delete_condition_keeps_the_row(frame):
    target = frame("k int, v int", (1, None), (2, 5))
    got = merges.replace_slot(target, frame("k int, v int", (3, 9)), F.col("v") > 1)
    assert rows(got) == [(1, None), (3, 9)]


def test_merge_latest_equals_full_join(frame):
    prev = frame("a int, b string, v int", (1, "x", 1), (2, "y", 1), (None, "z", 1))
    new = frame("a int, b string, v int", (1, "x", 2), (1, "x", 3), (None, "z", 2), (None, None, 7))
    got = merges.merge_latest(prev, new, ["a", "b"], [("v", "desc")])
    assert rows(got) == [(None, None, None), (None, "z", 1), (None, "z", 2), (1, "x", 3), (2, "y", 1)]


def test_merge_rank_takes_one_row_per_key(frame):
    prev = frame("k int, at int, v string", (1, 5, "a"), (2, 9, "old"), (3, None, "n"))
    new = frame("k int, at int, v string", (1, 5, "b"), (2, 8, "late"))
    assert rows(merges.merge_rank(prev, new, "k", "at")) == [(1, 5, "b"), (2, 9, "old"), (3, None, "n")]


def test_status_order_and_unknown_status(frame):
    df = frame("k int, s string, updated_at int", (1, "done", 1), (1, "open", 9), (2, "weird", 5), (2, "open", 4), (3, None, 1))
    got = dedup.dedup_latest(df, ["k"], "s", ordered_values=["open", "sent", "done"])
    assert rows(got, "k", "s") == [(1, "done"), (2, "weird"), (3, None)]


def test_compaction_window_bounds(frame):
    cols = "k int, v int, created_at timestamp_ntz, updated_at timestamp_ntz, partition_timestamp timestamp_ntz"
    start, end = D(2024, 1, 1), D(2024, 1, 2)
    df = frame(cols, (1, 1, start, start, D(2023, 12, 31, 23)), (2, 1, end, end, end), (3, 1, D(2024, 1, 1, 5, 30), start, D(2024, 1, 5)),
               (4, 1, D(2023, 12, 31, 23, 59), start, start), (1, 2, start, start, D(2024, 1, 8)))
    got = dedup.compact_slot(df, ["k"], "v", {"start": start, "end": end, "scan_end": D(2024, 1, 8)})
    assert rows(got, "k", "v", "partition_timestamp") == [(1, 1, start), (3, 1, D(2024, 1, 1, 5))]


def test_cut_gives_no_overlap(frame):
    cols = "k int, v int, created_at timestamp_ntz, updated_at timestamp_ntz, partition_timestamp timestamp_ntz"
    a, cut, b = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    stream = frame(cols, (1, 1, a, a, a), (2, 1, cut, cut, cut), (3, 1, b, b, b), (3, 1, b, b, b))
    gold = frame(cols, (1, 1, a, a, a), (2, 1, cut, cut, cut))
    got = dedup.recent_plus_compacted(stream, gold, ["k"], "v", cut, D(2024, 1, 4))
    assert rows(got, "k") == [(1,), (2,), (3,)]


def test_latest_keeps_ties_with_other_values(frame):
    df = frame("k int, at int, p int", (1, 2, 7), (1, 2, 8), (1, 2, 8), (1, 1, 9))
    assert rows(dedup.latest_per_key(df, ["k"], "at", ["p"])) == [(1, 7), (1, 8)]


def test_not_in_follows_sql(frame):
    left = frame("k int", (1,), (2,), (None,))
    assert rows(joins.not_in(left, frame("k int", (1,)), "k")) == [(2,)]
    assert rows(joins.not_in(left, frame("k int", (1,), (None,)), "k")) == []
    assert rows(joins.not_in(left, frame("k int", (1,)).filter("k > 5"), "k")) == [(None,), (1,), (2,)]


def test_offset_boundary(frame):
    fact = frame("c bigint", (10**9,), (10**9 + 1,), (5,), (None,))
    lo, hi = frame("id bigint, n string", (5, "lo"), (10**9, "edge")), frame("id bigint, n string", (1, "hi"))
    assert rows(joins.offset_join(fact, hi, lo, "c", "id", ["n"])) == [(None, None), (10**9, "edge"), (10**9 + 1, "hi"), (5, "lo")]


def test_fallback_uses_wildcard_only_without_exact_match(frame):
    fact = frame("id int, app string, country string", (1, "a", "KR"), (2, "a", "US"), (3, None, "KR"), (4, "b", "KR"), (5, "a", None))
    dim = frame("app string, country string, d int", ("a", "KR", 1), ("a", "ZZ", 2), ("", "KR", 3))
    got = joins.fallback_join(fact, dim, ["app"], "country", "ZZ")
    assert rows(got, "id", "d") == [(1, 1), (2, 2), (3, 3), (5, 2)]


def test_fallback_rows_come_once_without_keeping_the_joined_rows(frame):
    fact = frame("id int, app string, country string", *[(1, "a", "KR"), (1, "a", "KR"), (2, None, "US"), (2, "", "US")] * 2)
    dim = frame("app string, country string, d int", *[("a", "KR", 1), ("a", "KR", 2), ("", "ZZ", 3), (None, "ZZ", 3)] * 2)
    got = joins.fallback_join(fact, dim, ["app"], "country", "ZZ")
    assert rows(got, "id", "app", "d") == [(1, "a", 1), (1, "a", 2), (2, None, 3), (2, "", 3)]
    above = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in above and "Repartition" not in above
    assert got.rdd.getNumPartitions() >= 64  # few bytes of facts and configs, many rows of output


def test_fallback_deals_a_hot_key_over_tasks(spark, frame):
    fact = frame("id int, app string, net int, country string", *[(i, "a", 1 if i % 50 else None, "KR") for i in range(600)], (600, "b", 1, "KR"), (600, "b", 1, "US"))
    dim = frame("app string, net int, country string, d int", *[("a", 1, "ZZ", i) for i in range(40)], ("a", None, "ZZ", 99), ("b", 1, "KR", 1), ("b", 1, "ZZ", 2), (None, 1, "ZZ", 3))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.fallback_join(fact, dim, ["app", "net"], "country", "ZZ").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.id, r.d) for r in got) == sorted([(i, d) for i in range(600) if i % 50 for d in range(40)] + [(600, 1), (600, 2)])
    most = Counter(r.task for r in got).most_common(1)[0][1]
    assert most < len(got) / 10, most  # all of them in one task where a key stays in one piece


def test_attribution_ends_before_the_limit(frame):
    events = frame("c string, t timestamp_ntz", ("x", D(2024, 1, 2)), ("x", D(2024, 1, 1, 23, 59, 59)), ("y", D(2024, 1, 1)))
    clicks = frame("c string, at timestamp_ntz", ("x", D(2024, 1, 1)))
    assert rows(joins.attribute(events, clicks, "c", "t", "at", (1, "day")), "t") == [(D(2024, 1, 1, 23, 59, 59),)]
