from datetime import datetime

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators.slots import dedup_window, switch_if_nonempty
from tidemark.session import require_folder, scratch_dir
from tidemark.sinks import retention, slots, unload
from tidemark.sources import extract, partitions, text
from tidemark.functions import nested


def test_rewriting_a_slot_replaces_it(spark, frame):
    path = scratch_dir(spark, "t")
    slots.write_slot(frame("v int", (1,), (2,)), path, "2024-01-01 05:00:00")
    done = slots.write_slot(frame("v int", (3,)), path, "2024-01-01 05:00:00")
    slots.write_slot(frame("v int", (9,)), path, "2024-01-01 06:00:00")
    assert done.rows == 1
    got = partitions.read_slots(spark, path)
    assert rows(got, "v", "partition_timestamp") == [(3, datetime(2024, 1, 1, 5)), (9, datetime(2024, 1, 1, 6))]
    pruned = got.filter(partitions.slot_filter("2024-01-01 06:00:00", "2024-01-01 07:00:00"))
    assert rows(pruned, "v") == [(9,)]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour" in plan.split("PartitionFilters")[1]


def test_empty_slot_policy(spark, frame):
    none = frame("v int", (1,)).filter("v > 5")
    assert slots.write_slot(none, scratch_dir(spark, "e"), "2024-01-01", on_empty="skip").rows == 0
    with pytest.raises(ValueError):
        slots.write_slot(none, scratch_dir(spark, "e"), "2024-01-01", on_empty="fail")


def test_overwrite_slots_touches_only_its_slots(spark, frame):
    path, a, b = scratch_dir(spark, "o"), datetime(2024, 1, 1), datetime(2024, 1, 2)
    slots.overwrite_slots(frame("v int, partition_timestamp timestamp_ntz", (1, a), (2, b)), path)
    slots.overwrite_slots(frame("v int, partition_timestamp timestamp_ntz", (3, b)), path)
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_swap_while_reading_the_old_table(spark, frame):
    path = scratch_dir(spark, "s")
    slots.swap_table(frame("v int", (1,), (2,)), path)
    slots.swap_table(spark.read.parquet(path).filter("v = 2"), path)
    assert rows(spark.read.parquet(path)) == [(2,)]


def test_scratch_needs_a_named_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with pytest.raises(ValueError):
        require_folder(None)


def test_skipped_and_failed_runs_leave_the_slot(spark, frame):
    path, at = scratch_dir(spark, "p"), "2024-01-01 05:00:00"
    full, none = frame("v int", (1,), (2,)), frame("v int", (1,)).filter("v > 5")
    slots.write_slot(full, path, at)
    assert slots.write_slot(none, path, at, on_empty="skip").rows == 0
    with pytest.raises(ValueError):
        slots.write_slot(none, path, at, on_empty="fail")
    assert partitions.read_slots(spark, path).count() == 2
    slots.write_slot(none, path, at, on_empty="keep")
    assert partitions.read_slots(spark, path, "v int").count() == 0


def test_refused_swap_keeps_the_table(spark, frame):
    path = scratch_dir(spark, "q")
    slots.swap_table(frame("v int", (1,)), path)
    with pytest.raises(OSError):
        slots.replace_folder(spark, f"{path}.missing", path)
    assert rows(spark.read.parquet(path)) == [(1,)]


def test_jdbc_replacement_never_empties_the_table():
    statements = unload.replace_statements("t", "t_staged", ["k", "v"], ["k"])
    assert statements == ["DELETE FROM t WHERE EXISTS (SELECT 1 FROM t_staged WHERE t_staged.k = t.k)",
                          "INSERT INTO t (k, v) SELECT k, v FROM t_staged", "DROP TABLE t_staged"]
    reader = extract.JdbcReader(None, "jdbc:x", "t", {})
    assert reader.bounds_query("k") == "(SELECT min(k) AS lo, max(k) AS hi FROM t) b"


def test_numeric_ranges_cover_the_largest_key(frame):
    df = frame("k int", *[(i,) for i in range(0, 21)])
    got = extract.extract_table(extract.FrameReader(df), ["k"], "numeric", "k", step=10, number="part")
    assert rows(got.groupBy("part").count()) == [(0, 10), (1, 10), (2, 1)]
    assert extract.extract_table(extract.FrameReader(df), ["k"], key="k", parts=4).count() == 21
    assert extract.predicates("k", extract.numeric_ranges(5, 5)) == ["k = 5"]
    assert len(extract.numeric_ranges(0, 1000, step=10)) == 100 and len(extract.numeric_ranges(0, 10**9, parts=7)) == 7
    with pytest.raises(ValueError):
        extract.numeric_ranges(6, 5)
    one = frame("k int", (4,))
    assert extract.extract_table(extract.FrameReader(one), ["k"], "numeric", "k").count() == 1
    assert extract.extract_table(extract.FrameReader(one.filter("k < 0")), ["k"], "numeric", "k").count() == 0


def test_many_ranges_of_a_frame_are_one_test_of_a_row(frame):
    df = frame("k int", *[(i,) for i in range(0, 900)], (None,))
    got = extract.extract_table(extract.FrameReader(df), ["k"], "numeric", "k", step=2, number="part")
    assert got.groupBy("part").count().filter("count = 2").count() == 450 and got.count() == 900
    some = extract.extract_table(extract.FrameReader(df), ["k"], "numeric", "k", 100, 200, step=7)
    assert rows(some) == sorted(((i,) for i in range(100, 200)), key=str)
    for plan in (got, some):
        assert " OR " not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_timestamp_ranges_are_cut_at_the_end():
    got = extract.predicates("t", extract.timestamp_ranges("2024-01-01 00:00:00", "2024-01-01 02:30:00"))
    assert len(got) == 3 and got[-1] == "t >= '2024-01-01 02:00:00' AND t < '2024-01-01 02:30:00'"
    assert extract.predicates("t", extract.timestamp_ranges("2024-01-01 00:00:00", "2024-01-01 00:00:00")) == ["t = '2024-01-01 00:00:00'"]
    with pytest.raises(ValueError):
        extract.timestamp_ranges("2024-01-02", "2024-01-01")


def test_rejects(frame):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DecimalType(5, 2)), T.StructField("s", T.StringType())])
    raw = frame("n string, d string, s string", ("1", "2.50", "abcdef"), ("x", "1", "a"), ("", None, None), (" 7 ", "1", "b"))
    good, bad = text.load_with_rejects(raw, schema, {"s": 3})
    assert rows(good, "n", "s") == [(None, None), (1, "abc"), (7, "b")]
    assert rows(bad, "n") == [("x",)]
    assert text.require_rejects_at_most(bad, 1) == 1
    with pytest.raises(ValueError):
        text.require_rejects_at_most(bad, 0)


def test_json_helpers(frame):
    df = frame("j string", ('{"a": 1}',), ("{bad",), ("[1]",), ('{"a": {"b": 1}}',), ("",), (None,))
    got = df.select("j", nested.is_json("j").alias("ok"), nested.try_json_map("j").isNotNull().alias("flat")).collect()
    assert [(r.ok, r.flat) for r in got] == [(True, True), (False, False), (True, False), (True, False), (False, False), (False, False)]
    out = nested.shred_json(frame("j string, i int", ('{"a": 1, "c": null}', 1), ("x", 2), ('{"b": "z"}', 3)), "j", defaults={"log_type": "general"})
    assert rows(out, "i", "a", "b", "log_type") == [(1, 1, None, "general"), (3, None, "z", "general")]


def test_retention_needs_newer_slots(frame):
    hours = [(datetime(2024, 1, 1, h),) for h in range(5)]
    df = frame("partition_timestamp timestamp_ntz", *hours)
    assert retention.expire_snapshot(df, "2024-01-01 04:00:00", 4) == datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        retention.expire_snapshot(df.filter("hour(partition_timestamp) <> 2"), "2024-01-01 04:00:00", 4)


def test_row_text_comes_back(spark, frame):
    path = scratch_dir(spark, "r")
    odd = frame("s string, t timestamp_ntz", ("a\nb\\c", datetime(2024, 1, 1, 0, 0, 0, 5)), ('"q"|\\n\\', None), ("\r\n\\\\n", None)).coalesce(1)
    unload.write_rows(odd, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 4 and lines[1] == '"a\\nb\\\\c"|"2024-01-01 00:00:00.000005"'
    assert rows(unload.read_rows(spark, path, odd.schema)) == rows(odd)


def test_nested_values_are_told_by_type(frame):
    df = frame("j string", ('{"title": "[AD] sale", "n": "{x"}',), ('{"a": [1]}',), ('{"a": {}}',), ('{}',), ('"{}"',))
    assert [r[0] for r in df.select(nested.try_json_map("j").isNotNull()).collect()] == [True, False, False, True, False]


def test_dedup_window():
    run, nxt = datetime(2024, 1, 8, 1), datetime(2024, 1, 8, 2)
    assert dedup_window(run, nxt, 7) == {"start": datetime(2024, 1, 1, 1), "end": datetime(2024, 1, 1, 2), "scan_end": nxt}


def test_switch_refuses_an_empty_slot(frame):
    df = frame("v int, partition_timestamp timestamp_ntz", (1, datetime(2024, 1, 1)))
    assert switch_if_nonempty(df, "2024-01-01", "now_view").count() == 1
    with pytest.raises(ValueError):
        switch_if_nonempty(df, "2024-01-02", "now_view")
