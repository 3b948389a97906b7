from datetime import datetime as D

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.session import scratch_dir
from tidemark.streaming import streams

CAUSE, EFFECT = "k int, at timestamp_ntz", "k int, done_at timestamp_ntz"


def test_delayed_label_against_known_answer(spark, frame):
    causes, effects = scratch_dir(spark, "c"), scratch_dir(spark, "e")
    frame(CAUSE, (1, D(2024, 1, 1)), (2, D(2024, 1, 1)), (3, D(2024, 1, 1, 0, 30)), (9, D(2024, 1, 9))).coalesce(1).write.parquet(causes)
    frame(EFFECT, (1, D(2024, 1, 1, 0, 59, 59)), (2, D(2024, 1, 1, 1)), (9, D(2024, 1, 9, 5))).coalesce(1).write.parquet(effects)
    out = streams.stream_delayed_label(streams.file_stream(spark, causes, CAUSE), streams.file_stream(spark, effects, EFFECT),
                                       ["k"], "at", "done_at", (1, "hour"), "10 minutes")
    path = scratch_dir(spark, "l")
    streams.write_parquet(out, path, scratch_dir(spark, "lc"))
    got = spark.read.parquet(path).filter("k <> 9").withColumn("occurred_at", F.col("occurred_at").cast("timestamp_ntz"))
    assert rows(got, "k", "is_occurred", "occurred_at") == [
        (1, True, D(2024, 1, 1, 0, 59, 59)), (2, False, D(2024, 1, 1, 1)), (3, False, D(2024, 1, 1, 1, 30))]


def test_arrivals_are_processed_once(spark, frame):
    path, out, state = scratch_dir(spark, "in"), scratch_dir(spark, "out"), scratch_dir(spark, "st")
    for i in (1, 2):
        frame("v int", (i,), (i * 10,)).write.mode("append").parquet(path)
        streams.file_microbatch(spark, path, "v int", lambda b: b.filter("v < 15"), out, state)
    streams.file_microbatch(spark, path, "v int", lambda b: b, out, state)
    assert rows(spark.read.parquet(out), "v") == [(1,), (10,), (2,)]


def test_latest_state_of_a_change_log(spark, frame):
    path, log, state = scratch_dir(spark, "in"), scratch_dir(spark, "log"), scratch_dir(spark, "st")
    cols = "k int, v int, created_at timestamp_ntz, updated_at timestamp_ntz"
    for v in (1, 2):
        frame(cols, (1, v, D(2024, 1, 1), D(2024, 1, v)), (2, v, D(2024, 1, 5), D(2024, 1, 5))).write.mode("append").parquet(path)
        streams.append_changes(streams.file_stream(spark, path, cols), log, state)
    assert rows(streams.read_latest(spark, log, ["k"], "v"), "k", "v") == [(1, 2), (2, 2)]
    final = streams.read_latest(spark, log, ["k"], "v", older_than=F.lit("2024-01-03").cast("timestamp_ntz"))
    assert rows(final, "k", "v") == [(1, 2)]
