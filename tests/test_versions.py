"""Commits by pointer: what a reader sees between the steps, what is rewritten, and what stays."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import merges
from tidemark.session import scratch_dir
from tidemark.sinks import versions

AT = "2024-01-01 05:00:00"


@pytest.fixture
def named(spark):
    table, path = f"t_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "versions")
    yield table, path
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def size(spark, path):
    fs, make = versions._file_system(spark, path)
    return fs.getContentSummary(make(path)).getLength()


def test_a_slot_is_there_at_every_step(spark, named, frame, monkeypatch):
    table, path = named
    versions.commit_slot(frame("k int", (1,), (2,)), path, AT, table)
    files = spark.table(table).inputFiles()

    def crash(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(versions, "_point", crash)
        with pytest.raises(OSError):
            versions.commit_slot(frame("k int", (3,)), path, AT, table)
    assert rows(spark.table(table), "k") == [(1,), (2,)]
    for _ in range(2):  # running it again gives the same rows
        versions.commit_slot(frame("k int", (3,)), path, AT, table)
        assert rows(spark.table(table), "k") == [(3,)]
    assert rows(spark.read.parquet(*files), "k") == [(1,), (2,)]  # a reader that began before still has its files


def test_no_rename_in_a_commit(spark, named, frame, monkeypatch):
    table, path = named
    versions.commit_slot(frame("k int", (1,)), path, AT, table)
    first = versions.locations(spark, table)
    versions.commit_slot(frame("k int", (2,)), path, AT, table)
    second = versions.locations(spark, table)
    assert first.keys() == second.keys() and first != second
    fs, make = versions._file_system(spark, path)
    assert all(fs.exists(make(p)) for p in [*first.values(), *second.values()])
    gone = versions.expire(spark, table, path)
    assert len(gone) == 1 and not fs.exists(make(*first.values())) and rows(spark.table(table), "k") == [(2,)]


def test_empty_results(spark, named, frame):
    table, path = named
    versions.commit_slot(frame("k int", (1,)), path, AT, table)
    empty = frame("k int")
    assert versions.commit_slot(empty, path, AT, table, on_empty="skip").rows == 0
    with pytest.raises(ValueError):
        versions.commit_slot(empty, path, AT, table, on_empty="fail")
    assert rows(spark.table(table), "k") == [(1,)]
    versions.commit_slot(empty, path, AT, table, on_empty="keep")
    assert rows(spark.table(table), "k") == []


def test_a_merge_rewrites_the_ranges_it_touches(spark, named):
    table, path = named
    target = spark.range(40_000).select("id", (F.col("id") % 7).cast("int").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    made = versions.create_ranged(target, table, path, ["id"], 20)
    assert made.rows == 40_000 and len(made.partitions) == 20
    before = versions.locations(spark, table)
    src = spark.range(39_500, 40_500).select("id", F.lit(99).alias("v"), F.lit("new").alias("pad"))
    done = versions.merge_ranges(table, path, src)
    after = versions.locations(spark, table)
    changed = {spec for spec in after if before.get(spec) != after[spec]}
    assert len(changed) == len(done.partitions) <= 2 and done.rows < 5000
    assert size(spark, done.path) < size(spark, made.path) / 8
    want = merges.upsert(target, src, ["id"])
    got = spark.table(table).drop("key_range")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    scanned = spark.table(table).filter(F.col("key_range").isin(list(done.partitions)))
    assert len(scanned.inputFiles()) < len(spark.table(table).inputFiles())
    versions.expire(spark, table, path)
    assert spark.table(table).count() == 40_500


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "decimal(20,2)"])
def test_ranges_of_other_types_null_keys_and_repeated_merges(spark, named, kind):
    table, path = named
    key = F.when(F.col("id") % 11 > 0, {"string": F.concat(F.lit("k"), F.col("id")), "timestamp_ntz": F.timestamp_seconds("id").cast(kind),
                                        "decimal(20,2)": F.col("id").cast(kind)}[kind]).alias("k")
    target = spark.range(500).select(key, F.col("id").alias("v"))
    versions.create_ranged(target, table, path, ["k"], 8)
    src = spark.range(450, 600).select(key, (F.col("id") + 1000).alias("v")).filter("k is not null")
    for _ in range(2):
        versions.merge_ranges(table, path, src.unionByName(src.withColumn("v", F.col("v") + 1)), "dedup_upsert", order=[("v", "desc")])
        want = rows(merges.load(target, src.withColumn("v", F.col("v") + 1), "upsert", ["k"]))
        assert rows(spark.table(table).select("k", "v")) == want


def test_a_merge_that_ends_between_two_ranges_is_finished_by_the_next(spark, named, monkeypatch):
    table, path = named
    versions.create_ranged(spark.range(1000).select("id", F.lit(0).alias("v")), table, path, ["id"], 10)
    src = spark.range(0, 1000, 50).select("id", F.lit(1).alias("v"))
    point, calls = versions._point, []

    def crash(*args):
        calls.append(args)
        if len(calls) == 4:
            raise OSError("lost")
        point(*args)
    with monkeypatch.context() as m:
        m.setattr(versions, "_point", crash)
        with pytest.raises(OSError):
            versions.merge_ranges(table, path, src)
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 1000  # every range is whole, old or new
    versions.merge_ranges(table, path, src)
    assert spark.table(table).agg(F.count("*"), F.sum("v")).first()[:] == (1000, 20)


def test_nothing_staged_changes_nothing(spark, named):
    table, path = named
    versions.create_ranged(spark.range(10).toDF("id"), table, path, ["id"], 2)
    before = versions.locations(spark, table)
    assert versions.merge_ranges(table, path, spark.range(0).toDF("id")).partitions == ()
    assert versions.locations(spark, table) == before
