"""File-arrival streams: sessions, late events, latest state, delayed labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.times import shift_ts, trunc_ts
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.slots import SLOT


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000,
                glob: str | None = None) -> DataFrame:
    """New files below a path, a bounded number per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def file_microbatch(spark: SparkSession, path: str, schema, fn, out: str, checkpoint: str,
                    fmt: str = "parquet", glob: str | None = None) -> None:
    """Run ``fn`` over the files that arrived since the last run and write its result.

    Each batch replaces its own folder, so a batch that is repeated after a failure adds nothing twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    run_to_end(file_stream(spark, path, schema, fmt, glob=glob).writeStream.foreachBatch(write), checkpoint)


def run_to_end(writer, checkpoint: str) -> None:
    """Process everything that is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def write_parquet(df: DataFrame, out: str, checkpoint: str) -> None:
    run_to_end(df.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def event_time(df: DataFrame, col: str, delay: str) -> DataFrame:
    """Watermark on a column; watermarks need the zoned type, read as UTC in our sessions."""
    return df.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)


def stream_sessions(events: DataFrame, keys: list[str], col: str, gap: str, delay: str,
                    aggs: dict[str, Column]) -> DataFrame:
    """Sessions closed by the watermark. ``end_time`` is the last event, not the window's end."""
    groups = event_time(events, col, delay).groupBy(*keys, F.session_window(col, gap).alias("__w"))
    return groups.agg(F.min(col).alias("start_time"), F.max(col).alias("end_time"),
                      *[c.alias(n) for n, c in aggs.items()]).drop("__w")


def stream_on_time(events: DataFrame, col: str, slack: str, keys: list[str], unit: str,
                   aggs: dict[str, Column]) -> DataFrame:
    """Windowed aggregates that accept events up to ``slack`` late."""
    groups = event_time(events, col, slack).groupBy(F.window(col, unit).alias("__w"), *keys)
    return groups.agg(*[c.alias(n) for n, c in aggs.items()]).select(
        F.col("__w.start").alias("data_at"), *keys, *aggs)


def append_changes(changes: DataFrame, path: str, checkpoint: str, created_at: str = "created_at") -> None:
    """Store change records by creation hour; each batch owns its files below the slot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("slot", F.date_format(created_at, "yyyy-MM-dd-HH"))
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "slot").parquet(path))

    run_to_end(changes.writeStream.foreachBatch(write), checkpoint)


def read_latest(spark: SparkSession, path: str, keys: list[str], version: str, updated_at: str = "updated_at",
                created_at: str = "created_at", older_than=None, tiebreak: list[str] = ()) -> DataFrame:
    """Latest state of the stored changes; ``older_than`` gives only what is final by then."""
    rows = spark.read.parquet(path)
    if older_than is not None:
        rows = rows.filter(F.col(created_at) < older_than)
    kept = dedup_latest(rows.drop("batch_id", "slot"), keys, version, updated_at, tiebreak=tiebreak)
    return kept.withColumn(SLOT, trunc_ts(created_at, "hour"))


def stream_delayed_label(causes: DataFrame, effects: DataFrame, keys: list[str], cause_ts: str,
                         effect_ts: str, wait: tuple[int, str], delay: str) -> DataFrame:
    """Each cause once its wait is over: label time and whether an effect came within the wait.

    An outer stream-stream join: a cause without an effect appears when both watermarks have passed
    the end of its wait. Causes are unique by key, or every effect would be paired with each of them.
    """
    c = event_time(causes, cause_ts, delay).alias("c")
    renamed = effects.select(*[F.col(k).alias(f"e_{k}") for k in keys], F.col(effect_ts).alias("e_ts"))
    e = event_time(renamed, "e_ts", delay).alias("e")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"e.e_{k}") for k in keys])
    limit = F.expr(f"c.{cause_ts} + INTERVAL {wait[0]} {wait[1].upper()}")
    within = (F.col("e.e_ts") >= F.col(f"c.{cause_ts}")) & (F.col("e.e_ts") < limit)
    joined = c.join(e, same & within, "left_outer")
    hit = F.col("e.e_ts").isNotNull()
    return joined.select("c.*", hit.alias("is_occurred"),
                         F.when(hit, F.col("e.e_ts")).otherwise(shift_ts(F.col(f"c.{cause_ts}"), *wait))
                         .alias("occurred_at"))
