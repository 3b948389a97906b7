"""Tables in the shared folder, and the small frame helpers every operator needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The files outlive any executor, so nothing before this point is ever computed again; the shuffle
    files of the write are therefore deleted as soon as it is done.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; others can't clash with them."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the faster function, which agrees there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
