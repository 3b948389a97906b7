"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings only, so that they can be applied to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if the split costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", partitions: int = 8, app: str = "tidemark",
                  scratch: str | None = None) -> SparkSession:
    """Single-JVM session for tests and the local benchmark; ``scratch`` holds its temporary tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """New folder under the shared folder that spark.checkpoint.dir names.

    Where the setting is missing, the folder given to ``SparkContext.setCheckpointDir`` is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{require_folder(base).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def require_folder(base: str | None) -> str:
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors can reach")
    return base
