"""Service logs as partitioned gzip JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

# The folder layout of the receivers.
PARTITIONS = ["service", "year", "month", "day", "hour", "log_type"]


def write_service_logs(df: DataFrame, path: str) -> int:
    """Write by service, hour and log type; returns the number of rows.

    Rebalancing gathers small folders into one writer each and splits the folders of a chatty service.
    """
    counted = Observation("service logs")
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).hint("rebalance", *[F.col(c) for c in PARTITIONS])
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS)
     .option("compression", "gzip").json(path))
    return counted.get["rows"]
