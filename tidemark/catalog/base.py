"""The registry and the ad-event views the queries are built on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.nested import json_value
from tidemark.functions.numbers import money
from tidemark.functions.times import trunc_ts
from tidemark.session import configure


class Tables:
    """The driver's tables, read lazily, and views that give them the shape of ad logs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def actions(self) -> DataFrame:
        """Events as an ad log; the JSON number is the line item (and product)."""
        user = F.col("user_id")
        return self.events.select(
            "event_id", F.concat(F.lit("ifa:"), user.cast("string")).alias("viewer_id"),
            user.cast("string").alias("ifa"), "user_id", (user % 10).alias("unit_id"),
            json_value("props", "$.k").cast("bigint").alias("lineitem_id"), "event_type",
            F.col("ts").alias("time"), trunc_ts("ts", "hour").alias("partition_timestamp"),
            money("value").alias("sales"))

    def logs(self, kind: str) -> DataFrame:
        return self.actions.filter(F.col("event_type") == kind)

    @cached_property
    def items(self) -> DataFrame:
        """Parts as line items and products; the size is the ad group."""
        return self.part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("item_name"),
            F.col("p_size").alias("ad_group_id"), F.col("p_type").alias("category"),
            F.col("p_brand").alias("feed"), money("p_retailprice").alias("price"))

    @cached_property
    def units(self) -> DataFrame:
        """Nations as ad units; the region is type and organisation."""
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("unit_id"), F.col("n_name").alias("unit_name"),
            F.col("r_name").alias("unit_type"), F.col("n_regionkey").alias("organization_id"))


# The same views in SQL, to be used as CTEs.
ACTIONS = """actions AS (
  SELECT event_id, 'ifa:' || user_id AS viewer_id, CAST(user_id AS VARCHAR) AS ifa, user_id,
         user_id % 10 AS unit_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS lineitem_id,
         event_type, ts AS time, date_trunc('hour', ts) AS partition_timestamp,
         CAST(value AS DECIMAL(27,9)) AS sales
  FROM events)"""
ITEMS = """items AS (
  SELECT p_partkey AS id, p_name AS item_name, p_size AS ad_group_id, p_type AS category,
         p_brand AS feed, CAST(p_retailprice AS DECIMAL(27,9)) AS price
  FROM part)"""
UNITS = """units AS (
  SELECT CAST(n_nationkey AS BIGINT) AS unit_id, n_name AS unit_name, r_name AS unit_type,
         n_regionkey AS organization_id
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@dataclass(frozen=True)
class Query:
    key: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return comparable(self.run(Tables(spark, folder)))


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without a zone, as the SQL side returns them."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


REGISTRY: dict[str, Query] = {}


def add(key: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if key in REGISTRY:
        raise ValueError(f"{key} is registered twice")
    REGISTRY[key] = Query(key, run, sql)


def query(key: str, sql: str | None = None):
    def register(fn):
        add(key, fn, sql)
        return fn
    return register
