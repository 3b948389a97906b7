"""Popular and recent products."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import shift_ts, ts
from tidemark.operators.aggregates import joined_top
from tidemark.operators.joins import dealt_anew
from tidemark.operators.ordered import add_rank, add_row_number, sample_per_group, top_n


def _window(events: DataFrame, end, days: int, time: str) -> DataFrame:
    return events.filter((F.col(time) >= shift_ts(ts(end), -days, "day")) & (F.col(time) < ts(end)))


def popular(events: DataFrame, keys: list[str], n: int = 100, mode: str = "top", end=None, days: int = 30,
            time: str = "event_time", action: str = "purchase", seed: int = 0) -> DataFrame:
    """Products by purchases within each group.

    "top": the n most bought as one '|' list, best first; "rank": every product with its rank, ties
    shared; "sample": n random products of a (id, keys) catalogue.
    """
    if mode == "sample":
        drawn = sample_per_group(events, keys, "id", n, seed)
        return joined_top(drawn, keys, "id", "|", "product_ids", "product_count", n)
    rows = _window(events, end, days, time).filter(F.col("event_type") == action)
    counts = rows.groupBy(*keys, "product_id").agg(F.count("*").alias("cnt"))
    if mode == "rank":
        return add_rank(counts, keys, [("cnt", "desc")], "rank").drop("cnt")
    return joined_top(counts, keys, "product_id", "|", "product_ids", "product_count", n, [("cnt", "desc"), "product_id"])


def recent_products(events: DataFrame, actions: dict[str, str], end, days: int = 14,
                    time: str = "event_time") -> DataFrame:
    """Per user, feed and action (output name -> event type), each product with how often it occurs.

    Long form: products are numbered in order and carry the user's number of events of the action.
    """
    name = F.lit(None).cast("string")
    for label, kind in actions.items():
        name = F.when(F.col("event_type") == kind, label).otherwise(name)
    keys = ["viewer_id", "product_feed_id", "action"]
    rows = _window(events, end, days, time).filter(F.col("event_type").isin(*actions.values())).withColumn("action", name)
    counts = rows.groupBy(*keys, "product_id").agg(F.count("*").alias("times"))
    totals = counts.groupBy(*keys).agg(F.sum("times").alias("action_count"))
    placed = add_row_number(counts, keys, ["product_id"], "position")
    return placed.join(dealt_anew(totals), keys)


def user_top_category(events: DataFrame, end, actions: list[str], days: int = 28,
                      time: str = "event_time") -> DataFrame:
    """Each user's most frequent category per feed; a tie goes to the first name."""
    rows = _window(events, end, days, time).filter(F.col("event_type").isin(*actions))
    counts = rows.groupBy("viewer_id", "product_feed_id", "category").agg(F.count("*").alias("cnt"))
    return top_n(counts, ["viewer_id", "product_feed_id"], [("cnt", "desc"), "category"], 1).drop("cnt")
