"""Segment performance and event unification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.nested import explode_identities, payload_map
from tidemark.functions.text import split_part_or_null
from tidemark.functions.times import ts
from tidemark.operators.joins import union_all


def segment_performance(imps: DataFrame, clicks: DataFrame, convs: DataFrame, identity: DataFrame,
                        segments: DataFrame, start) -> DataFrame:
    """Counts, users and revenue per line item and segment; users without a segment keep NULL.

    Events are (viewer_id 'kind:value', lineitem_id, sales). The three logs are joined to the
    identities once, and a single distinct count per (line item, segment, log) follows.
    """
    tagged = union_all(*[df.select("viewer_id", "lineitem_id", "sales", F.lit(n).alias("src"))
                         for n, df in (("impression", imps), ("click", clicks), ("conversion", convs))])
    members = identity.select("field", "value", "profile_id").join(
        segments.select("profile_id", "segment_id").distinct(), "profile_id", "left")
    keyed = tagged.withColumns({"field": F.upper(split_part_or_null("viewer_id", ":", 1)),
                                "value": split_part_or_null("viewer_id", ":", 2)})
    rows = keyed.join(members, ["field", "value"], "left")
    per_log = rows.groupBy("lineitem_id", "segment_id", "src").agg(
        F.count("*").alias("n"), F.sum("sales").alias("revenue"), F.count_distinct("viewer_id").alias("users"))
    names = ("impression", "click", "conversion")

    def total(col: str, src: str) -> Column:
        return F.sum(F.when(F.col("src") == src, F.col(col)).otherwise(0))

    out = per_log.groupBy("lineitem_id", "segment_id").agg(
        *[total("n", s).alias(f"{s}_count") for s in names], F.sum("revenue").alias("revenue"),
        *[total("users", s).alias(f"{s}_user_count") for s in names])
    return out.select(ts(start).alias("data_at"), "*")


def unify_events(sources: list[dict], data_source_id=None) -> DataFrame:
    """Events of several logs in one shape, one row per identifier that is present.

    A source is {df, event_type, time, payload: {name: column}, identities: {kind: column}}.
    """
    parts = []
    for s in sources:
        kind = s["event_type"]
        shaped = s["df"].select(
            F.lit(data_source_id if data_source_id is not None else s["data_source_id"]).alias("data_source_id"),
            (kind if isinstance(kind, Column) else F.lit(kind)).alias("event_type"),
            F.col(s["time"]).alias("event_timestamp"), payload_map(s["payload"]).alias("payload"),
            *[(c if isinstance(c, Column) else F.col(c)).alias(f"__{k}") for k, c in s["identities"].items()])
        ids = {k: F.col(f"__{k}") for k in s["identities"]}
        parts.append(explode_identities(shaped, ids).drop(*[f"__{k}" for k in s["identities"]]))
    return union_all(*parts)
