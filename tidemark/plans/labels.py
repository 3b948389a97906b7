"""Training labels, event–product resolution and user histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import csv_record
from tidemark.functions.times import diff_complete, shift_ts, ts
from tidemark.operators.aggregates import item_list
from tidemark.operators.joins import anti_join, dealt_anew, union_all
from tidemark.operators.ordered import last_n, running_sum, top_n, value_range
from tidemark.operators.slots import drop_late

LABEL_COLUMNS = ["viewer_id", "allocation_id", "lineitem_id", "unit_id", "product_id", "product_feed_id",
                 "user_action", "is_occurred", "reward_condition", "occurred_at"]


def reward_condition() -> Column:
    return (F.when(F.col("action_point") > 0, F.col("revenue_type"))
            .when(F.col("landing_point") > 0, "click").otherwise("none"))


def _one_feed(products: DataFrame) -> DataFrame:
    return products.groupBy("id").agg(F.min("product_feed_id").alias("product_feed_id")).withColumnRenamed(
        "id", "product_id")


def click_labels(imps: DataFrame, clicks: DataFrame, products: DataFrame, lineitems: DataFrame) -> DataFrame:
    """One label per (allocation, line item) with an impression: was it clicked?

    One aggregate over both logs; products and line items (id, action_point, landing_point,
    revenue_type) are joined after it.
    """
    cols = ["viewer_id", "allocation_id", "lineitem_id", "unit_id", "product_id", "time"]
    rows = union_all(imps.select(*cols, F.lit(0).alias("__click")), clicks.select(*cols, F.lit(1).alias("__click")))
    pairs = rows.groupBy("allocation_id", "lineitem_id").agg(
        F.min("viewer_id").alias("viewer_id"), F.min("unit_id").alias("unit_id"),
        F.min("product_id").alias("product_id"), F.max("time").alias("occurred_at"),
        F.min("__click").alias("__lo"), F.max("__click").alias("__hi"))
    seen = pairs.filter(F.col("__lo") == 0).withColumns({
        "is_occurred": F.col("__hi") == 1, "user_action": F.lit("click_from_impression")})
    return _with_reward(seen, products, lineitems)


def _with_reward(rows: DataFrame, products: DataFrame, lineitems: DataFrame) -> DataFrame:
    items = lineitems.select(F.col("id").alias("lineitem_id"), "action_point", "landing_point", "revenue_type")
    joined = rows.join(_one_feed(products), "product_id", "left").join(items, "lineitem_id", "left")
    return joined.withColumn("reward_condition", reward_condition()).select(*LABEL_COLUMNS)


def delayed_click_labels(imps: DataFrame, clicks: DataFrame, products: DataFrame, lineitems: DataFrame,
                         start, end, wait: tuple[int, str] = (1, "hour")) -> DataFrame:
    """Clicks of [start, end) as occurred; impressions whose wait ended in it without one as not."""
    low, high = shift_ts(ts(start), -wait[0], wait[1]), shift_ts(ts(end), -wait[0], wait[1])
    keys = ["allocation_id", "lineitem_id"]

    def latest(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.min("viewer_id").alias("viewer_id"), F.min("unit_id").alias("unit_id"),
                                     F.min("product_id").alias("product_id"), F.max("time").alias("time"))

    clicked = latest(clicks.filter((F.col("time") >= low) & (F.col("time") < ts(end))))
    shown = latest(imps.filter((F.col("time") >= low) & (F.col("time") < high)))
    missed = anti_join(shown, clicked, keys).withColumns({
        "is_occurred": F.lit(False), "occurred_at": shift_ts("time", *wait)})
    hit = clicked.filter(F.col("time") >= ts(start)).withColumns({
        "is_occurred": F.lit(True), "occurred_at": F.col("time")})
    rows = union_all(missed, hit).withColumn("user_action", F.lit("click_from_impression"))
    return _with_reward(rows, products, lineitems)


def funnel_labels(events: DataFrame, cause: str, effect: str, wait: tuple[int, str], start, end,
                  delayed: bool = False) -> DataFrame:
    """Effects as occurred, and causes without any effect on the same product as not occurred.

    ``events`` are resolved (viewer_id, product_id, product_feed_id, lineitem_id, unit_id, event_type,
    event_time). The delayed form labels at cause time plus wait; the immediate one at event time.
    """
    low, high = shift_ts(ts(start), -wait[0], wait[1]), shift_ts(ts(end), -wait[0], wait[1])
    rows = events.filter((F.col("event_time") >= low) & (F.col("event_time") < ts(end))
                         & F.col("event_type").isin(cause, effect))
    keys, time = ["viewer_id", "product_id"], F.col("event_time")
    effects = rows.filter(F.col("event_type") == effect).drop("event_type")
    causes = rows.filter((F.col("event_type") == cause) & (time < high)).groupBy(*keys).agg(
        F.min("lineitem_id").alias("lineitem_id"), F.min("unit_id").alias("unit_id"),
        F.min("product_feed_id").alias("product_feed_id"), F.max("event_time").alias("event_time"))
    hits = effects.filter(time >= ts(start) if delayed else time < high).withColumns({
        "is_occurred": F.lit(True), "occurred_at": time})
    missed = anti_join(causes, effects, keys).withColumns({
        "is_occurred": F.lit(False), "occurred_at": shift_ts("event_time", *wait) if delayed else time})
    none = F.lit(None).cast("string")
    out = union_all(*[p.withColumns({"allocation_id": none, "reward_condition": none,
                                     "user_action": F.lit(f"{effect}_from_{cause}")}).select(*LABEL_COLUMNS)
                      for p in (hits, missed)])
    return out.distinct()


def resolve_products(events: DataFrame, mapping: DataFrame, products: DataFrame, how: str = "inner",
                     types: tuple[str, ...] = ("view_detail", "add_to_cart", "purchase"),
                     slot: str = "partition_timestamp") -> DataFrame:
    """One row per event and listed product code, with the product of the source's feed.

    Events carry ``product_codes`` (comma list), ``event_source_id``, ``extra_segment1`` and revenue;
    mapping is source -> feed; products are reduced to one row per id. The left form keeps unknown
    codes and splits the revenue over the listed codes.
    """
    usable = ((F.col("extra_segment1") != "") & (F.col("viewer_id") != "") & F.col("event_type").isin(*types))
    rows = drop_late(events.filter(usable), "event_time", slot)
    codes = F.split("product_codes", ",")
    share = F.col("event_revenue").cast("decimal(27,9)") / F.size(codes)
    flat = rows.withColumn("event_average_revenue", share.cast("decimal(32,16)")).withColumn(
        "product_code", F.explode(codes))
    best = products.groupBy("id").agg(*[F.min(c).alias(c) for c in
                                        ("product_feed_id", "code", "category", "price", "currency")])
    pp = best.select(F.col("id").alias("product_id"), "product_feed_id", F.col("code").alias("product_code"),
                     "category", F.col("price").alias("product_price"),
                     F.upper("currency").alias("product_currency"))
    feeds = mapping.select("event_source_id", F.col("product_feed_id").alias("__feed"))
    joined = flat.join(feeds, "event_source_id").join(
        pp.withColumnRenamed("product_code", "__code"),
        (F.col("__feed") == F.col("product_feed_id")) & (F.col("product_code") == F.col("__code")), how)
    base = ["viewer_id", "lineitem_id", "unit_id", "event_type", "event_time"]
    if how == "inner":
        return joined.select(*base, "product_id", "product_feed_id", "category")
    return joined.select(*base, "event_source_id", "product_code", "event_average_revenue",
                         F.upper("event_currency").alias("event_currency"), "product_id",
                         "product_feed_id", "category", "product_price", "product_currency")


def recent_window(df: DataFrame, time: str, end, days: int) -> DataFrame:
    return df.filter((F.col(time) > shift_ts(ts(end), -days, "day")) & (F.col(time) <= ts(end)))


def user_histories(labels: DataFrame, end, days: int = 28, n: int = 200,
                   crc: DataFrame | None = None, categories: DataFrame | None = None) -> DataFrame:
    """Newest n labels of each user as records of nine fields, numbered from the newest; ties beyond n stay.

    ``crc`` (viewer_id, crc) restricts to known users and adds their bucket; ``categories``
    (product_id, category) adds the user's most frequent category, ties kept.
    """
    recent = recent_window(labels, "occurred_at", end, days)
    kept = last_n(recent, ["viewer_id"], ["occurred_at"], n)
    stamp = F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss.SSS")
    record = csv_record("allocation_id", "lineitem_id", "unit_id", "product_id", "product_feed_id",
                        "user_action", "is_occurred", "reward_condition", stamp)
    ordered = kept.select("viewer_id", record.alias("history"),
                          F.timestamp_diff("MICROSECOND", F.col("occurred_at"), ts(end)).alias("__age"))
    out = item_list(ordered, ["viewer_id"], "history", ["__age", "history"], out="history", count="count")
    if crc is not None:
        out = out.join(crc.select("viewer_id", "crc").distinct(), "viewer_id")
    if categories is not None:
        done = recent.filter("is_occurred").join(categories, "product_id").groupBy("viewer_id", "category").agg(
            F.count("*").alias("n"))
        top = top_n(done, ["viewer_id"], [("n", "desc")], 1, ties="keep").drop("n")
        out = out.join(top, "viewer_id", "left")
    return out


def recency_profile(events: DataFrame, end, actions: list[str], source=None, days: int = 28) -> DataFrame:
    """Last time and elapsed whole hours per action, overall and for one source.

    Users without an event of the source are left out. One aggregate instead of two maps and three joins.
    """
    rows = recent_window(events, "event_time", end, days).filter(F.col("event_type").isin(*actions))
    mine = F.col("event_source_id") == F.lit(source)
    aggs = [F.count("*").alias("total_count"), F.count_if(mine).alias("source_count")]
    for a in actions:
        hit = F.col("event_type") == a
        aggs += [F.max(F.when(hit, F.col("event_time"))).alias(f"last_{a}"),
                 F.max(F.when(hit & mine, F.col("event_time"))).alias(f"source_last_{a}")]
    out = rows.groupBy("viewer_id").agg(*aggs).filter(F.col("source_count") > 0)
    names = [f"{p}last_{a}" for p in ("", "source_") for a in actions]
    return out.withColumns({f"elapsed_hour_{n}": diff_complete("hour", n, ts(end)) for n in names})


def inactive_days(users: DataFrame, events: DataFrame, now, end, actions: list[str], cap: int = 28,
                  time: str = "partition_timestamp") -> DataFrame:
    """Whole days since the last event of each action, ``cap`` when there is none in the window."""
    rows = events.filter((F.col(time) >= shift_ts(ts(now), -cap, "day")) & (F.col(time) < ts(end)))
    last = rows.groupBy("viewer_id").agg(
        *[F.max(F.when(F.col("event_type") == a, F.col(time))).alias(a) for a in actions])
    joined = users.distinct().join(last, "viewer_id", "left")
    days = [F.coalesce(diff_complete("day", a, ts(now)), F.lit(cap)).alias(f"inactive_{a}_day") for a in actions]
    return joined.select(*users.columns, *days)


def baskets(labels: DataFrame, end, days: int = 28, feed=None, action: str = "purchase_from_view_detail") -> DataFrame:
    """Products each user bought, without the rarest product: one row per user and product, numbered.

    Products are ordered by buyers, most first; a product stays while the cumulative count is below
    the total. The running sum runs over count levels and ranges of product ids, not over one task.
    """
    rows = recent_window(labels, "occurred_at", end, days).filter(
        F.col("is_occurred") & (F.col("user_action") == action))
    rows = rows.filter(F.col("product_feed_id") == F.lit(feed)) if feed is not None else rows
    bought = rows.select("viewer_id", "product_id").distinct()
    counts = bought.groupBy("product_id").agg(F.count("*").alias("cnt")).withColumn("__rare", -F.col("cnt"))
    level = F.struct(F.col("__rare"), value_range(counts, "product_id").alias("r"))
    summed = running_sum(counts, "cnt", [], ["__rare", "product_id"], "acc", bucket=level)
    total = counts.agg(F.sum("cnt")).scalar()
    kept = summed.filter(F.col("acc") < total).select("product_id")
    rows = bought.join(dealt_anew(kept), "product_id", "left_semi")
    return item_list(rows, ["viewer_id"], "product_id", out="product_id", count="product_count")
