"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, ITEMS, add
from tidemark.functions.numbers import int_div, money, safe_ratio
from tidemark.operators import aggregates as agg
from tidemark.operators.dedup import distinct

PRICE = "CAST(l_extendedprice AS DECIMAL(27,9))"

add("A01_group_by", lambda t: agg.aggregate(t.lineitem, ["l_returnflag", "l_linestatus"], {
    "n": F.count("*"), "parts": F.count("l_partkey"), "price": F.sum(money("l_extendedprice")),
    "first_at": F.min("l_shipdate"), "last_at": F.max("l_shipdate")}),
    f"SELECT l_returnflag, l_linestatus, count(*) AS n, count(l_partkey) AS parts, CAST(sum({PRICE}) AS DOUBLE) AS price, "
    "min(l_shipdate) AS first_at, max(l_shipdate) AS last_at FROM lineitem GROUP BY 1, 2")
add("A02_distinct_counts", lambda t: agg.distinct_counts(
    t.actions, ["unit_id", "event_type"], {"users": "user_id", "items": "lineitem_id"}, "n"),
    f"WITH {ACTIONS} SELECT unit_id, event_type, count(DISTINCT user_id) AS users, count(DISTINCT lineitem_id) AS items, "
    "count(*) AS n FROM actions GROUP BY 1, 2")
add("A03_conditional", lambda t: agg.conditional_agg(t.lineitem, ["l_suppkey"], {
    "returned": (F.col("l_returnflag") == "R", money("l_extendedprice")), "open_lines": (F.col("l_linestatus") == "O", F.lit(1))}),
    f"SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN {PRICE} ELSE 0 END) AS DOUBLE) AS returned, "
    "count(*) FILTER (l_linestatus = 'O') AS open_lines FROM lineitem GROUP BY 1")
add("A04_any_value", lambda t: agg.any_per_key(t.orders, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]),
    "SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _listed(t):
    """Orders of each customer; open orders count as NULL, so some customers have NULLs only."""
    return t.orders.select("o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("o"))


add("A05_joined_list", lambda t: agg.item_list(_listed(t), ["o_custkey"], "o", out="order_id"),
    "WITH r AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS o FROM orders), "
    "n AS (SELECT o_custkey, count(o) AS n FROM r GROUP BY 1), "
    "i AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o) AS position, o AS order_id FROM r WHERE o IS NOT NULL) "
    "SELECT o_custkey, position, order_id, n FROM n LEFT JOIN i USING (o_custkey)")


def _last_times(t):
    return t.actions.groupBy("user_id", "event_type").agg(F.max("time").alias("last_time"))


add("A06_map", lambda t: agg.pivot_last(_last_times(t), ["user_id"], "event_type", "last_time", {
    "last_view": "view", "last_purchase": "purchase", "none": "none"}),
    "SELECT user_id, max(ts) FILTER (event_type = 'view') AS last_view, max(ts) FILTER (event_type = 'purchase') AS last_purchase, "
    "CAST(NULL AS TIMESTAMP) AS none FROM events GROUP BY 1")
add("A07_list_distinct", lambda t: agg.first_distinct(t.items, ["ad_group_id"], "feed", ",", "feeds", 100),
    f"WITH {ITEMS}, d AS (SELECT DISTINCT ad_group_id, feed FROM items QUALIFY dense_rank() OVER (PARTITION BY ad_group_id ORDER BY feed) <= 100) "
    "SELECT ad_group_id, string_agg(feed, ',' ORDER BY feed) AS feeds FROM d GROUP BY 1")
add("A07_distinct_items", lambda t: agg.distinct_list(t.items, ["ad_group_id"], "feed", "feed"),
    f"WITH {ITEMS}, d AS (SELECT DISTINCT ad_group_id, feed FROM items) SELECT ad_group_id, row_number() OVER (PARTITION BY ad_group_id ORDER BY feed) AS position, "
    "feed, count(*) OVER (PARTITION BY ad_group_id) AS n FROM d")
add("A08_lists", lambda t: agg.joined_top(t.items, ["ad_group_id"], "item_name", ",", "names", "n", 50, ["id"]),
    f"WITH {ITEMS}, b AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY ad_group_id ORDER BY id) <= 50) "
    "SELECT ad_group_id, string_agg(item_name, ',' ORDER BY id) AS names, count(*) AS n FROM b GROUP BY 1")
add("A08_whole_lists", lambda t: agg.item_lists(t.items, ["ad_group_id"], {"name": "item_name", "url": "feed"}, ["id"]),
    f"WITH {ITEMS} SELECT ad_group_id, row_number() OVER (PARTITION BY ad_group_id ORDER BY id) AS position, item_name AS name, feed AS url, "
    "count(*) OVER (PARTITION BY ad_group_id) AS n FROM items")
add("A09_duplicates", lambda t: agg.find_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"]),
    "SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")


def _measures(t):
    sources = [(t.logs(k), {f"{k}s": F.lit(1), **({"revenue": F.col("sales")} if k == "purchase" else {})})
               for k in ("view", "click", "purchase")]
    return agg.merge_measures(sources, ["unit_id", "lineitem_id"])


add("A10_merge_measures", _measures,
    f"WITH {ACTIONS} SELECT unit_id, lineitem_id, "
    + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}s" for k in ("view", "click", "purchase"))
    + ", CAST(sum(CASE WHEN event_type = 'purchase' THEN sales ELSE 0 END) AS DOUBLE) AS revenue "
    "FROM actions WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2")


def _scalars(t):
    total = agg.scalar(t.lineitem, F.sum(money("l_extendedprice")), "total")
    none = agg.scalar(t.lineitem.filter("l_quantity < 0"), F.sum(money("l_extendedprice")), "empty_total")
    return total.withColumn("empty_total", none.scalar())


add("A11_scalar", _scalars,
    f"SELECT CAST(sum({PRICE}) AS DOUBLE) AS total, CAST(sum({PRICE}) FILTER (l_quantity < 0) AS DOUBLE) AS empty_total FROM lineitem")
add("A12_distinct", lambda t: distinct(t.actions, ["user_id", "unit_id", "event_type"]),
    f"WITH {ACTIONS} SELECT DISTINCT user_id, unit_id, event_type FROM actions")


def _ratios(t):
    counts = t.actions.groupBy("lineitem_id").agg(F.count_if(F.col("event_type") == "view").alias("imps"),
                                                  F.count_if(F.col("event_type") == "click").alias("clicks"))
    return counts.select("lineitem_id", safe_ratio("clicks", "imps", 2, pct=True).alias("ctr"),
                         int_div("clicks", "imps").alias("whole"))


add("A13_ratio", _ratios,
    f"""WITH {ACTIONS}, c AS (SELECT lineitem_id, count(*) FILTER (event_type = 'view') AS imps, count(*) FILTER (event_type = 'click') AS clicks
FROM actions GROUP BY 1) SELECT lineitem_id, CASE WHEN imps = 0 THEN 0 ELSE round(clicks / imps * 100, 2) END AS ctr,
CASE WHEN imps = 0 THEN 0 ELSE clicks // imps END AS whole FROM c""")
add("A14_split_measure", lambda t: agg.explode_split_measure(
    t.part.select("p_partkey", F.split("p_name", " ").alias("words"), money("p_retailprice").alias("price")),
    "words", "word", "price", "share").groupBy("word").agg(F.round(F.sum("share"), 3).alias("share")),
    """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word, CAST(p_retailprice AS DECIMAL(27,9)) / len(string_split(p_name, ' ')) AS share FROM part)
SELECT word, round(sum(share), 3) AS share FROM w GROUP BY 1""")
