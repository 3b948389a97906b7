"""Joins (J) and set operations (O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, ITEMS, UNITS, add
from tidemark.functions.nested import explode_list
from tidemark.functions.numbers import money
from tidemark.operators import joins

C = ["c_custkey", "c_nationkey"]

add("J01_inner", lambda t: joins.join_dim(t.actions, t.items.withColumnRenamed("id", "lineitem_id"), "lineitem_id").select(
    "event_id", "ad_group_id", "category"),
    f"WITH {ACTIONS}, {ITEMS} SELECT event_id, ad_group_id, category FROM actions JOIN items ON id = lineitem_id")
add("J02_left_star", lambda t: joins.enrich(t.customer.select(*C), [
    (t.nation, "n_nationkey", "c_nationkey", {"nation": "n_name", "n_regionkey": "n_regionkey"}),
    (t.region.filter("r_name <> 'ASIA'"), "r_regionkey", "n_regionkey", {"region": "r_name"})]),
    "SELECT c_custkey, c_nationkey, n_name AS nation, n_regionkey, r_name AS region FROM customer "
    "LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'")
add("J03_anti_left_null", lambda t: joins.anti_join(
    t.logs("view").select("event_id", "user_id", "lineitem_id"), t.logs("purchase"), ["user_id", "lineitem_id"]),
    f"WITH {ACTIONS} SELECT v.event_id, v.user_id, v.lineitem_id FROM actions v LEFT JOIN "
    "(SELECT * FROM actions WHERE event_type = 'purchase') p ON p.user_id = v.user_id AND p.lineitem_id = v.lineitem_id "
    "WHERE v.event_type = 'view' AND p.user_id IS NULL")
add("J04_anti", lambda t: joins.anti_join(
    t.customer.select(F.col("c_custkey").alias("user_id")), t.logs("purchase"), ["user_id"]),
    "SELECT c_custkey AS user_id FROM customer WHERE NOT EXISTS "
    "(SELECT 1 FROM events WHERE event_type = 'purchase' AND user_id = c_custkey)")
add("J05_semi", lambda t: joins.semi_join(t.actions, t.units.filter("organization_id = 1"), ["unit_id"]).select("event_id"),
    f"WITH {ACTIONS}, {UNITS} SELECT event_id FROM actions WHERE unit_id IN (SELECT unit_id FROM units WHERE organization_id = 1)")


def _not_in(t):
    """One list without NULLs, one with: the second leaves nothing."""
    keys = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    holed = t.orders.select(F.nullif("o_custkey", F.lit(7)).alias("k"))
    a = joins.not_in(t.customer.select("c_custkey"), keys, "c_custkey", "k").withColumn("list", F.lit("whole"))
    b = joins.not_in(t.customer.select("c_custkey"), holed, "c_custkey", "k").withColumn("list", F.lit("with null"))
    return a.unionByName(b)


add("J06_not_in", _not_in,
    "SELECT c_custkey, 'whole' AS list FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') "
    "UNION ALL SELECT c_custkey, 'with null' FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 7) FROM orders)")


add("J07_full_outer", lambda t: joins.full_outer_coalesce(
    [t.logs(k).groupBy("user_id", "lineitem_id").agg(F.count("*").alias(f"{k}s")) for k in ("view", "click", "purchase")],
    ["user_id", "lineitem_id"]),
    f"WITH {ACTIONS} SELECT user_id, lineitem_id, "
    + ", ".join(f"nullif(count(*) FILTER (event_type = '{k}'), 0) AS {k}s" for k in ("view", "click", "purchase"))
    + " FROM actions WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2")
add("J08_cross_scalar", lambda t: joins.cross_scalar(
    t.orders.select("o_orderkey", money("o_totalprice").alias("p")),
    t.orders.agg((F.sum(money("o_totalprice")) / F.count("*")).cast("decimal(27,9)")), "mean").filter("p > mean").select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(27,9))) AS DOUBLE) / count(*) FROM orders)")
add("J09_comma_join", lambda t: joins.join_dim(
    t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey")).filter("s_acctbal > 0").select("s_suppkey", "n_name"),
    "SELECT s_suppkey, n_name FROM supplier, nation WHERE s_nationkey = n_nationkey AND s_acctbal > 0")


def _before_last(t):
    """Orders placed before the customer's last finished one (one such order per customer)."""
    last = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_key"))
    rows = joins.range_join(t.orders, last, ["o_custkey"], F.col("l.o_orderkey") < F.col("r.last_key"))
    return rows.select("l.o_orderkey", "r.last_key")


add("J10_range", _before_last,
    "SELECT o_orderkey, last_key FROM orders o JOIN (SELECT o_custkey, max(o_orderkey) AS last_key FROM orders "
    "WHERE o_orderstatus = 'F' GROUP BY 1) l ON o.o_custkey = l.o_custkey AND o.o_orderkey < l.last_key")

# The click of a purchase: the first one of the same user on the same line item.
FIRST_CLICKS = f"""{ACTIONS}, clicks AS (
  SELECT viewer_id || '/' || lineitem_id AS click_id, min(time) AS clicked_at FROM actions WHERE event_type = 'click' GROUP BY 1),
purchases AS (SELECT *, viewer_id || '/' || lineitem_id AS click_id FROM actions WHERE event_type = 'purchase')"""


def with_click_id(df):
    return df.withColumn("click_id", F.concat_ws("/", "viewer_id", "lineitem_id"))


def first_clicks(t):
    return with_click_id(t.logs("click")).groupBy("click_id").agg(F.min("time").alias("clicked_at"))


add("J11_attribution", lambda t: joins.attribute(
    with_click_id(t.logs("purchase")), first_clicks(t), "click_id", "time", "clicked_at", (1, "day")).select(
    "event_id", "click_id", "clicked_at"),
    f"WITH {FIRST_CLICKS} SELECT event_id, click_id, clicked_at FROM purchases JOIN clicks USING (click_id) "
    "WHERE time < clicked_at + INTERVAL 1 DAY")
# Users see several items before they buy: the last view of the day before counts.
VIEWS_OF_BUYERS = """p.event_id, p.user_id, p.sales, v.event_id AS view_id, v.time AS viewed_at,
  row_number() OVER (PARTITION BY p.event_id ORDER BY v.time DESC, v.event_id DESC) AS n
FROM (SELECT * FROM actions WHERE event_type = 'purchase') p {how} JOIN (SELECT * FROM actions WHERE event_type = 'view') v
ON v.user_id = p.user_id AND v.time <= p.time AND p.time < v.time + INTERVAL {within}"""


def _last_view(t, within, how):
    views = t.logs("view").select("user_id", "event_id", "time")
    buys = t.logs("purchase").select("event_id", "user_id", "time", "sales")
    return joins.attribute_last(buys, views, ["user_id"], "time", "time", {"view_id": "event_id", "viewed_at": "time"}, within, how)


add("J11_last_touch", lambda t: _last_view(t, (1, "day"), "left").drop("time"),
    f"WITH {ACTIONS} SELECT event_id, user_id, CAST(sales AS DOUBLE) AS sales, view_id, viewed_at FROM "
    f"(SELECT {VIEWS_OF_BUYERS.format(how='LEFT', within='1 DAY')}) WHERE n = 1")
add("J12_last_touch_lookback", lambda t: _last_view(t, (2, "month"), "inner").drop("time"),
    f"WITH {ACTIONS} SELECT event_id, user_id, CAST(sales AS DOUBLE) AS sales, view_id, viewed_at FROM "
    f"(SELECT {VIEWS_OF_BUYERS.format(how='', within='2 MONTH')}) WHERE n = 1")
add("J12_lookback", lambda t: joins.lookback_join(
    first_clicks(t), with_click_id(t.logs("purchase")).withColumnRenamed("click_id", "cause_id"), "click_id", "cause_id",
    "clicked_at", "time", "2024-01-10 00:00:00", "2024-01-31 00:00:00", (2, "month"), (30, "minute")).select("event_id", "clicked_at"),
    f"""WITH {FIRST_CLICKS} SELECT event_id, clicked_at FROM purchases JOIN clicks USING (click_id)
WHERE clicked_at >= TIMESTAMP '2024-01-10' - INTERVAL 2 MONTH AND clicked_at < TIMESTAMP '2024-01-31' - INTERVAL 30 MINUTE
AND time >= TIMESTAMP '2024-01-10' - INTERVAL 30 MINUTE AND time < TIMESTAMP '2024-01-31' - INTERVAL 30 MINUTE""")
add("J13_offset", lambda t: joins.offset_join(
    t.actions.select("event_id", F.when(F.col("event_type") == "click", F.col("lineitem_id") + 10**9).otherwise(F.col("lineitem_id")).alias("campaign_id")),
    t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), "campaign_id", "id", ["name"]),
    f"""WITH {ACTIONS}, f AS (SELECT event_id, CASE WHEN event_type = 'click' THEN lineitem_id + 1000000000 ELSE lineitem_id END AS campaign_id FROM actions)
SELECT event_id, campaign_id, coalesce(s_name, p_name) AS name FROM f
LEFT JOIN part ON campaign_id > 1000000000 AND p_partkey = campaign_id - 1000000000
LEFT JOIN supplier ON campaign_id <= 1000000000 AND s_suppkey = campaign_id""")


def _blank(t):
    left = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    right = t.customer.groupBy(F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment")).agg(
        F.count("*").alias("n"))
    return joins.join_blank_as_null(left, right, ["segment"])


add("J14_blank_as_null", _blank,
    "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, n FROM customer JOIN "
    "(SELECT c_mktsegment AS m, count(*) AS n FROM customer GROUP BY 1) ON m = c_mktsegment")


def _fallback(t):
    facts = t.customer.select("c_custkey", F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").cast("string").alias("country"))
    dims = t.supplier.select(F.lit("BUILDING").alias("kind"), F.col("s_nationkey").cast("string").alias("country"), F.col("s_suppkey").alias("dim_id"))
    wild = t.region.select(F.lit("BUILDING").alias("kind"), F.lit("ZZ").alias("country"), (F.col("r_regionkey") + 100000).cast("bigint").alias("dim_id"))
    return joins.fallback_join(facts, dims.unionByName(wild), ["kind"], "country", "ZZ")


add("J15_fallback", _fallback,
    """WITH f AS (SELECT c_custkey, c_mktsegment AS kind, CAST(c_nationkey AS VARCHAR) AS country FROM customer),
d AS (SELECT 'BUILDING' AS kind, CAST(s_nationkey AS VARCHAR) AS country, s_suppkey AS dim_id FROM supplier
      UNION ALL SELECT 'BUILDING', 'ZZ', CAST(r_regionkey + 100000 AS BIGINT) FROM region)
SELECT f.*, d.country AS dim_country, dim_id FROM f JOIN d ON f.kind = d.kind AND f.country = d.country
UNION SELECT f.*, d.country, dim_id FROM f JOIN d ON f.kind = d.kind AND d.country = 'ZZ'
WHERE c_custkey NOT IN (SELECT c_custkey FROM f JOIN d ON f.kind = d.kind AND f.country = d.country)""")


def identity(t):
    """Every customer with a balance has a profile."""
    return t.customer.filter("c_acctbal > 0").select(F.lit("IFA").alias("field"), F.col("c_custkey").cast("string").alias("value"),
                                                     (F.col("c_custkey") + 5000).alias("profile_id"))


add("J16_resolve_identity", lambda t: joins.resolve_identity(t.actions, identity(t), "viewer_id").select("event_id", "profile_id"),
    "SELECT event_id, c_custkey + 5000 AS profile_id FROM events LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 0")
add("J17_filtered_dimension", lambda t: joins.join_filtered_dim(
    t.customer.select(*C), t.nation, "c_nationkey", "n_nationkey", F.col("n_regionkey") == 2, {"nation": "n_name"}),
    "SELECT c_custkey, c_nationkey, n_name AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = 2")
add("J18_unnest", lambda t: explode_list(t.embeddings, "embedding", "x", None).groupBy("vec_id").agg(
    F.count("*").alias("n"), F.max("x").cast("double").alias("top")),
    "SELECT vec_id, count(*) AS n, CAST(max(x) AS DOUBLE) AS top FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY 1")
add("J19_roles", lambda t: joins.enrich(t.nation.select("n_nationkey", "n_regionkey"), [
    (t.supplier, "s_suppkey", "n_nationkey", {"owner": "s_name"}), (t.supplier, "s_suppkey", "n_regionkey", {"manager": "s_name"})]),
    "SELECT n_nationkey, n_regionkey, o.s_name AS owner, m.s_name AS manager FROM nation "
    "LEFT JOIN supplier o ON o.s_suppkey = n_nationkey LEFT JOIN supplier m ON m.s_suppkey = n_regionkey")

add("O01_union_all", lambda t: joins.union_all(*[t.logs(k).select("user_id", "unit_id") for k in ("view", "click")]),
    f"WITH {ACTIONS} SELECT user_id, unit_id FROM actions WHERE event_type = 'view' UNION ALL "
    "SELECT user_id, unit_id FROM actions WHERE event_type = 'click'")
add("O02_union_distinct", lambda t: joins.union_distinct(*[t.logs(k).select("user_id", "lineitem_id") for k in ("view", "click")]),
    f"WITH {ACTIONS} SELECT user_id, lineitem_id FROM actions WHERE event_type = 'view' UNION "
    "SELECT user_id, lineitem_id FROM actions WHERE event_type = 'click'")
