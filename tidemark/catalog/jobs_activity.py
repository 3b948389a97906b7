"""Reach, activity, sessions and demographics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, UNITS, add
from tidemark.catalog.expressions import DEMOGRAPHICS, demographics
from tidemark.catalog.joins import FIRST_CLICKS, with_click_id
from tidemark.functions.times import trunc_ts
from tidemark.plans import marts, reach

KST_DAY = "CAST(date_trunc('day', time + INTERVAL 9 HOUR) AS TIMESTAMP)"


def dim(t):
    """Line items with their ad group; some have none."""
    return t.items.select("id", F.nullif("ad_group_id", F.lit(1)).alias("ad_group_id"))


DIM = "dim AS (SELECT p_partkey AS id, nullif(p_size, 1) AS ad_group_id FROM part)"
REACH = "count(DISTINCT viewer_id) AS unique_users FROM actions JOIN dim ON id = lineitem_id WHERE ad_group_id IS NOT NULL AND event_type = "

add("B01_unique_reach_hour", lambda t: reach.unique_reach(t.logs("click"), dim(t), "hour"),
    f"WITH {ACTIONS}, {DIM} SELECT date_trunc('hour', time) AS data_at, ad_group_id, {REACH}'click' GROUP BY 1, 2")
add("B01_unique_reach_day", lambda t: reach.unique_reach(t.logs("view"), dim(t), "day"),
    f"WITH {ACTIONS}, {DIM} SELECT {KST_DAY} - INTERVAL 9 HOUR AS data_at, ad_group_id, {REACH}'view' GROUP BY 1, 2")
add("B01_unique_reach_all", lambda t: reach.unique_reach(t.logs("view"), None, "all", entity="lineitem_id"),
    f"WITH {ACTIONS} SELECT lineitem_id, count(DISTINCT viewer_id) AS unique_users FROM actions WHERE event_type = 'view' GROUP BY 1")


def _video(t):
    """Purchases stand for play logs: they know the click's id, the click knows the viewer."""
    clicks = with_click_id(t.logs("click")).groupBy("click_id").agg(F.min("viewer_id").alias("viewer_id"))
    plays = with_click_id(t.logs("purchase")).select("click_id", "lineitem_id", "time")
    return reach.unique_reach(clicks, dim(t), "day", via=plays)


add("B01_unique_reach_video", _video,
    f"WITH {FIRST_CLICKS}, {DIM} SELECT {KST_DAY} - INTERVAL 9 HOUR AS data_at, ad_group_id, count(DISTINCT viewer_id) AS unique_users "
    "FROM purchases JOIN clicks USING (click_id) JOIN dim ON id = lineitem_id WHERE ad_group_id IS NOT NULL GROUP BY 1, 2")

add("B02_daily_active", lambda t: reach.daily_active(t.logs("view"), ["ifa", "lineitem_id"], ["time", "event_id"]),
    f"""WITH {ACTIONS} SELECT {KST_DAY} AS created_at, viewer_id, unit_id, ifa, lineitem_id FROM actions WHERE event_type = 'view'
QUALIFY row_number() OVER (PARTITION BY {KST_DAY}, viewer_id, unit_id ORDER BY time, event_id) = 1""")
add("B02_daily_active_last", lambda t: reach.daily_active(
    t.actions, ["event_type", "lineitem_id", "sales"], ["time", "event_id"], last=True),
    f"""WITH {ACTIONS} SELECT {KST_DAY} AS created_at, viewer_id, unit_id, event_type, lineitem_id, CAST(sales AS DOUBLE) AS sales FROM actions
QUALIFY row_number() OVER (PARTITION BY {KST_DAY}, viewer_id, unit_id ORDER BY time DESC, event_id DESC) = 1""")


def dau(t, kind):
    return reach.daily_active(t.logs(kind), ["ifa"], ["time", "event_id"])


DAU = f"""{{name}} AS (SELECT DISTINCT {KST_DAY} AS created_at, viewer_id, unit_id, ifa FROM actions WHERE event_type = '{{kind}}')"""


def known(t):
    """Users registered before: those with a sign-up in the first half of the month."""
    return t.logs("signup").filter(F.col("time") < F.lit("2024-01-10").cast("timestamp_ntz")).select("viewer_id", "unit_id")


add("B03_new_users", lambda t: reach.new_users(dau(t, "click"), known(t), ["viewer_id", "unit_id"], "2024-01-01 00:00:00", "2024-02-01 00:00:00"),
    f"""WITH {ACTIONS}, {DAU.format(name='dau', kind='click')} SELECT dau.* FROM dau LEFT JOIN
(SELECT DISTINCT viewer_id, unit_id FROM actions WHERE event_type = 'signup' AND time < TIMESTAMP '2024-01-10') k
ON k.viewer_id = dau.viewer_id AND k.unit_id = dau.unit_id WHERE k.viewer_id IS NULL""")


def _metrics(t):
    nru = t.logs("signup").groupBy("unit_id", "ifa").agg(trunc_ts(F.min("time"), "day").alias("created_at"))
    locked = t.logs("signup").groupBy("unit_id", trunc_ts("time", "day").alias("data_at")).agg(
        F.count("*").alias("dau"), F.count_distinct("ifa").alias("nru"))
    return reach.activity_metrics(dau(t, "click"), dau(t, "view"), nru, t.units.drop("organization_id"), "2024-01-24", locked,
                                  locked_type="ASIA")


DAY = "created_at >= TIMESTAMP '2024-01-24' AND created_at < TIMESTAMP '2024-01-25'"
MONTH = "created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-01-25'"
add("B04_activity_metrics", _metrics,
    f"""WITH {ACTIONS}, {UNITS}, {DAU.format(name='dau', kind='click')}, {DAU.format(name='views', kind='view')},
nru AS (SELECT unit_id, ifa, CAST(date_trunc('day', min(time)) AS TIMESTAMP) AS created_at FROM actions WHERE event_type = 'signup' GROUP BY 1, 2),
parts AS (
 SELECT unit_id, count(*) FILTER ({DAY}) AS dau, 0 AS dua, 0 AS nru, count(DISTINCT ifa) AS mau, 0 AS mua FROM dau JOIN units USING (unit_id)
 WHERE {MONTH} AND unit_type <> 'ASIA' GROUP BY 1
 UNION ALL SELECT unit_id, 0, count(*) FILTER ({DAY}), 0, 0, count(DISTINCT ifa) FROM views JOIN units USING (unit_id) WHERE {MONTH} GROUP BY 1
 UNION ALL SELECT unit_id, 0, 0, count(*), 0, 0 FROM nru JOIN units USING (unit_id) WHERE {DAY} AND unit_type <> 'ASIA' GROUP BY 1
 UNION ALL SELECT unit_id, count(*), 0, count(DISTINCT ifa), 0, 0 FROM actions JOIN units USING (unit_id)
 WHERE event_type = 'signup' AND unit_type = 'ASIA' AND time >= TIMESTAMP '2024-01-24' AND time < TIMESTAMP '2024-01-25' GROUP BY 1)
SELECT TIMESTAMP '2024-01-24' AS kst_at, unit_id, unit_name, unit_type, CAST(sum(dau) AS BIGINT) AS dau, CAST(sum(dua) AS BIGINT) AS dua,
CAST(sum(nru) AS BIGINT) AS nru, CAST(sum(mau) AS BIGINT) AS mau, CAST(sum(mua) AS BIGINT) AS mua FROM parts JOIN units USING (unit_id) GROUP BY 1, 2, 3, 4""")

WEEK = "CAST(date_trunc('week', time + INTERVAL 9 HOUR) AS TIMESTAMP)"
add("B05_weekly_frequency", lambda t: reach.weekly_frequency(t.logs("click"), t.logs("view"), ["ifa", "unit_id"]),
    f"""WITH {ACTIONS}, wau AS (SELECT DISTINCT ifa, unit_id, {WEEK} AS week_joined FROM actions WHERE event_type = 'click'),
d AS (SELECT DISTINCT ifa, unit_id, {WEEK} AS week_joined, {KST_DAY} AS day FROM actions WHERE event_type = 'view')
SELECT ifa, unit_id, week_joined, count(day) AS days_active FROM wau LEFT JOIN d USING (ifa, unit_id, week_joined) GROUP BY 1, 2, 3""")

KINDS = {"content_imp": "view", "content_clk": "click", "ad_imp": "signup", "ad_clk": "purchase"}


def _sessions(t):
    actions = t.actions.select("ifa", "unit_id", F.col("time").alias("created_at"), F.col("event_type").alias("action"))
    devices = t.customer.select(F.col("c_custkey").cast("string").alias("ifa"), F.col("c_nationkey").alias("country"),
                                F.col("c_mktsegment").alias("sex")).filter("country <> 3")
    return reach.user_sessions(actions, ["ifa", "unit_id"], 6 * 3600, KINDS, devices, "ifa").drop("session_id")


add("B07_user_sessions", _sessions,
    f"""WITH {ACTIONS}, d AS (SELECT ifa, unit_id, time, event_type, CASE WHEN date_diff('second', lag(time) OVER w, time) <= 21600 THEN 0 ELSE 1 END AS opens
FROM actions WINDOW w AS (PARTITION BY ifa, unit_id ORDER BY time)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY ifa, unit_id ORDER BY time ROWS UNBOUNDED PRECEDING) AS no FROM d),
g AS (SELECT ifa, unit_id, no, min(time) AS start_time, max(time) AS end_time, {", ".join(f"count(*) FILTER (event_type = '{k}') AS {n}" for n, k in KINDS.items())}
FROM s GROUP BY 1, 2, 3)
SELECT ifa, unit_id, start_time, end_time, {", ".join(KINDS)}, date_diff('second', start_time, end_time) AS duration, c_nationkey AS country, c_mktsegment AS sex
FROM g LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = ifa AND c_nationkey <> 3""")


def _engagement(t):
    base = dau(t, "signup").withColumn("device_id", F.col("ifa").cast("bigint")).drop("viewer_id")
    points = t.orders.select(F.col("o_custkey").alias("device_id"), F.col("o_orderkey").alias("amount"), F.lit(1).cast("bigint").alias("base_reward"))
    one = F.lit(1)
    return marts.dau_engagement(base, {"ad_imp_count": (t.logs("view"), one), "ad_click_count": (t.logs("click"), one),
                                       "ad_reward": (t.logs("purchase"), F.col("sales"))}, points)


add("B28_dau_engagement", _engagement,
    f"""WITH {ACTIONS}, {DAU.format(name='dau', kind='signup')},
m AS (SELECT ifa, count(*) FILTER (event_type = 'view') AS ad_imp_count, count(*) FILTER (event_type = 'click') AS ad_click_count,
 CAST(sum(CASE WHEN event_type = 'purchase' THEN sales ELSE 0 END) AS DOUBLE) AS ad_reward FROM actions WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1),
p AS (SELECT o_custkey, CAST(sum(o_orderkey) AS BIGINT) AS reward, count(*) AS base_reward FROM orders GROUP BY 1)
SELECT created_at, unit_id, dau.ifa, CAST(dau.ifa AS BIGINT) AS device_id, coalesce(ad_imp_count, 0) AS ad_imp_count, coalesce(ad_click_count, 0) AS ad_click_count,
coalesce(ad_reward, 0) AS ad_reward, coalesce(reward, 0) AS reward, coalesce(base_reward, 0) AS base_reward
FROM dau LEFT JOIN m ON m.ifa = dau.ifa LEFT JOIN p ON o_custkey = CAST(dau.ifa AS BIGINT)""")

add("B31_unique_clickers_day", lambda t: reach.unique_clickers(t.logs("click"), t.units, "NATION%", "day", F.col("unit_type") != "ASIA"),
    f"""WITH {ACTIONS}, {UNITS} SELECT {KST_DAY} AS data_at, unit_name, count(DISTINCT ifa) AS clickers FROM actions JOIN units USING (unit_id)
WHERE event_type = 'click' AND unit_name LIKE 'NATION%' AND unit_type <> 'ASIA' GROUP BY 1, 2""")
add("B31_unique_clickers_month", lambda t: reach.unique_clickers(t.logs("click"), t.units, "NATION__", "month"),
    f"""WITH {ACTIONS}, {UNITS} SELECT CAST(date_trunc('month', time + INTERVAL 9 HOUR) AS TIMESTAMP) AS data_at, unit_name, count(DISTINCT ifa) AS clickers
FROM actions JOIN units USING (unit_id) WHERE event_type = 'click' AND unit_name LIKE 'NATION__' GROUP BY 1, 2""")


def _page_views(t):
    """Lines are impressions and orders the allocations they were first served by."""
    imps = t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("s_nationkey").cast("bigint").alias("unit_id"), F.col("l_orderkey").alias("initial_allocation_id"))
    allocs = t.orders.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderdate").alias("created_at"))
    return reach.page_views(imps, allocs, t.units.drop("organization_id"))


add("B32_page_views", _page_views,
    f"""WITH {UNITS} SELECT CAST(date_trunc('day', o_orderdate + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_at, unit_id, unit_name, unit_type,
count(DISTINCT l_orderkey) AS pv FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN units ON unit_id = s_nationkey
JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4""")
add("B39_daily_demographics", lambda t: reach.daily_demographics(
    demographics(t), "2024-01-01 00:00:00", "2024-02-01 00:00:00", ["unit_id", "event_type"], "n"),
    f"""WITH {DEMOGRAPHICS} SELECT CAST(date_trunc('day', partition_timestamp + INTERVAL 9 HOUR) AS TIMESTAMP) AS date_at, unit_id, event_type,
year_of_birth, sex, count(*) AS n FROM clean GROUP BY 1, 2, 3, 4, 5""")
