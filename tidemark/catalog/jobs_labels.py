"""Labels, histories, baskets and popularity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, add, ITEMS
from tidemark.functions.numbers import money
from tidemark.plans import labels, popularity

END = "2024-01-31 00:00:00"

# Impressions are views, the allocation is user/unit; the product is the part's successor.
LOG = """log AS (SELECT *, user_id || '-' || unit_id AS allocation_id, lineitem_id + 1 AS product_id FROM actions)"""
LINEITEMS = """li AS (SELECT p_partkey AS id, p_size % 3 AS action_point, p_size % 2 AS landing_point, p_type AS revenue_type, p_brand AS feed FROM part)"""
REWARD = "CASE WHEN action_point > 0 THEN revenue_type WHEN landing_point > 0 THEN 'click' ELSE 'none' END"


def log(t, kind):
    return t.logs(kind).withColumns({"allocation_id": F.concat_ws("-", "user_id", "unit_id"), "product_id": F.col("lineitem_id") + 1})


def products(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("product_feed_id"))


def lineitems(t):
    return t.part.select(F.col("p_partkey").alias("id"), (F.col("p_size") % 3).alias("action_point"),
                         (F.col("p_size") % 2).alias("landing_point"), F.col("p_type").alias("revenue_type"))


PICK = """SELECT viewer_id, allocation_id, lineitem_id, unit_id, product_id, pp.feed AS product_feed_id, 'click_from_impression' AS user_action,
 is_occurred, {reward} AS reward_condition, occurred_at FROM pairs LEFT JOIN li pp ON pp.id = product_id LEFT JOIN li ON li.id = lineitem_id""".format(
    reward=REWARD.replace("action_point", "li.action_point").replace("revenue_type", "li.revenue_type").replace("landing_point", "li.landing_point"))

add("B08_click_labels", lambda t: labels.click_labels(log(t, "view"), log(t, "click"), products(t), lineitems(t)),
    f"""WITH {ACTIONS}, {LOG}, {LINEITEMS}, pairs AS (SELECT min(viewer_id) AS viewer_id, allocation_id, lineitem_id, min(unit_id) AS unit_id,
 min(product_id) AS product_id, max(time) AS occurred_at, count(*) FILTER (event_type = 'click') > 0 AS is_occurred
 FROM log WHERE event_type IN ('view', 'click') GROUP BY 2, 3 HAVING count(*) FILTER (event_type = 'view') > 0) {PICK}""")
add("X07_delayed_label", lambda t: labels.delayed_click_labels(
    log(t, "view"), log(t, "click"), products(t), lineitems(t), "2024-01-05 00:00:00", "2024-01-25 00:00:00"),
    f"""WITH {ACTIONS}, {LOG}, {LINEITEMS}, c AS (SELECT min(viewer_id) AS viewer_id, allocation_id, lineitem_id, min(unit_id) AS unit_id,
 min(product_id) AS product_id, max(time) AS time FROM log WHERE event_type = 'click' AND time >= TIMESTAMP '2024-01-04 23:00:00'
 AND time < TIMESTAMP '2024-01-25' GROUP BY 2, 3),
i AS (SELECT min(viewer_id) AS viewer_id, allocation_id, lineitem_id, min(unit_id) AS unit_id, min(product_id) AS product_id, max(time) AS time
 FROM log WHERE event_type = 'view' AND time >= TIMESTAMP '2024-01-04 23:00:00' AND time < TIMESTAMP '2024-01-24 23:00:00' GROUP BY 2, 3),
pairs AS (SELECT i.* EXCLUDE (time), FALSE AS is_occurred, i.time + INTERVAL 1 HOUR AS occurred_at FROM i LEFT JOIN c USING (allocation_id, lineitem_id)
 WHERE c.viewer_id IS NULL UNION SELECT * EXCLUDE (time), TRUE, time FROM c WHERE time >= TIMESTAMP '2024-01-05') {PICK}""")

# Events as seen by advertisers: views are detail views, sign-ups cart additions; codes are part ids.
KIND = {"view": "view_detail", "signup": "add_to_cart", "purchase": "purchase"}


def raw_events(t):
    kind = F.create_map(*[F.lit(x) for p in KIND.items() for x in p])[F.col("event_type")]
    return t.actions.select(
        F.when(F.col("sales") > 1, F.col("viewer_id")).otherwise("").alias("viewer_id"), "lineitem_id", "unit_id",
        F.coalesce(kind, F.col("event_type")).alias("event_type"), F.col("time").alias("event_time"), "partition_timestamp",
        (F.col("user_id") % 5).alias("event_source_id"), F.lit("x").alias("extra_segment1"),
        F.concat_ws(",", "lineitem_id", F.col("lineitem_id") + 7).alias("product_codes"),
        F.col("sales").alias("event_revenue"), F.lit("krw").alias("event_currency"))


def mapping(t):
    """Each of the five sources feeds the brands that share its region."""
    return t.nation.select(F.col("n_regionkey").cast("bigint").alias("event_source_id"),
                           F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("product_feed_id"))


def catalogue(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("product_feed_id"),
                         F.col("p_partkey").cast("string").alias("code"), F.col("p_type").alias("category"),
                         money("p_retailprice").alias("price"), F.lit("krw").alias("currency"))


RAW = """raw AS (SELECT event_id, CASE WHEN sales > 1 THEN viewer_id ELSE '' END AS viewer_id, lineitem_id, unit_id,
 CASE event_type WHEN 'view' THEN 'view_detail' WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS event_type, time AS event_time,
 user_id % 5 AS event_source_id, lineitem_id || ',' || (lineitem_id + 7) AS product_codes, sales FROM actions),
mapping AS (SELECT CAST(n_regionkey AS BIGINT) AS event_source_id, 'Brand#' || n_nationkey AS feed FROM nation),
flat AS (SELECT * EXCLUDE (product_codes), unnest(string_split(product_codes, ',')) AS code FROM raw
 WHERE viewer_id <> '' AND event_type IN ('view_detail', 'add_to_cart', 'purchase')),
resolved AS (SELECT viewer_id, lineitem_id, unit_id, event_type, event_time, p_partkey AS product_id, p_brand AS product_feed_id, p_type AS category
 FROM flat JOIN mapping USING (event_source_id) JOIN part ON p_brand = feed AND CAST(p_partkey AS VARCHAR) = code)"""
add("B10_resolve_products", lambda t: labels.resolve_products(raw_events(t), mapping(t), catalogue(t)),
    f"WITH {ACTIONS}, {RAW} SELECT * FROM resolved")
add("B10_resolve_all_products", lambda t: labels.resolve_products(raw_events(t), mapping(t), catalogue(t), "left"),
    f"""WITH {ACTIONS}, {RAW} SELECT viewer_id, lineitem_id, unit_id, event_type, event_time, event_source_id, code AS product_code,
 CAST(sales / 2 AS DOUBLE) AS event_average_revenue, 'KRW' AS event_currency, p_partkey AS product_id, p_brand AS product_feed_id,
 p_type AS category, CAST(p_retailprice AS DOUBLE) AS product_price, CASE WHEN p_partkey IS NOT NULL THEN 'KRW' END AS product_currency
FROM flat JOIN mapping USING (event_source_id) LEFT JOIN part ON p_brand = feed AND CAST(p_partkey AS VARCHAR) = code""")


def resolved(t):
    """Detail views, cart additions and purchases with the part as the product."""
    kind = F.create_map(*[F.lit(x) for p in KIND.items() for x in p])[F.col("event_type")]
    rows = t.actions.filter(F.col("event_type").isin(*KIND)).withColumns({"event_type": kind, "product_id": F.col("lineitem_id")})
    return rows.join(t.part, F.col("p_partkey") == F.col("lineitem_id")).select(
        "event_id", "viewer_id", "user_id", "lineitem_id", "unit_id", "event_type", F.col("time").alias("event_time"), "partition_timestamp",
        "product_id", F.col("p_size").alias("product_feed_id"), F.col("p_type").alias("category"), (F.col("user_id") % 5).alias("event_source_id"))


EV = """ev AS (SELECT event_id, viewer_id, user_id, lineitem_id, unit_id, CASE event_type WHEN 'view' THEN 'view_detail' WHEN 'signup' THEN 'add_to_cart'
 ELSE event_type END AS event_type, time AS event_time, partition_timestamp, lineitem_id AS product_id, p_size AS product_feed_id, p_type AS category,
 user_id % 5 AS event_source_id FROM actions JOIN part ON p_partkey = lineitem_id WHERE event_type IN ('view', 'signup', 'purchase'))"""


def funnel_sql(effect: str, hours: int, delayed: bool) -> str:
    low, high = f"TIMESTAMP '2024-01-02' - INTERVAL {hours} HOUR", f"TIMESTAMP '2024-01-31' - INTERVAL {hours} HOUR"
    hit = "event_time >= TIMESTAMP '2024-01-02'" if delayed else f"event_time < {high}"
    at = f"c.event_time + INTERVAL {hours} HOUR" if delayed else "c.event_time"
    return f"""WITH {ACTIONS}, {EV}, w AS (SELECT * FROM ev WHERE event_time >= {low} AND event_time < TIMESTAMP '2024-01-31'),
e AS (SELECT * FROM w WHERE event_type = '{effect}'),
c AS (SELECT viewer_id, product_id, min(lineitem_id) AS lineitem_id, min(unit_id) AS unit_id, min(product_feed_id) AS product_feed_id, max(event_time) AS event_time
 FROM w WHERE event_type = 'view_detail' AND event_time < {high} GROUP BY 1, 2),
u AS (SELECT viewer_id, lineitem_id, unit_id, product_id, product_feed_id, TRUE AS is_occurred, event_time AS occurred_at FROM e WHERE {hit}
 UNION SELECT c.viewer_id, c.lineitem_id, c.unit_id, c.product_id, c.product_feed_id, FALSE, {at} FROM c LEFT JOIN e
 ON e.viewer_id = c.viewer_id AND e.product_id = c.product_id WHERE e.viewer_id IS NULL)
SELECT *, CAST(NULL AS VARCHAR) AS allocation_id, CAST(NULL AS VARCHAR) AS reward_condition, '{effect}_from_view_detail' AS user_action FROM u"""


for _effect, _hours, _delayed in (("add_to_cart", 1, False), ("purchase", 24, False), ("purchase", 24, True)):
    add(f"B09_{_effect}_labels" + ("_delayed" if _delayed else ""),
        lambda t, e=_effect, h=_hours, d=_delayed: labels.funnel_labels(
            resolved(t), "view_detail", e, (h, "hour"), "2024-01-02 00:00:00", END, d),
        funnel_sql(_effect, _hours, _delayed))


def history_rows(t):
    """One label per event; views did not occur."""
    return resolved(t).select(
        "viewer_id", F.when(F.col("event_type") == "view_detail", F.concat_ws("-", "user_id", "unit_id")).alias("allocation_id"), "lineitem_id", "unit_id",
        "product_id", "product_feed_id", F.concat("event_type", F.lit("_from_view_detail")).alias("user_action"),
        (F.col("event_type") != "view_detail").alias("is_occurred"), F.lit(None).cast("string").alias("reward_condition"),
        F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("occurred_at"), "category")


HISTORY = f"""{ACTIONS}, {EV}, h AS (SELECT viewer_id, lineitem_id, unit_id, product_id, product_feed_id, event_type, category,
 date_trunc('hour', event_time) AS occurred_at, user_id, event_id FROM ev WHERE date_trunc('hour', event_time) > TIMESTAMP '2024-01-31' - INTERVAL 28 DAY
 AND date_trunc('hour', event_time) <= TIMESTAMP '2024-01-31'),
rec AS (SELECT viewer_id, occurred_at, CASE WHEN event_type = 'view_detail' THEN user_id || '-' || unit_id ELSE '' END || ',' || lineitem_id || ',' || unit_id
 || ',' || product_id || ',' || product_feed_id || ',' || event_type || '_from_view_detail,' || CASE WHEN event_type <> 'view_detail' THEN 'true' ELSE 'false' END
 || ',,' || strftime(occurred_at, '%Y-%m-%d %H:%M:%S.%g') AS history FROM h QUALIFY rank() OVER (PARTITION BY viewer_id ORDER BY occurred_at DESC) <= {{n}}),
agg AS (SELECT viewer_id, row_number() OVER (PARTITION BY viewer_id ORDER BY occurred_at DESC, history) AS position, history,
 count(*) OVER (PARTITION BY viewer_id) AS count FROM rec)"""
add("B11_user_histories", lambda t: labels.user_histories(history_rows(t), END, n=20),
    f"WITH {HISTORY.format(n=20)} SELECT * FROM agg")


def _inference(t):
    crc = t.customer.select(F.concat(F.lit("ifa:"), F.col("c_custkey").cast("string")).alias("viewer_id"), (F.col("c_custkey") % 100).cast("int").alias("crc"))
    categories = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
    return labels.user_histories(history_rows(t).drop("category"), END, crc=crc, categories=categories)


add("B11_user_histories_inference", _inference,
    f"""WITH {HISTORY.format(n=200)}, cats AS (SELECT viewer_id, category, count(*) AS n FROM h WHERE event_type <> 'view_detail' GROUP BY 1, 2),
top AS (SELECT viewer_id, category FROM cats QUALIFY rank() OVER (PARTITION BY viewer_id ORDER BY n DESC) = 1)
SELECT agg.*, CAST(c_custkey % 100 AS INTEGER) AS crc, category FROM agg JOIN customer ON 'ifa:' || c_custkey = agg.viewer_id LEFT JOIN top ON top.viewer_id = agg.viewer_id""")

ACTS = ["view_detail", "add_to_cart", "purchase"]


def _last(prefix: str, extra: str) -> str:
    return ", ".join(f"max(event_time) FILTER (event_type = '{a}'{extra}) AS {prefix}last_{a}" for a in ACTS)


add("B12_recency_profile", lambda t: labels.recency_profile(resolved(t), END, ACTS, source=3),
    f"""WITH {ACTIONS}, {EV}, p AS (SELECT viewer_id, count(*) AS total_count, count(*) FILTER (event_source_id = 3) AS source_count,
{_last('', '')}, {_last('source_', ' AND event_source_id = 3')} FROM ev WHERE event_time > TIMESTAMP '2024-01-03' AND event_time <= TIMESTAMP '2024-01-31' GROUP BY 1
HAVING count(*) FILTER (event_source_id = 3) > 0)
SELECT *, """ + ", ".join(f"date_sub('hour', {p}last_{a}, TIMESTAMP '2024-01-31') AS elapsed_hour_{p}last_{a}" for p in ("", "source_") for a in ACTS)
    + " FROM p")


def _inactive(t):
    users = t.customer.select(F.concat(F.lit("ifa:"), F.col("c_custkey").cast("string")).alias("viewer_id"), F.col("c_mktsegment").alias("model"))
    return labels.inactive_days(users, resolved(t), "2024-01-30 00:00:00", "2024-01-30 01:00:00", ACTS)


add("B13_inactive_days", _inactive,
    f"""WITH {ACTIONS}, {EV}, l AS (SELECT viewer_id, {", ".join(f"max(partition_timestamp) FILTER (event_type = '{a}') AS {a}" for a in ACTS)} FROM ev
WHERE partition_timestamp >= TIMESTAMP '2024-01-30' - INTERVAL 28 DAY AND partition_timestamp < TIMESTAMP '2024-01-30 01:00:00' GROUP BY 1)
SELECT 'ifa:' || c_custkey AS viewer_id, c_mktsegment AS model, """
    + ", ".join(f"coalesce(date_sub('day', {a}, TIMESTAMP '2024-01-30'), 28) AS inactive_{a}_day" for a in ACTS)
    + " FROM customer LEFT JOIN l ON l.viewer_id = 'ifa:' || c_custkey")


def _baskets(t):
    """Orders as users, parts as products: every line is a purchase."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("viewer_id"), F.col("l_partkey").alias("product_id"), F.lit(5).alias("product_feed_id"),
                              F.lit(True).alias("is_occurred"), F.lit("purchase_from_view_detail").alias("user_action"), F.col("l_shipdate").alias("occurred_at"))
    return labels.baskets(lines, "2001-12-01 00:00:00", days=10000, feed=5)


add("B14_baskets", _baskets,
    """WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), c AS (SELECT l_partkey, count(*) AS cnt FROM b GROUP BY 1),
acc AS (SELECT l_partkey, sum(cnt) OVER (ORDER BY cnt DESC, l_partkey ROWS UNBOUNDED PRECEDING) AS acc FROM c),
kept AS (SELECT l_partkey FROM acc WHERE acc < (SELECT sum(cnt) FROM c))
SELECT l_orderkey AS viewer_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS position, l_partkey AS product_id,
 count(*) OVER (PARTITION BY l_orderkey) AS product_count FROM b WHERE l_partkey IN (SELECT l_partkey FROM kept)""")

# Popularity: each line sells a part; brand and type are feed and category.
SOLD = """sold AS (SELECT l_partkey AS product_id, p_brand AS feed, p_type AS category, count(*) AS cnt FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_shipdate >= TIMESTAMP '2001-12-01' - INTERVAL 10000 DAY GROUP BY 1, 2, 3)"""


def sold(t):
    return t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_partkey").alias("product_id"), F.col("p_brand").alias("feed"), F.col("p_type").alias("category"),
        F.col("l_shipdate").alias("event_time"), F.lit("purchase").alias("event_type"))


LONG = {"end": "2001-12-01 00:00:00", "days": 10000}
BEST = "string_agg(CAST(product_id AS VARCHAR), '|' ORDER BY cnt DESC, product_id) AS product_ids, count(*) AS product_count"
add("B15_top_per_feed", lambda t: popularity.popular(sold(t), ["feed"], 100, **LONG),
    f"WITH {SOLD}, s AS (SELECT feed, product_id, sum(cnt) AS cnt FROM sold GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY feed ORDER BY sum(cnt) DESC, product_id) <= 100) "
    f"SELECT feed, {BEST} FROM s GROUP BY 1")
add("B15_top_per_category", lambda t: popularity.popular(sold(t), ["feed", "category"], 100, **LONG),
    f"WITH {SOLD}, s AS (SELECT * FROM sold QUALIFY row_number() OVER (PARTITION BY feed, category ORDER BY cnt DESC, product_id) <= 100) "
    f"SELECT feed, category, {BEST} FROM s GROUP BY 1, 2")
add("B15_purchase_rank", lambda t: popularity.popular(sold(t), ["feed"], mode="rank", **LONG),
    f"WITH {SOLD} SELECT feed, product_id, rank() OVER (PARTITION BY feed ORDER BY cnt DESC) AS rank FROM sold")
add("B15_random_sample", lambda t: popularity.popular(t.items, ["feed"], 25, mode="sample", seed=11),
    f"WITH {ITEMS}, d AS (SELECT feed, id FROM items QUALIFY row_number() OVER (PARTITION BY feed ORDER BY md5(id || ':11'), id) <= 25) "
    "SELECT feed, string_agg(CAST(id AS VARCHAR), '|' ORDER BY id) AS product_ids, count(*) AS product_count FROM d GROUP BY 1")


add("B16_recent_products", lambda t: popularity.recent_products(
    resolved(t), {"view_detail": "view_detail", "cart": "add_to_cart", "purchase": "purchase"}, END),
    f"""WITH {ACTIONS}, {EV}, c AS (SELECT viewer_id, product_feed_id, CASE event_type WHEN 'add_to_cart' THEN 'cart' ELSE event_type END AS action, product_id, count(*) AS times
FROM ev WHERE event_time >= TIMESTAMP '2024-01-17' AND event_time < TIMESTAMP '2024-01-31' AND event_type IN ('view_detail', 'add_to_cart', 'purchase') GROUP BY 1, 2, 3, 4)
SELECT *, row_number() OVER (PARTITION BY viewer_id, product_feed_id, action ORDER BY product_id) AS position,
 CAST(sum(times) OVER (PARTITION BY viewer_id, product_feed_id, action) AS BIGINT) AS action_count FROM c""")
add("B17_user_top_category", lambda t: popularity.user_top_category(resolved(t), END, ["purchase", "add_to_cart"]),
    f"""WITH {ACTIONS}, {EV}, c AS (SELECT viewer_id, product_feed_id, category, count(*) AS cnt FROM ev WHERE event_type IN ('purchase', 'add_to_cart')
AND event_time >= TIMESTAMP '2024-01-03' AND event_time < TIMESTAMP '2024-01-31' GROUP BY 1, 2, 3)
SELECT viewer_id, product_feed_id, category FROM c QUALIFY row_number() OVER (PARTITION BY viewer_id, product_feed_id ORDER BY cnt DESC, category) = 1""")
