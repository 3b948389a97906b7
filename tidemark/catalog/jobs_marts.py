"""Statistics marts, segments, logs and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, UNITS, add
from tidemark.catalog.expressions import CARDS, cards
from tidemark.catalog.jobs_money import creative_stats
from tidemark.catalog.joins import identity
from tidemark.catalog.writers import SERVICE_SQL, service_logs
from tidemark.plans import marts, segments

# Ad requests: orders, with the number of their lines of each kind as fills.
KINDS = {"direct_normal": "A", "adnetwork": "N", "sdk": "R"}


def requests(t):
    fills = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("filled_request"),
                                                 *[F.count_if(F.col("l_returnflag") == f).alias(k) for k, f in KINDS.items()])
    rows = t.orders.join(fills, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    own = F.when(F.col("o_orderstatus") == "P", 4)
    return rows.select((F.col("o_custkey") % 10).alias("unit_id"), own.cast("bigint").alias("target_fill"), "filled_request", *KINDS,
                       F.col("o_orderdate").alias("partition_timestamp"))


def fill_units(t):
    return t.units.select(F.col("unit_id").alias("id"), F.col("unit_name").alias("name"), "unit_type", (F.col("organization_id") + 2).cast("bigint").alias("target_fill"))


def _fill(t):
    return marts.fill_stats(requests(t), fill_units(t), list(KINDS))


MEASURES = ["request_count", "underfilled_request_count", "overfilled_request_count", "sufficiently_filled_request_count", "on_point_filled_request_count",
            "filled_request_count", "request_volume", "fill_volume", "overfill_volume", "underfill_volume", *[f"{k}_fill_volume" for k in KINDS]]
FILL = f"""f AS (SELECT l_orderkey, count(*) AS fr, {", ".join(f"count(*) FILTER (l_returnflag = '{f}') AS {k}" for k, f in KINDS.items())} FROM lineitem GROUP BY 1),
q AS (SELECT o_custkey % 10 AS unit_id, coalesce(CASE WHEN o_orderstatus = 'P' THEN 4 END, organization_id + 2) AS tf, unit_name, unit_type, f.*, o_orderdate
 FROM orders LEFT JOIN f ON l_orderkey = o_orderkey JOIN units ON unit_id = o_custkey % 10),
stats AS (SELECT date_trunc('hour', o_orderdate) AS data_at, unit_type, unit_id, unit_name, CAST(tf AS BIGINT) AS target_fill, count(fr) AS request_count, count(*) FILTER (tf > fr) AS underfilled_request_count,
 count(*) FILTER (tf < fr) AS overfilled_request_count, count(*) FILTER (tf <= fr) AS sufficiently_filled_request_count, count(*) FILTER (tf = fr) AS on_point_filled_request_count,
 count(*) FILTER (fr > 0) AS filled_request_count, CAST(sum(tf) AS BIGINT) AS request_volume, CAST(sum(fr) AS BIGINT) AS fill_volume,
 CAST(sum(CASE WHEN tf < fr THEN fr - tf ELSE 0 END) AS BIGINT) AS overfill_volume, CAST(sum(CASE WHEN tf > fr THEN tf - fr ELSE 0 END) AS BIGINT) AS underfill_volume,
 {", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}_fill_volume" for k in KINDS)} FROM q GROUP BY 1, 2, 3, 4, 5)"""
add("B06_fill_stats", _fill, f"WITH {UNITS}, {FILL} SELECT * FROM stats")
add("B06_fill_daily", lambda t: marts.roll_up(_fill(t), ["unit_type", "unit_id", "unit_name"]),
    f"WITH {UNITS}, {FILL} SELECT CAST(date_trunc('day', data_at + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_at, unit_type, unit_id, unit_name, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in MEASURES) + " FROM stats GROUP BY 1, 2, 3, 4")
add("B06_fill_counts", lambda t: marts.fill_counts(
    t.actions.withColumn("filled", F.col("event_type") != "error"), ["unit_id", "lineitem_id"], "time"),
    f"WITH {ACTIONS} SELECT date_trunc('hour', time) AS data_at, unit_id, lineitem_id, count(*) AS fill_count FROM actions WHERE event_type <> 'error' GROUP BY 1, 2, 3")

SRC = {"impression": "view", "click": "click", "conversion": "purchase"}


def _segments(t):
    """Order priorities of a customer are the segments of its profile."""
    member = t.orders.select((F.col("o_custkey") + 5000).alias("profile_id"), F.col("o_orderpriority").alias("segment_id"))
    return segments.segment_performance(t.logs("view"), t.logs("click"), t.logs("purchase"), identity(t), member, "2024-01-01 00:00:00")


add("B18_segment_performance", _segments,
    f"""WITH {ACTIONS}, mem AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders),
j AS (SELECT lineitem_id, o_orderpriority AS segment_id, event_type, viewer_id, sales FROM actions LEFT JOIN customer ON 'ifa:' || c_custkey = viewer_id AND c_acctbal > 0
 LEFT JOIN mem ON o_custkey = c_custkey WHERE event_type IN ('view', 'click', 'purchase'))
SELECT TIMESTAMP '2024-01-01' AS data_at, lineitem_id, segment_id, CAST(sum(sales) AS DOUBLE) AS revenue,
{", ".join(f"count(*) FILTER (event_type = '{k}') AS {n}_count, count(DISTINCT viewer_id) FILTER (event_type = '{k}') AS {n}_user_count" for n, k in SRC.items())}
FROM j GROUP BY 2, 3""")


def _unify(t):
    app = F.when(F.col("unit_id") < 5, F.concat(F.col("unit_id").cast("string"), F.lit(":AppUserID")))
    source = {"time": "time", "payload": {"viewer_id": "viewer_id", "lineitem_id": "lineitem_id"}, "identities": {"IFA": "ifa", "APP": app}}
    out = segments.unify_events([{"df": t.logs(k), "event_type": n} | source for n, k in (("click", "click"), ("conversion", "purchase"))], 42)
    return out.select("data_source_id", "event_type", "event_timestamp", F.to_json("payload").alias("payload"), "uid_key", "uid_value")


add("B19_unify_events", _unify,
    f"""WITH {ACTIONS}, s AS (SELECT 42 AS data_source_id, CASE event_type WHEN 'click' THEN 'click' ELSE 'conversion' END AS event_type, time AS event_timestamp,
 '{{"viewer_id":"' || viewer_id || '","lineitem_id":"' || lineitem_id || '"}}' AS payload, ifa, unit_id FROM actions WHERE event_type IN ('click', 'purchase'))
SELECT data_source_id, event_type, event_timestamp, payload, 'IFA' AS uid_key, ifa AS uid_value FROM s
UNION ALL SELECT data_source_id, event_type, event_timestamp, payload, 'APP', unit_id || ':AppUserID' FROM s WHERE unit_id < 5""")


def _mart(t):
    dims = [(t.units, "unit_id", "unit_id", {"unit_name": "unit_name", "unit_type": "unit_type", "org_id": "organization_id"}),
            (t.items, "id", "lineitem_id", {"lineitem_name": "item_name", "category": "category", "ad_group_id": "ad_group_id"}),
            (t.supplier, "s_suppkey", "ad_group_id", {"owner_name": "s_name"})]
    required = [(t.region, "r_regionkey", "org_id", {"organization_name": "r_name"})]
    flag = marts.test_unit(F.col("unit_name"), F.col("unit_id"), 3, F.col("org_id") == 4, [1])
    return marts.ad_metric_mart(creative_stats(t), dims, required, flag, ["unit_id", "lineitem_id"], ["impression_count", "click_count", "sales_total"])


STATS = """stats AS (SELECT partition_timestamp AS data_at, unit_id, lineitem_id, count(*) FILTER (event_type = 'view') AS impression_count,
 count(*) FILTER (event_type = 'click') AS click_count, sum(CASE WHEN event_type <> 'error' THEN sales ELSE 0 END) AS sales_total FROM actions GROUP BY 1, 2, 3)"""
add("B30_ad_metric_mart", _mart,
    f"""WITH {ACTIONS}, {UNITS}, {STATS}, d AS (SELECT CAST(date_trunc('day', data_at + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_at, unit_id, lineitem_id,
 CAST(sum(impression_count) AS BIGINT) AS impression_count, CAST(sum(click_count) AS BIGINT) AS click_count, CAST(sum(sales_total) AS DOUBLE) AS sales_total FROM stats GROUP BY 1, 2, 3)
SELECT d.*, unit_name, unit_type, organization_id AS org_id, p_name AS lineitem_name, p_type AS category, p_size AS ad_group_id, s_name AS owner_name, r_name AS organization_name,
CASE WHEN unit_id IN (1) THEN FALSE WHEN upper(unit_name) LIKE '%TEST%' OR upper(unit_name) LIKE '%QA%' OR upper(unit_name) LIKE '%DEV%' OR upper(unit_name) LIKE '%STG%'
 OR unit_id < 3 OR organization_id = 4 THEN TRUE ELSE FALSE END AS is_test
FROM d LEFT JOIN units USING (unit_id) LEFT JOIN part ON p_partkey = lineitem_id LEFT JOIN supplier ON s_suppkey = p_size JOIN region ON r_regionkey = organization_id""")
add("B33_card_sessions", lambda t: marts.card_sessions(cards(t).withColumn("name", F.lit("rolling_session")), "rolling_session").select(
    "event_id", "report_ratio", "session_id", "duration", "watched_count", "skipped_count", "last_watched_card", F.array_join("watched_cards", ",").alias("cards")),
    f"""WITH {CARDS} SELECT event_id, CAST(NULL AS VARCHAR) AS report_ratio, CAST(event_id AS VARCHAR) AS session_id, '0' AS duration, 2 AS watched_count,
CAST(top - 2 + 1 AS INTEGER) AS skipped_count, CAST(top + 1 AS INTEGER) AS last_watched_card, '0,' || top AS cards FROM cards WHERE top IS NOT NULL""")
add("B33_feed_sessions", lambda t: marts.feed_sessions(cards(t).withColumn("name", F.col("event_type")), "view").select(
    "event_id", "report_ratio", "session_id", "duration"),
    f"""WITH {CARDS} SELECT event_id, CAST(NULL AS VARCHAR) AS report_ratio, CAST(event_id AS VARCHAR) AS session_id, '0' AS duration FROM cards WHERE event_type = 'view'""")


def _latency(t):
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = t.events.select("event_id", F.when(F.col("event_type") == "error", 0).otherwise(start).alias("request"),
                           (start + F.col("user_id")).alias("response"), F.when(F.col("event_type") == "view", 0).otherwise(start + 2500).alias("render"))
    return marts.latency_offsets(rows, "request", ["response", "render"])


add("B34_latency_offsets", _latency,
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) END AS requested_at, CASE WHEN event_type <> 'error' THEN user_id END AS response,
CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(2500 AS BIGINT) END AS render FROM events""")


def _apps(t):
    packages = F.replace("p_name", F.lit(" "), F.lit(","))
    rows = t.part.select(F.concat(F.lit("ifa:"), F.col("p_partkey").cast("string")).alias("device_id"), packages.alias("package_names"),
                         F.lit("2024-01-01").cast("timestamp_ntz").alias("partition_timestamp"))
    return marts.installed_apps(rows.unionByName(rows))


add("B35_installed_apps", _apps,
    "SELECT 'ifa:' || p_partkey AS device_id, CAST(p_partkey AS VARCHAR) AS ifa, TIMESTAMP '2024-01-01' AS updated_at, unnest(string_split(p_name, ' ')) AS package_name FROM part")


def _export(t):
    rows = t.actions.select("unit_id", "lineitem_id", F.col("lineitem_id").alias("content_id"), "ifa", F.lit("KR").alias("country"), F.lit(1990).alias("year_of_birth"),
                            F.lit("F").alias("sex"), F.col("time").alias("created_at"), "event_type")
    log = {k: rows.filter(F.col("event_type") == k) for k in ("view", "click", "signup", "purchase")}
    campaigns = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("provider_id"), F.col("p_partkey").alias("channel_id"), F.col("p_name").alias("click_url"))
    return marts.export_activity([("impression", log["view"]), ("click", log["click"])], [("impression", log["signup"]), ("click", log["purchase"])],
                                 t.units.filter("organization_id <> 2"), campaigns)


add("B36_export_activity", _export,
    f"""WITH {ACTIONS}, {UNITS}, a AS (SELECT * FROM actions WHERE unit_id IN (SELECT unit_id FROM units WHERE organization_id <> 2))
SELECT lineitem_id, CAST(NULL AS BIGINT) AS content_id, CAST(NULL AS BIGINT) AS content_provider_id, CAST(NULL AS BIGINT) AS content_channel_id, CAST(NULL AS VARCHAR) AS content_url,
CASE event_type WHEN 'view' THEN 'impression' ELSE 'click' END AS event, ifa AS idfa, 'KR' AS country, 1990 AS year_of_birth, 'F' AS gender, time AS created_at FROM a WHERE event_type IN ('view', 'click')
UNION ALL SELECT NULL, lineitem_id, CAST(p_size AS BIGINT), p_partkey, p_name, CASE event_type WHEN 'signup' THEN 'impression' ELSE 'click' END, ifa, 'KR', 1990, 'F', time
FROM a JOIN part ON p_partkey = lineitem_id WHERE event_type IN ('signup', 'purchase')""")
add("B37_shred_service_logs", lambda t: marts.shred_service_logs(service_logs(t)), SERVICE_SQL.format(more=", CAST(date_trunc('day', ts) AS TIMESTAMP) + CASE WHEN hour(ts) < 12 THEN INTERVAL 0 HOUR ELSE INTERVAL 12 HOUR END AS log_timestamp"))


def _unit_lineitem(t):
    units = t.units.select(F.col("unit_id").alias("id"), F.col("unit_name").alias("name"), F.col("unit_type").alias("currency"))
    items = t.items.select("id", "item_name", F.col("category").alias("revenue_type"), F.col("ad_group_id").cast("bigint").alias("owner_id"))
    users = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return marts.unit_lineitem_stats(creative_stats(t), units, items, users, ["impression_count", "click_count", "sales_total"])


add("B38_unit_lineitem_stats", _unit_lineitem,
    f"""WITH {ACTIONS}, {UNITS}, {STATS} SELECT lineitem_id, unit_id, data_at, impression_count, click_count, CAST(sales_total AS DOUBLE) AS sales_total, unit_name, unit_type AS unit_currency,
p_name AS lineitem_name, p_type AS revenue_type, CAST(p_size AS BIGINT) AS lineitem_owner_id, s_name AS lineitem_owner_name
FROM stats LEFT JOIN units USING (unit_id) LEFT JOIN part ON p_partkey = lineitem_id LEFT JOIN supplier ON s_suppkey = p_size""")


def _network(t):
    """Customers report by nation; supplier configs name a nation, a few apply everywhere."""
    reports = t.customer.select(F.col("c_custkey").alias("report_id"), (F.col("c_custkey") % 5).alias("adnetwork_id"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("app_id"),
                                F.lit(None).cast("string").alias("placement_id"), F.col("c_nationkey").cast("string").alias("country"))
    segment = F.element_at(F.array(*[F.lit(s) for s in ("", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    rows = t.supplier.select((F.col("s_suppkey") % 5).alias("adnetwork_id"), segment.alias("app_id"), F.when(F.col("s_acctbal") > 0, "").alias("placement_id"),
                          F.when(F.col("s_nationkey") < 8, "ZZ").otherwise(F.col("s_nationkey").cast("string")).alias("country"),
                          F.concat_ws(",", "s_suppkey", "s_nationkey").alias("target_unit"), F.col("s_suppkey").alias("lineitem_id"))
    return marts.map_network_reports(reports, rows).drop("placement_id")


add("B40_network_reports", _network,
    """WITH r AS (SELECT c_custkey AS report_id, c_custkey % 5 AS adnetwork_id, nullif(c_mktsegment, 'BUILDING') AS app_id, CAST(NULL AS VARCHAR) AS placement_id,
 CAST(c_nationkey AS VARCHAR) AS country FROM customer),
c AS (SELECT s_suppkey % 5 AS adnetwork_id, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'MACHINERY' WHEN 2 THEN 'HOUSEHOLD' ELSE 'AUTOMOBILE' END AS app_id,
 CASE WHEN s_acctbal > 0 THEN '' END AS placement_id, CASE WHEN s_nationkey < 8 THEN 'ZZ' ELSE CAST(s_nationkey AS VARCHAR) END AS country, s_suppkey AS unit_id, s_suppkey AS lineitem_id FROM supplier),
cc AS (SELECT * FROM c WHERE NOT (app_id = '' AND placement_id = '')),
j AS (SELECT r.report_id, r.adnetwork_id, r.app_id, r.country, cc.country AS dim_country, unit_id, lineitem_id FROM r JOIN cc ON r.adnetwork_id = cc.adnetwork_id
 AND coalesce(r.app_id, '') = coalesce(cc.app_id, '') AND coalesce(r.placement_id, '') = coalesce(cc.placement_id, ''))
SELECT * FROM j WHERE country = dim_country UNION SELECT * FROM j WHERE dim_country = 'ZZ' AND report_id NOT IN (SELECT report_id FROM j WHERE country = dim_country)""")
add("X01_video_event_counts", lambda t: marts.video_event_counts(t.actions, ["event_type", "unit_id"], "time"),
    f"WITH {ACTIONS} SELECT date_trunc('hour', time) AS data_at, event_type, unit_id, count(*) AS event_count FROM actions GROUP BY 1, 2, 3")
