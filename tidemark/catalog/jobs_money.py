"""Rewards, budgets, payouts and settlement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, UNITS, add
from tidemark.catalog.expressions import ACCOUNT_SQL, account_type
from tidemark.catalog.joins import FIRST_CLICKS, first_clicks, with_click_id
from tidemark.functions.numbers import money
from tidemark.functions.times import trunc_ts, ts
from tidemark.plans import money as m

# Points: every line is a reward; lines with flag R belong to line items (ids above the offset).
POINTS = """points AS (SELECT date_trunc('hour', l_shipdate) AS created_at, l_suppkey % 10 AS unit_id, CAST(l_quantity AS BIGINT) AS amount,
 CAST(l_linenumber * 5 AS BIGINT) AS base_reward, CASE WHEN l_returnflag = 'R' THEN l_partkey + 1000000001 ELSE l_partkey END AS campaign_id,
 CASE WHEN l_linestatus = 'F' THEN 'imp' ELSE 'scratch' END AS point_type FROM lineitem),
li AS (SELECT p_partkey + 1 AS id, p_name AS name, p_size AS organization_id FROM part),
ca AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS organization_id FROM supplier)"""
OWNED = "LEFT JOIN ca ON campaign_id <= 1000000000 AND ca.id = campaign_id LEFT JOIN li ON campaign_id > 1000000000 AND li.id = campaign_id - 1000000000"


def points(t):
    return t.lineitem.select(
        F.col("l_shipdate").alias("created_at"), (F.col("l_suppkey") % 10).alias("unit_id"), F.col("l_quantity").cast("bigint").alias("amount"),
        (F.col("l_linenumber") * 5).cast("bigint").alias("base_reward"),
        F.when(F.col("l_returnflag") == "R", F.col("l_partkey") + 1000000001).otherwise(F.col("l_partkey")).alias("campaign_id"),
        F.when(F.col("l_linestatus") == "F", "imp").otherwise("scratch").alias("point_type"))


def point_items(t):
    return t.part.select((F.col("p_partkey") + 1).alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("organization_id"))


def campaigns(t):
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("organization_id"))


def unit_owners(t):
    return t.units.select(F.col("unit_id").alias("id"), "organization_id")


add("B20_reward_stats", lambda t: m.reward_stats(points(t), point_items(t), campaigns(t)),
    f"""WITH {POINTS} SELECT created_at AS data_at, unit_id, campaign_id, coalesce(ca.organization_id, li.organization_id, 1) AS campaign_organization_id,
coalesce(ca.name, li.name, '') AS campaign_name, count(*) AS reward_count, CAST(sum(amount) AS BIGINT) AS reward_sum, CAST(sum(base_reward) AS BIGINT) AS base_reward_sum
FROM points {OWNED} GROUP BY 1, 2, 3, 4, 5""")
add("B20_unit_points", lambda t: m.unit_point_stats(points(t), point_items(t), campaigns(t), unit_owners(t)),
    f"""WITH {POINTS}, {UNITS}, u AS (SELECT created_at AS data_at, unit_id, point_type, coalesce(ca.organization_id, li.organization_id, 1) AS campaign_organization_id,
 count(*) AS reward_count, CAST(sum(amount - base_reward) AS BIGINT) AS reward FROM points {OWNED} WHERE amount > base_reward GROUP BY 1, 2, 3, 4
 UNION ALL SELECT created_at, unit_id, 'base', 1, count(*), CAST(sum(base_reward) AS BIGINT) FROM points GROUP BY 1, 2)
SELECT u.*, organization_id AS unit_organization_id FROM u LEFT JOIN units USING (unit_id)""")


def _ad_rewards(t):
    rows = t.lineitem.select(F.col("l_shipdate").alias("created_at"), (F.col("l_suppkey") % 10).alias("unit_id"), F.col("l_partkey").alias("resource_id"),
                             (-F.col("l_quantity")).cast("bigint").alias("amount"), F.when(F.col("l_returnflag") == "N", "succeeded").otherwise("failed").alias("redeem_status"),
                             F.when(F.col("l_linestatus") == "O", "ad").otherwise("article").alias("resource_type"))
    items = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("country"), F.col("p_type").alias("item_type"),
                          F.lit("cpc").alias("revenue_type"), F.col("p_size").alias("organization_id"))
    return m.ad_reward_stats(rows, unit_owners(t), items)


add("B20_ad_rewards", _ad_rewards,
    f"""WITH {UNITS} SELECT date_trunc('hour', l_shipdate) AS data_at, l_suppkey % 10 AS unit_id, p_brand AS country, p_type AS lineitem_type, 'cpc' AS revenue_type,
p_size AS lineitem_organization_id, organization_id AS unit_organization_id, count(*) AS reward_count, CAST(sum(l_quantity) AS BIGINT) AS reward
FROM lineitem JOIN units ON unit_id = l_suppkey % 10 JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity > 0
GROUP BY 1, 2, 3, 4, 5, 6, 7""")

# Budgets: customers are ad groups, their orders the spend.
PRICE = "CAST(o_totalprice AS DECIMAL(27,9))"
BUDGETS = """b AS (SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(27,9)) * 100 AS initial_budget, CAST(c_nationkey AS DECIMAL(27,9)) * 1000 AS carryover_budget,
 CAST(c_acctbal AS DECIMAL(27,9)) * 100 + CAST(c_nationkey AS DECIMAL(27,9)) * 1500 AS total_budget FROM customer)"""


def budgets(t):
    initial = money(money("c_acctbal") * 100)
    return t.customer.select(F.col("c_custkey").alias("id"), initial.alias("initial_budget"), money(F.col("c_nationkey") * 1000).alias("carryover_budget"),
                             money(initial + money(F.col("c_nationkey") * 1500)).alias("total_budget"))


def spend(t):
    return t.orders.select(F.col("o_custkey").alias("ad_group_id"), F.length("o_orderpriority").cast("bigint").alias("unit_id"),
                           F.col("o_orderdate").alias("created_at"), money("o_totalprice").alias("sales"), "o_orderkey")


add("B21_budget_consumption", lambda t: m.budget_consumption(spend(t), budgets(t), ["created_at", "o_orderkey"]),
    f"""WITH {BUDGETS}, c AS (SELECT o_custkey, CAST(date_trunc('day', o_orderdate + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_at,
 sum({PRICE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS cum FROM orders),
d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey, kst_at ORDER BY cum DESC) = 1),
e AS (SELECT kst_at, id, initial_budget, carryover_budget, total_budget, cum, greatest(cum - total_budget, 0) AS over FROM d JOIN b ON id = o_custkey)
SELECT kst_at, id AS ad_group_id, CAST(initial_budget AS DOUBLE) AS initial_budget, CAST(total_budget AS DOUBLE) AS total_budget, CAST(cum AS DOUBLE) AS cumulative_spent,
CAST(over AS DOUBLE) AS cumulative_overspent, CAST(least(cum - over, initial_budget + carryover_budget) AS DOUBLE) AS cumulative_revenue FROM e""")


def _overspend(t):
    """Everything before 1999 is the seed, the rest the new spend."""
    cut, rows = ts("1999-01-01 00:00:00"), spend(t)
    seed = rows.filter(F.col("created_at") < cut).groupBy("ad_group_id").agg(money(F.sum("sales")).alias("sales")).withColumns({
        "created_at": cut, "o_orderkey": F.lit(-1).cast("bigint")})
    return m.overspend_attribution(seed, rows.filter(F.col("created_at") >= cut), budgets(t), ["created_at", "o_orderkey"])


add("B22_overspend_attribution", _overspend,
    f"""WITH {BUDGETS}, s AS (SELECT o_custkey AS g, CAST(length(o_orderpriority) AS BIGINT) AS unit_id, o_orderdate AS stamp, {PRICE} AS sales, o_orderkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
 UNION ALL SELECT o_custkey, NULL, TIMESTAMP '1999-01-01', sum({PRICE}), -1 FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1),
c AS (SELECT s.*, total_budget, sum(sales) OVER (PARTITION BY g ORDER BY stamp, k ROWS UNBOUNDED PRECEDING) AS gc,
 sum(sales) OVER (PARTITION BY g, unit_id ORDER BY stamp, k ROWS UNBOUNDED PRECEDING) AS uc FROM s JOIN b ON id = g),
o AS (SELECT *, CASE WHEN total_budget - gc >= 0 THEN 0 WHEN gc - total_budget < sales THEN gc - total_budget ELSE sales END AS over FROM c),
r AS (SELECT *, sum(over) OVER (PARTITION BY g, unit_id ORDER BY stamp, k ROWS UNBOUNDED PRECEDING) AS oc,
 row_number() OVER (PARTITION BY g, unit_id ORDER BY stamp DESC, k DESC) AS n FROM o)
SELECT CAST(date_trunc('day', stamp + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_at, unit_id, g AS ad_group_id, CAST(total_budget AS DOUBLE) AS ad_group_total_budget,
CAST(uc AS DOUBLE) AS cumulative_spent, CAST(oc AS DOUBLE) AS cumulative_overspent FROM r WHERE n = 1""")


def _expiry(t):
    """Finished orders of the year 2000 are expiries of a tenth of their price times four; all orders are the ledger."""
    e = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= ts("2000-01-01 00:00:00"))).select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("version"), trunc_ts("o_orderdate", "day").alias("expire_date"),
        money(money("o_totalprice") * 4).alias("amount"))
    ledger = t.orders.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("created_at"),
                             F.when(F.col("o_orderstatus") != "P", money("o_totalprice")).otherwise(money(F.lit(0))).alias("collected"))
    return m.expire_points(e, ledger)


add("B23_point_expiry", _expiry,
    f"""WITH e AS (SELECT o_custkey AS p, o_orderkey AS v, date_trunc('day', o_orderdate) AS expire_date, {PRICE} * 4 AS total FROM orders
 WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01'),
mo AS (SELECT p, v, expire_date, total, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, sum(CASE WHEN o_orderstatus <> 'P' THEN {PRICE} ELSE 0 END) AS collected
 FROM e JOIN orders ON o_custkey = p AND o_orderkey < v GROUP BY 1, 2, 3, 4, 5),
c AS (SELECT *, sum(collected) OVER (PARTITION BY p, v ORDER BY month DESC ROWS UNBOUNDED PRECEDING) AS cum FROM mo),
w AS (SELECT *, greatest(CASE WHEN cum <= total THEN collected ELSE collected - (cum - total) END, 0) AS take FROM c)
SELECT p AS person_id, CAST(expire_date AS TIMESTAMP) AS expire_date, month AS collected_date, CAST(take AS DOUBLE) AS points_withdraw FROM w WHERE take > 0""")


def _click_conversions(t):
    clicks = first_clicks(t).withColumnRenamed("clicked_at", "created_at")
    convs = with_click_id(t.logs("purchase")).select("event_id", "click_id", "sales", F.col("time").alias("created_at"))
    return m.click_conversions(clicks, convs, "2024-01-02 00:00:00", "2024-02-01 00:00:00")


add("B24_click_conversions", _click_conversions,
    f"""WITH {FIRST_CLICKS} SELECT click_id, clicked_at AS created_at, event_id AS conv_event_id, click_id AS conv_click_id, CAST(sales AS DOUBLE) AS conv_sales, time AS conv_created_at
FROM purchases JOIN clicks USING (click_id) WHERE clicked_at >= TIMESTAMP '2024-01-02' - INTERVAL 2 MONTH AND clicked_at < TIMESTAMP '2024-01-31 23:30:00'
AND time >= TIMESTAMP '2024-01-01 23:30:00' AND time < TIMESTAMP '2024-01-31 23:30:00'""")


def creative_stats(t):
    """Hourly statistics per unit and line item from the event log."""
    kind = F.col("event_type")
    return t.actions.groupBy(F.col("partition_timestamp").alias("data_at"), "unit_id", "lineitem_id").agg(
        F.count_if(kind == "view").alias("impression_count"), F.count_if(kind == "click").alias("click_count"),
        F.sum(F.when(kind != "error", F.col("sales")).otherwise(0)).alias("sales_total"))


def _efficiency(t):
    events = with_click_id(t.actions.filter("event_type <> 'error'")).select(
        "click_id", "unit_id", "lineitem_id", F.col("time").alias("event_time"), "event_type", F.nullif("sales", F.lit(0)).alias("event_revenue"))
    clicks = first_clicks(t).withColumnRenamed("clicked_at", "created_at")
    items = t.items.select("id", "item_name", "ad_group_id")
    units = t.units.select(F.col("unit_id").alias("id"), F.col("unit_name").alias("name"))
    out = m.efficiency(creative_stats(t), events, clicks, items, units, "2024-01-01 00:00:00")
    return out.withColumns({"cost_per_event": F.round("cost_per_event", 4)})


add("B25_efficiency", _efficiency,
    f"""WITH {FIRST_CLICKS}, {UNITS}, s AS (SELECT CAST(date_trunc('day', partition_timestamp + INTERVAL 9 HOUR) AS TIMESTAMP) AS date_at, unit_id, lineitem_id,
 count(*) FILTER (event_type = 'view') AS imps, count(*) FILTER (event_type = 'click') AS clicks, sum(CASE WHEN event_type <> 'error' THEN sales ELSE 0 END) AS spent
 FROM actions GROUP BY 1, 2, 3),
e AS (SELECT CAST(date_trunc('day', time + INTERVAL 9 HOUR) AS TIMESTAMP) AS date_at, unit_id, lineitem_id, count(*) AS n, sum(sales) AS revenue
 FROM purchases JOIN clicks USING (click_id) WHERE time < clicked_at + INTERVAL 1 DAY GROUP BY 1, 2, 3)
SELECT date_at, unit_id, unit_name, lineitem_id, p_name AS lineitem_name, p_size AS ad_group_id, imps, s.clicks,
CASE WHEN imps = 0 THEN 0 ELSE round(s.clicks / imps * 100, 2) END AS ctr, CAST(spent AS DOUBLE) AS spent_budget, coalesce(n, 0) AS event_count,
CASE WHEN n > 0 THEN round(CAST(spent AS DOUBLE) / n, 4) ELSE 0 END AS cost_per_event, CASE WHEN s.clicks > 0 THEN coalesce(n, 0) // s.clicks ELSE 0 END AS event_over_clicks,
CAST(coalesce(revenue, 0) AS DOUBLE) AS purchase_revenue, CASE WHEN spent > 0 THEN round(100.0 * CAST(revenue AS DOUBLE) / CAST(spent AS DOUBLE), 2) ELSE 0 END AS roas
FROM s JOIN part ON p_partkey = lineitem_id JOIN units USING (unit_id) LEFT JOIN e USING (date_at, unit_id, lineitem_id)""")


def _extended(t):
    """Customers as ad groups, orders as extra budgets, orders by priority as line items, suppliers as users."""
    groups = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("sales_manager_id"),
                               (F.col("c_custkey") % 50).alias("owner_id"), money("c_acctbal").alias("budget"))
    kind = F.when(F.col("o_orderstatus") == "P", "C").when(F.col("o_orderstatus") == "F", "A").otherwise("O")
    extra = t.orders.select(F.col("o_custkey").alias("ad_group_id"), kind.alias("extra_budget_type"), money("o_totalprice").alias("budget"))
    items = t.orders.select(F.col("o_custkey").alias("ad_group_id"), F.col("o_orderpriority").alias("revenue_type"), F.col("o_orderstatus").alias("currency"))
    return m.extended_budgets(groups, extra, items, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


def _kind(name: str, status: str) -> str:
    return f"sum(CASE WHEN o_orderstatus = '{status}' THEN {PRICE} ELSE 0 END) AS {name}"


add("B26_extended_budgets", _extended,
    f"""WITH x AS (SELECT o_custkey, {_kind('c', 'P')}, {_kind('a', 'F')}, {_kind('o', 'O')},
 string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS revenue_types, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS currencies
 FROM orders GROUP BY 1)
SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS sales_manager_id, sm.s_name AS sales_manager_name, c_custkey % 50 AS owner_id, ow.s_name AS owner_name,
revenue_types, currencies, CAST(CAST(c_acctbal AS DECIMAL(27,9)) AS DOUBLE) AS initial_budget, CAST(coalesce(c, 0) AS DOUBLE) AS compensation_budget, CAST(coalesce(a, 0) AS DOUBLE) AS addition_budget,
CAST(0 AS DOUBLE) AS promotion_budget, CAST(coalesce(o, 0) AS DOUBLE) AS carryover_budget,
CAST(CAST(c_acctbal AS DECIMAL(27,9)) + coalesce(c, 0) + coalesce(a, 0) + coalesce(o, 0) AS DOUBLE) AS total_budget
FROM customer LEFT JOIN x ON o_custkey = c_custkey LEFT JOIN supplier sm ON sm.s_suppkey = c_nationkey LEFT JOIN supplier ow ON ow.s_suppkey = c_custkey % 50""")


def _payouts(t):
    """Orders as payouts, their lines as adjustments; customers as a second source without any."""
    pay = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("unit_id"), F.col("o_orderdate").alias("month_at"),
                          money("o_totalprice").alias("ours"), money(F.lit(1)).alias("theirs"), F.col("o_orderstatus").alias("status"))
    adj = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_orderkey", "l_partkey").agg(
        money(F.sum(money("l_extendedprice"))).alias("ours"), money(F.sum(money("l_quantity"))).alias("theirs"))
    adj = adj.select(F.col("l_partkey").alias("id"), F.col("l_orderkey").alias("payout_id"), "ours", "theirs", F.concat(F.lit("part "), "l_partkey").alias("note"))
    second = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("unit_id"), ts("2020-01-01 00:00:00").alias("month_at"),
                               money("c_acctbal").alias("ours"), money(F.lit(0)).alias("theirs"), F.lit("X").alias("status"))
    return m.payouts([("orders", pay, adj), ("customers", second, adj.filter("payout_id < 0"))])


add("B27_payouts", _payouts,
    f"""WITH a AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(27,9))) AS ours, sum(CAST(l_quantity AS DECIMAL(27,9))) AS theirs, 'part ' || max(l_partkey) AS memo
 FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_custkey AS unit_id, o_orderdate AS month_at, CAST({PRICE} + coalesce(ours, 0) AS DOUBLE) AS ours, CAST(1 + coalesce(theirs, 0) AS DOUBLE) AS theirs, o_orderstatus AS status,
memo, 'orders' AS data_source FROM orders LEFT JOIN a ON l_orderkey = o_orderkey
UNION ALL SELECT c_custkey, TIMESTAMP '2020-01-01', CAST(CAST(c_acctbal AS DECIMAL(27,9)) AS DOUBLE), CAST(0 AS DOUBLE), 'X', NULL, 'customers' FROM customer""")

# Settlement. Formulas read the summed row and the contract's rates.

def rules() -> list[m.PayoutRule]:
    display, action = F.col("display_revenue") * (1 - F.col("agency_fee")), F.col("action_unit_revenue")
    cost, share = F.col("display_cost") + F.col("base_reward_cost"), F.col("share_rate")
    return [
        m.PayoutRule("PARTNER_A", "first", F.lit(0), F.lit(0), F.col("display_cost"), F.col("action_cost")),
        m.PayoutRule("PARTNER_B", "first", display * 0.5, action * 0.5, F.col("display_cost") * 0.5, F.col("action_cost") * 0.5),
        m.PayoutRule("PARTNER_C", "second", display * share - F.col("media_display_revenue") * 0.1, action * share, cost * -1, F.col("action_cost") * -1),
        m.PayoutRule("STANDARD", "second", display * share, action * share, cost * share, F.col("action_cost") * share)]


def _split(t):
    """Statistics per user and unit with the part as line item: size 1 is our own, half the types are displays."""
    s = t.actions.join(t.part, F.col("p_partkey") == F.col("lineitem_id")).join(t.units, "unit_id").select(
        F.date_trunc("day", "time").cast("timestamp_ntz").alias("date_at"), "ifa", "unit_id", "unit_name", "unit_type", "organization_id",
        F.when(F.col("p_size") < 25, 1).otherwise(2).alias("lineitem_organization_id"), F.when(F.col("p_size") % 2 == 0, "cpc").otherwise("cpa").alias("lineitem_revenue_type"),
        F.nullif(F.col("p_size") % 5, F.lit(4)).alias("adnetwork_id"), F.col("sales").alias("sales_total"), F.nullif("sales", F.lit(0)).alias("unit_sales_total"),
        money(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("reward_total"))
    return m.revenue_split(s, account_type(), excluded_network=3)


def _costs(t):
    rows = t.logs("view").join(t.units, "unit_id").withColumn("account_type", account_type())
    return rows.groupBy(F.date_trunc("day", "time").cast("timestamp_ntz").alias("date_at"), "ifa", "unit_id", "account_type").agg(
        money(F.count("*")).alias("display_cost"), money(F.count("*") * 2).alias("base_reward_cost"))


def contracts(t, start: str):
    """The newest payout of a unit names its contract; nations stand for contracts."""
    made = t.orders.groupBy((F.col("o_custkey") % 10).alias("unit_id"), "o_orderdate").agg(F.max(F.col("o_custkey") % 25).alias("billing_contract_id"))
    terms = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), (F.col("n_nationkey") / 100).cast("decimal(4,2)").alias("agency_fee"),
                            (F.col("n_regionkey") / 10).cast("decimal(4,2)").alias("share_rate"))
    return m.latest_contracts(made.withColumnRenamed("o_orderdate", "created_at"), terms, start)


def _settle(t):
    first, second = contracts(t, "2001-01-01 00:00:00"), contracts(t, "1995-01-01 00:00:00")
    return m.settle_revenue(_split(t), _costs(t), {"first": first, "second": second}, rules())


add("B29_settle_revenue", _settle,
    f"""WITH {ACTIONS}, {UNITS}, s AS (SELECT date_trunc('day', time) AS d, ifa, unit_id, {ACCOUNT_SQL} AS account_type, p_size < 25 AS own, p_size % 2 = 0 AS display,
 nullif(p_size % 5, 4) AS net, sales, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS reward, event_type, lineitem_id IS NULL AS x
 FROM actions JOIN part ON p_partkey = lineitem_id JOIN units USING (unit_id)),
sums AS (SELECT d AS date_at, ifa, unit_id, account_type, sum(CASE WHEN own AND display THEN sales ELSE 0 END) AS dr, sum(CASE WHEN NOT own AND display THEN sales ELSE 0 END) AS mdr,
 sum(CASE WHEN own AND NOT display THEN sales ELSE 0 END) AS ar, sum(CASE WHEN own AND (net <> 3 OR net IS NULL) THEN reward ELSE 0 END) AS ac FROM s GROUP BY 1, 2, 3, 4),
costs AS (SELECT date_trunc('day', time) AS date_at, ifa, unit_id, {ACCOUNT_SQL} AS account_type, count(*) AS dc FROM actions JOIN units USING (unit_id) WHERE event_type = 'view' GROUP BY 1, 2, 3, 4),
allk AS (SELECT date_at, ifa, unit_id, account_type, sum(dr) AS dr, sum(mdr) AS mdr, sum(ar) AS ar, sum(ac) AS ac, sum(dc) AS dc FROM
 (SELECT *, 0 AS dc FROM sums UNION ALL SELECT date_at, ifa, unit_id, account_type, 0, 0, 0, 0, dc FROM costs) GROUP BY 1, 2, 3, 4),
made AS (SELECT o_custkey % 10 AS unit_id, o_orderdate, max(o_custkey % 25) AS cid FROM orders GROUP BY 1, 2),
con AS (SELECT unit_id, 'first' AS src, arg_max(cid, o_orderdate) AS cid FROM made WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1
 UNION ALL SELECT unit_id, 'second', arg_max(cid, o_orderdate) FROM made WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1),
terms AS (SELECT unit_id, src, CAST(n_nationkey AS DOUBLE) / 100 AS fee, CAST(n_regionkey AS DOUBLE) / 10 AS share FROM con JOIN nation ON n_nationkey = cid),
j AS (SELECT a.*, 1 - fee AS f, share FROM allk a LEFT JOIN terms t ON t.unit_id = a.unit_id AND t.src = CASE WHEN account_type IN ('PARTNER_A', 'PARTNER_B') THEN 'first'
 WHEN account_type IN ('PARTNER_C', 'STANDARD') THEN 'second' END)
SELECT CAST(date_at AS TIMESTAMP) AS date_at, ifa, unit_id, account_type, CAST(dr AS DOUBLE) AS display_revenue, CAST(ar AS DOUBLE) AS action_revenue, CAST(dc AS DOUBLE) AS display_cost,
CAST(ac AS DOUBLE) AS action_cost, CAST(2 * dc AS DOUBLE) AS base_reward_cost,
round(CASE account_type WHEN 'PARTNER_A' THEN 0 WHEN 'PARTNER_B' THEN dr * f * 0.5 WHEN 'PARTNER_C' THEN dr * f * share - mdr * 0.1 WHEN 'STANDARD' THEN dr * f * share END, 6) AS display_revenue_payout,
round(CASE WHEN account_type = 'PARTNER_A' THEN 0 WHEN account_type = 'PARTNER_B' THEN ar * 0.5 WHEN account_type IN ('PARTNER_C', 'STANDARD') THEN ar * share END, 6) AS action_revenue_payout,
round(CASE account_type WHEN 'PARTNER_A' THEN dc WHEN 'PARTNER_B' THEN dc * 0.5 WHEN 'PARTNER_C' THEN -3 * dc WHEN 'STANDARD' THEN 3 * dc * share END, 6) AS display_cost_payout,
round(CASE account_type WHEN 'PARTNER_A' THEN ac WHEN 'PARTNER_B' THEN ac * 0.5 WHEN 'PARTNER_C' THEN -ac WHEN 'STANDARD' THEN ac * share END, 6) AS action_cost_payout FROM j""")


def _point_costs(t):
    units = t.units.select(F.col("unit_id").alias("id"), F.col("unit_name"), "organization_id", "unit_type",
                           F.when(F.col("organization_id") == 0, "USD").when(F.col("organization_id") == 1, "INR").when(
                               F.col("organization_id") == 2, "JPY").otherwise("KRW").alias("currency"))
    p = t.lineitem.select(F.col("l_shipdate").alias("created_at"), F.col("l_linestatus").alias("ifa"), (F.col("l_suppkey") % 10).alias("unit_id"),
                          F.when(F.col("l_returnflag") == "R", F.col("l_partkey") + 1000000001).otherwise(F.col("l_partkey")).alias("refer_key"),
                          F.col("l_quantity").cast("bigint").alias("amount"), F.col("l_linenumber").cast("bigint").alias("base_reward"))
    out = m.point_costs(p, units, point_items(t), campaigns(t), account_type())
    return out.withColumns({c: F.round(c, 4) for c in ("display_cost", "base_reward_cost")})


add("B29_point_costs", _point_costs,
    f"""WITH {POINTS}, {UNITS}, p AS (SELECT l_shipdate AS stamp, l_linestatus AS ifa, l_suppkey % 10 AS unit_id, CAST(l_quantity AS BIGINT) AS amount, l_linenumber AS base,
 CASE WHEN l_returnflag = 'R' THEN l_partkey + 1000000001 ELSE l_partkey END AS campaign_id FROM lineitem),
q AS (SELECT p.*, unit_name, unit_type, units.organization_id, coalesce(ca.organization_id, li.organization_id) AS co,
 CASE units.organization_id WHEN 0 THEN 1000 WHEN 1 THEN 100 WHEN 2 THEN 10 ELSE 1 END AS rate FROM p {OWNED} JOIN units USING (unit_id))
SELECT CAST(date_trunc('day', stamp + INTERVAL 9 HOUR) AS TIMESTAMP) AS date_at, ifa, unit_id, {ACCOUNT_SQL} AS account_type, CAST(sum(amount) AS BIGINT) AS point_cost,
round(CAST(sum(CASE WHEN co <> organization_id THEN amount - base ELSE 0 END) AS DOUBLE) / any_value(rate), 4) AS display_cost,
round(CAST(sum(base) AS DOUBLE) / any_value(rate), 4) AS base_reward_cost FROM q GROUP BY 1, 2, 3, 4, rate""")
