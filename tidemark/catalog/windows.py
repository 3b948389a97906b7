"""Windows (W), sort and top-k (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, add
from tidemark.functions.numbers import money
from tidemark.operators import aggregates, ordered
from tidemark.sources.extract import FrameReader, extract_table

CUST = ["o_custkey"]
BY_DATE = ["o_orderdate", "o_orderkey"]
OVER = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
PRICE = "CAST(o_totalprice AS DECIMAL(27,9))"


def spend(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", money("o_totalprice").alias("price"))


add("W01_row_number", lambda t: ordered.add_row_number(t.orders, CUST, [("o_orderdate", "desc"), ("o_orderkey", "desc")]).select(
    "o_orderkey", "row_num"),
    "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS row_num FROM orders")
add("W02_rank", lambda t: ordered.add_rank(
    t.actions.groupBy("unit_id", "lineitem_id").agg(F.count("*").alias("cnt")), ["unit_id"], [("cnt", "desc")]),
    f"WITH {ACTIONS}, c AS (SELECT unit_id, lineitem_id, count(*) AS cnt FROM actions GROUP BY 1, 2) "
    "SELECT *, rank() OVER (PARTITION BY unit_id ORDER BY cnt DESC) AS rank FROM c")
add("W03_sample_per_group", lambda t: ordered.sample_per_group(t.items, ["feed"], "id", 10, 42).select("feed", "id"),
    "SELECT p_brand AS feed, p_partkey AS id FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY md5(p_partkey || ':42'), p_partkey) <= 10")
add("W04_lag", lambda t: ordered.add_lag(t.events, "ts", ["user_id"], ["ts", "event_id"], "previous").select("event_id", "previous"),
    "SELECT event_id, lag(ts, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events")
add("W05_first_last", lambda t: ordered.first_last_per_key(t.orders, CUST, ["o_orderstatus", "o_totalprice"], BY_DATE),
    f"SELECT DISTINCT o_custkey, "
    + ", ".join(f"{w}_value({c}) OVER w AS {w}_{c}" for w in ("first", "last") for c in ("o_orderstatus", "o_totalprice"))
    + " FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
add("W06_running_sum", lambda t: ordered.running_sum(spend(t), "price", CUST, BY_DATE, "running").select("o_orderkey", "running"),
    f"SELECT o_orderkey, CAST(sum({PRICE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders")
add("W07_global_running_sum", lambda t: ordered.running_sum(spend(t), "price", [], BY_DATE, "running").select("o_orderkey", "running"),
    f"SELECT o_orderkey, CAST(sum({PRICE}) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders")
add("W08_two_grains", lambda t: ordered.running_sums(
    spend(t), "price", {"by_customer": CUST, "by_status": ["o_custkey", "o_orderstatus"]}, BY_DATE).select(
    "o_orderkey", "by_customer", "by_status"),
    f"""SELECT o_orderkey,
CAST(sum({PRICE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS by_customer,
CAST(sum({PRICE}) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS by_status
FROM orders""")

add("T01_sort", lambda t: aggregates.sort(t.actions.groupBy("unit_id").agg(F.count("*").alias("n")), [F.desc("n"), "unit_id"]),
    f"WITH {ACTIONS} SELECT unit_id, count(*) AS n FROM actions GROUP BY 1 ORDER BY 2 DESC, 1")
add("T02_max_value", lambda t: aggregates.max_value(t.orders, "o_orderdate"),
    "SELECT o_orderdate AS max_value FROM orders ORDER BY 1 DESC LIMIT 1")
add("T03_pages_as_ranges", lambda t: extract_table(
    FrameReader(t.orders), ["o_orderkey", "o_totalprice"], "numeric", "o_orderkey", step=1000, number="page"),
    "SELECT o_orderkey, o_totalprice, CAST((o_orderkey - (SELECT min(o_orderkey) FROM orders)) // 1000 AS INTEGER) AS page FROM orders")
PARTS = "c AS (SELECT p_brand, p_type, l_partkey, count(*) AS cnt FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3)"


def _sold(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("cnt")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "p_type", "l_partkey", "cnt")


add("T04_top_n", lambda t: ordered.top_n(_sold(t), ["p_brand", "p_type"], [("cnt", "desc"), "l_partkey"], 100),
    f"WITH {PARTS} SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY cnt DESC, l_partkey) <= 100")
add("T05_last_n", lambda t: ordered.last_n(t.orders, ["o_custkey"], ["o_orderdate"], 5).select("o_orderkey", "o_custkey"),
    "SELECT o_orderkey, o_custkey FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) <= 5")
add("T06_top_category", lambda t: ordered.top_n(
    t.logs("purchase").join(t.items, F.col("id") == F.col("lineitem_id")).groupBy("user_id", "category").agg(F.count("*").alias("n")),
    ["user_id"], [("n", "desc")], 1, ties="keep"),
    f"""WITH {ACTIONS}, c AS (SELECT user_id, p_type AS category, count(*) AS n FROM actions JOIN part ON p_partkey = lineitem_id
WHERE event_type = 'purchase' GROUP BY 1, 2) SELECT * FROM c QUALIFY rank() OVER (PARTITION BY user_id ORDER BY n DESC) = 1""")
