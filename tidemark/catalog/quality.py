"""Data checks (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import REGISTRY, add
from tidemark.catalog.merges import LINE_KEYS, STATUS, REST, stream
from tidemark.operators import quality as q
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.joins import union_all


def row(name: str, lhs: str, op: str, threshold: str, test: str, source: str) -> str:
    return (f"SELECT '{name}' AS name, lhs, '{op}' AS op, CAST({threshold} AS DOUBLE) AS threshold, lhs {test} {threshold} AS passed "
            f"FROM (SELECT CAST({lhs} AS DOUBLE) AS lhs {source})")


def _linear(t):
    views, clicks = (t.logs(k).agg(F.count("*")) for k in ("view", "click"))
    none = t.orders.filter("o_totalprice < 0").agg(F.sum("o_totalprice"))
    return union_all(q.check_linear("balance", views, "le", 1000, clicks, 10, -9),
                     q.check_linear("only x1", views, "gt", 1), q.check_linear("empty", none, "eq", 0))


V, C = "count(*) FILTER (event_type = 'view')", "count(*) FILTER (event_type = 'click')"
add("Q01_linear", _linear, " UNION ALL ".join([
    row("balance", f"10 * {V} - 9 * {C}", "le", "1000", "<=", "FROM events"), row("only x1", V, "gt", "1", ">", "FROM events"),
    row("empty", "coalesce(sum(o_totalprice), 0)", "eq", "0", "=", "FROM orders WHERE o_totalprice < 0")]))
add("Q02_exists", lambda t: q.check_exists("purchases", t.events, F.col("event_type") == "purchase"),
    row("purchases", "count(*) FILTER (event_type = 'purchase')", "gt", "0", ">", "FROM events"))
add("Q03_trend", lambda t: q.check_trend("daily", t.events, "ts", "2024-01-21 00:00:00", "2024-01-22 00:00:00",
                                         "2024-01-20 00:00:00", "2024-01-21 00:00:00"),
    row("daily", "count(*) FILTER (ts >= TIMESTAMP '2024-01-21' AND ts < TIMESTAMP '2024-01-22') "
        "- CAST(0.9 AS DOUBLE) * count(*) FILTER (ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21')", "ge", "0", ">=", "FROM events"))
add("Q04_reconcile", lambda t: q.check_reconcile(
    "counts", t.orders, t.lineitem.select("l_orderkey").distinct(), F.count("*"), F.count("*")),
    row("counts", "(SELECT count(*) FROM orders) - (SELECT count(DISTINCT l_orderkey) FROM lineitem)", "eq", "0", "=", ""))


def _dedup(t):
    clean = dedup_latest(stream(t), LINE_KEYS, "l_returnflag", ordered_values=STATUS, tiebreak=REST)
    return union_all(q.check_dedup("deduplicated", stream(t), clean, LINE_KEYS), q.check_dedup("raw", stream(t), stream(t), LINE_KEYS))


add("Q05_dedup", _dedup, " UNION ALL ".join([
    row("deduplicated", "0", "eq", "0", "=", ""),
    row("raw", "sum(n)", "eq", "0", "=", "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")]))


def _hours(t):
    day = t.events.filter((F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    return q.check_hours("hours", day, "ts")


add("Q06_hours", _hours, row("hours", "count(DISTINCT date_trunc('hour', ts))", "eq", "24", "=",
                             "FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'"))


def _one_pass(t):
    """The checks above, but for Q05: three tables, three scans."""
    e, none = t.events, F.sum(F.when(F.col("o_totalprice") < 0, F.col("o_totalprice")))
    kind = F.col("event_type")
    views, clicks = F.count_if(kind == "view"), F.count_if(kind == "click")
    return q.check_all(t.spark, [
        q.Check("balance", (e, views), "le", 1000, (e, clicks), 10, -9), q.Check("only x1", (e, views), "gt", 1),
        q.Check("empty", (t.orders, none), "eq"), q.exists("purchases", e, kind == "purchase"),
        q.trend("daily", e, "ts", "2024-01-21 00:00:00", "2024-01-22 00:00:00", "2024-01-20 00:00:00", "2024-01-21 00:00:00"),
        q.reconcile("counts", t.orders, t.lineitem, F.count("*"), F.count_distinct("l_orderkey")),
        q.hours("hours", e, "ts", "2024-01-15 00:00:00", "2024-01-16 00:00:00")])


add("Q01_checks_in_one_pass", _one_pass, " UNION ALL ".join(
    REGISTRY[k].sql for k in ("Q01_linear", "Q02_exists", "Q03_trend", "Q04_reconcile", "Q06_hours")))


def _guard(t):
    """The guard raises when its comparison holds; here it must let the count pass."""
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    smallest = counts.agg(F.min("n")).first()[0]
    q.guard(smallest, "le", 0)
    return counts


add("Q07_guard", _guard, "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
