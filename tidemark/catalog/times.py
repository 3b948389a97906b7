"""Time windows and streams (X), slot scans."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, add
from tidemark.catalog.merges import LINE_KEYS, TIEBREAK, stream
from tidemark.functions.times import business_day
from tidemark.operators import dedup, ordered, slots
from tidemark.session import scratch_dir
from tidemark.streaming import streams

START, END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"

add("S02_slot_scan", lambda t: slots.scan_slot(
    t.actions, START, END, shift=timedelta(hours=-1), lookback=(2, "day")).select("event_id"),
    f"""WITH {ACTIONS} SELECT event_id FROM actions WHERE partition_timestamp >= TIMESTAMP '2024-01-04 23:00:00' - INTERVAL 2 DAY
AND partition_timestamp < TIMESTAMP '2024-01-19 23:00:00'""")
add("S03_snapshot_scan", lambda t: slots.scan_snapshot(t.actions, "2024-01-10 12:00:00").withColumn("kind", F.lit("at")).unionByName(
    slots.scan_snapshot(t.actions, "2024-01-10 12:00:00", within=timedelta(hours=6)).withColumn("kind", F.lit("within"))).select("event_id", "kind"),
    f"""WITH {ACTIONS} SELECT event_id, 'at' AS kind FROM actions WHERE partition_timestamp = TIMESTAMP '2024-01-10 12:00:00' UNION ALL
SELECT event_id, 'within' FROM actions WHERE partition_timestamp > TIMESTAMP '2024-01-10 06:00:00' AND partition_timestamp <= TIMESTAMP '2024-01-10 12:00:00'""")

add("X01_tumbling", lambda t: slots.tumbling(t.actions, "time", "week", ["event_type"], {"n": F.count("*")}, offset_hours=9),
    f"WITH {ACTIONS} SELECT CAST(date_trunc('week', time + INTERVAL 9 HOUR) AS TIMESTAMP) AS data_at, event_type, count(*) AS n FROM actions GROUP BY 1, 2")
add("X02_lookback", lambda t: slots.lookback_agg(
    t.actions, "time", "2024-01-31 00:00:00", (28, "day"), ["lineitem_id"], {"users": F.count_distinct("user_id")}),
    f"WITH {ACTIONS} SELECT lineitem_id, count(DISTINCT user_id) AS users FROM actions WHERE time >= TIMESTAMP '2024-01-03' AND time < TIMESTAMP '2024-01-31' GROUP BY 1")
GAP = 6 * 3600


def _sessions(t):
    numbered = ordered.sessionize(t.events, ["user_id"], "ts", GAP)
    return numbered.groupBy("user_id", "session_id").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("n"))


SESSIONS = f"""d AS (SELECT user_id, ts, CASE WHEN date_diff('second', lag(ts) OVER w, ts) <= {GAP} THEN 0 ELSE 1 END AS opens
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_id FROM d),
sessions AS (SELECT user_id, CAST(session_id AS BIGINT) AS session_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n FROM s GROUP BY 1, 2)"""
add("X03_sessions", _sessions, f"WITH {SESSIONS} SELECT * FROM sessions")


def _stream_sessions(t):
    """Closed sessions only: the watermark trails the newest event by a day."""
    source = streams.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")
    out = streams.stream_sessions(source, ["user_id"], "ts", f"{GAP} seconds", "1 day", {"n": F.count("*")})
    path = scratch_dir(t.spark, "sessions")
    streams.write_parquet(out, path, scratch_dir(t.spark, "sessions-state"))
    return t.spark.read.parquet(path).select("user_id", "start_time", "end_time", "n")


add("X03_stream_sessions", _stream_sessions,
    f"""WITH d AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL {GAP} SECOND THEN 0 ELSE 1 END AS opens
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM d)
SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n FROM s GROUP BY user_id, no
HAVING max(ts) + INTERVAL {GAP} SECOND <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
add("X04_month_to_date", lambda t: slots.month_to_date(t.orders, "o_orderdate", "2000-03-17", ["o_orderstatus"],
                                                       {"customers": F.count_distinct("o_custkey")}),
    "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_orderdate >= TIMESTAMP '2000-03-01' "
    "AND o_orderdate < TIMESTAMP '2000-03-18' GROUP BY 1")
add("X05_late_scan", lambda t: slots.scan_late(
    stream(t), "created_at", "1997-01-01 00:00:00", "1998-01-01 00:00:00", slack=timedelta(days=3)).select(*LINE_KEYS, "created_at"),
    """SELECT l_orderkey, l_linenumber, l_shipdate AS created_at FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
AND l_shipdate + l_linenumber * INTERVAL 24 HOUR >= TIMESTAMP '1996-12-29' AND l_shipdate + l_linenumber * INTERVAL 24 HOUR < TIMESTAMP '1998-01-04'""")


def _stream_on_time(t):
    source = streams.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")
    out = streams.stream_on_time(source, "ts", "1 hour", ["event_type"], "1 day", {"n": F.count("*")})
    path = scratch_dir(t.spark, "hours")
    streams.write_parquet(out, path, scratch_dir(t.spark, "hours-state"))
    return t.spark.read.parquet(path)


add("X05_stream_windows", _stream_on_time,
    "WITH d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS data_at, event_type, count(*) AS n FROM events GROUP BY 1, 2) "
    "SELECT * FROM d WHERE data_at + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
add("X06_finalise", lambda t: dedup.finalise(
    stream(t), LINE_KEYS, "l_quantity", "2001-06-08 00:00:00", tiebreak=TIEBREAK).select(*LINE_KEYS, "l_quantity", "updated_at"),
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate AS updated_at FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-06-01' "
    "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_shipdate DESC, "
    + ", ".join(f"{c} DESC" for c in TIEBREAK) + ") = 1")


def _stream_latest(t):
    """Change records through a stream into the log, then its final latest state."""
    source = streams.file_stream(t.spark, t.folder, t.lineitem.schema, glob="lineitem.parquet")
    changes = source.withColumns({"created_at": F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"), "updated_at": F.col("l_shipdate")})
    path = scratch_dir(t.spark, "changes")
    streams.append_changes(changes, path, scratch_dir(t.spark, "changes-state"))
    return streams.read_latest(t.spark, path, LINE_KEYS, "l_quantity", older_than=F.lit("2001-01-01").cast("timestamp_ntz"),
                               tiebreak=TIEBREAK).select(*LINE_KEYS, "l_quantity", "updated_at")


add("X06_stream_latest", _stream_latest,
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate AS updated_at FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01' "
    "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_shipdate DESC, "
    + ", ".join(f"{c} DESC" for c in TIEBREAK) + ") = 1")


def _stream_labels(t):
    """Views, and the purchases of the same user and item within a day; both logs arrive as files."""
    def log(kind):
        source = streams.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet")
        return source.filter(F.col("event_type") == kind)

    causes = log("view").select("event_id", "user_id", "props", F.col("ts").alias("seen_at"))
    effects = log("purchase").select("user_id", "props", F.col("ts").alias("bought_at"))
    out = streams.stream_delayed_label(causes, effects, ["user_id", "props"], "seen_at", "bought_at", (1, "day"), "1 hour")
    path = scratch_dir(t.spark, "labels")
    streams.write_parquet(out, path, scratch_dir(t.spark, "labels-state"))
    rows = t.spark.read.parquet(path)
    # One label per view: the first purchase within the wait, else the end of the wait.
    return rows.groupBy("event_id").agg(F.max("is_occurred").alias("is_occurred"), F.min("occurred_at").alias("occurred_at")).filter(
        F.col("occurred_at") < F.lit("2024-01-28").cast("timestamp_ntz"))


add("X07_stream_delayed_label", _stream_labels,
    """WITH v AS (SELECT v.event_id, min(p.ts) AS bought_at, min(v.ts) AS ts FROM events v LEFT JOIN events p ON p.event_type = 'purchase'
AND p.user_id = v.user_id AND p.props = v.props AND p.ts >= v.ts AND p.ts < v.ts + INTERVAL 1 DAY WHERE v.event_type = 'view' GROUP BY 1)
SELECT event_id, bought_at IS NOT NULL AS is_occurred, coalesce(bought_at, ts + INTERVAL 1 DAY) AS occurred_at FROM v
WHERE coalesce(bought_at, ts + INTERVAL 1 DAY) < TIMESTAMP '2024-01-28'""")
add("X08_drop_late", lambda t: slots.drop_late(
    t.events.withColumn("partition_timestamp", business_day("ts")), "ts").select("event_id"),
    "SELECT event_id FROM events WHERE ts >= date_trunc('day', ts + INTERVAL 9 HOUR)")


def _microbatch(t):
    path = scratch_dir(t.spark, "arrivals")
    streams.file_microbatch(t.spark, t.folder, t.events.schema,
                            lambda b: b.groupBy("user_id", "event_type").agg(F.sum("value").alias("v"), F.count("*").alias("n")),
                            path, scratch_dir(t.spark, "arrivals-state"), glob="events.parquet")
    return t.spark.read.parquet(path).groupBy("user_id", "event_type").agg(F.sum("n").alias("n"))


add("X09_file_microbatch", _microbatch, "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
