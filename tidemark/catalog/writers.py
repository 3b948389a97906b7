"""Writers (K): each query writes to the scratch folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, add
from tidemark.catalog.merges import LOADS, source, target
from tidemark.operators.slots import scan_slot
from tidemark.session import scratch_dir
from tidemark.sinks import logs, retention, slots, unload
from tidemark.sources.partitions import read_slots, slot_dir, slot_filter

COLS = ["event_id", "user_id", "event_type", "value"]
SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def _days(t):
    """Half a month per slot, the first slot written twice."""
    path = scratch_dir(t.spark, "slots")
    parts = [("2024-01-01 00:00:00", "2024-01-16 00:00:00"), ("2024-01-16 00:00:00", "2024-02-01 00:00:00")]
    for start, end in [*parts, parts[0]]:
        slots.write_slot(scan_slot(t.events, start, end, slot="ts").select(*COLS), path, start)
    rows = read_slots(t.spark, path).filter(slot_filter("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    return rows.select(*COLS, "partition_timestamp")


add("K01_slot_write", _days,
    "SELECT event_id, user_id, event_type, value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-16' END "
    "AS partition_timestamp FROM events")


def _empty(t):
    """Each policy meets a slot that already has rows and then gets an empty result."""
    path, found = scratch_dir(t.spark, "empty"), []
    views = t.events.filter("event_type = 'view'").select(*COLS)
    for i, policy in enumerate(("skip", "fail", "keep")):
        at = f"2024-01-01 0{i}:00:00"
        slots.write_slot(views, path, at)
        try:
            state = f"{slots.write_slot(views.filter('event_id < 0'), path, at, on_empty=policy).rows} rows"
        except ValueError:
            state = "error"
        old = t.spark.read.schema(SCHEMA).parquet(f"{path}/{slot_dir(at)}")
        found.append(old.agg(F.lit(policy).alias("policy"), F.lit(state).alias("state"), F.count("*").alias("n")))
    return found[0].unionByName(found[1]).unionByName(found[2])


add("K02_empty_policy", _empty,
    "WITH v AS (SELECT count(*) AS n FROM events WHERE event_type = 'view') SELECT 'skip' AS policy, '0 rows' AS state, n FROM v "
    "UNION ALL SELECT 'fail', 'error', n FROM v UNION ALL SELECT 'keep', '0 rows', 0")


def _registered(t):
    """Slots written into a registered table, one of them twice, are seen by a query of the table."""
    path = scratch_dir(t.spark, "registered")
    name = "written_" + path.rsplit("-", 1)[1][:12]
    for kind, hour in (("view", 0), ("click", 1), ("click", 1)):
        slots.write_slot(t.events.filter(F.col("event_type") == kind).select(*COLS), path, f"2024-01-01 0{hour}:00:00", table=name)
    return t.spark.table(name)


add("K01_registered_slots", _registered,
    "SELECT event_id, user_id, event_type, value, CASE event_type WHEN 'view' THEN TIMESTAMP '2024-01-01 00:00:00' "
    "ELSE TIMESTAMP '2024-01-01 01:00:00' END AS partition_timestamp FROM events WHERE event_type IN ('view', 'click')")


def _bucketed(t):
    path = scratch_dir(t.spark, "buckets")
    slots.write_slot(t.events.select(*COLS), path, "2024-01-01 00:00:00", bucket_by="user_id", buckets=10)
    rows = t.spark.read.parquet(path).withColumn("file", F.input_file_name())
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))


add("K03_bucketed_write", _bucketed, "SELECT user_id, count(*) AS n, 1 AS files FROM events GROUP BY 1")


def _formats(t):
    parts = []
    for fmt in ("parquet", "json", "tsv"):
        done = slots.write_slot(t.events.select(*COLS), scratch_dir(t.spark, fmt), "2024-01-01 00:00:00", fmt=fmt)
        kind, options = slots.FORMATS[fmt]
        parts.append(t.spark.read.format(kind).schema(SCHEMA).options(**{k: v for k, v in options.items() if k == "sep"}).load(done.path)
                     .withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("K04_formats", _formats, " UNION ALL ".join(
    f"SELECT event_id, user_id, event_type, value, '{f}' AS fmt FROM events" for f in ("parquet", "json", "tsv")))


def _fan_out(t):
    path = scratch_dir(t.spark, "fan")
    slots.fan_out(t.events.select(*COLS), "event_type", ["view", "purchase"], path)
    return t.spark.read.parquet(path).select(*COLS)


add("K05_fan_out", _fan_out, "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('view', 'purchase')")


def _unload(t):
    parts, rows = [], t.part.select("p_partkey", "p_name", F.nullif("p_type", F.lit("ECONOMY")).alias("p_type"))
    for preset, (kind, options) in unload.UNLOAD.items():
        path = scratch_dir(t.spark, preset)
        unload.unload(rows, path, preset, rows_per_file=500)
        read = {"header": options.get("header", "false"), "sep": options.get("sep", ","), "escape": "\\", "nullValue": ""}
        parts.append(t.spark.read.format(kind).schema(rows.schema).options(**(read if kind == "csv" else {})).load(path)
                     .withColumn("preset", F.lit(preset)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


add("K06_unload", _unload, " UNION ALL ".join(
    f"SELECT p_partkey, p_name, nullif(p_type, 'ECONOMY') AS p_type, '{p}' AS preset FROM part" for p in ("pipe", "comma", "single_csv", "parquet")))


def _rows(t):
    """Texts with every character that a form has to protect."""
    odd = F.concat("o_orderpriority", F.lit('\n|"x"\\'), "o_orderstatus", F.lit("\\n\\\\"))
    rows = t.orders.select("o_orderkey", "o_orderdate", odd.alias("o_note"))
    parts = []
    for fmt in ("csv", "json", "parquet"):
        path = scratch_dir(t.spark, f"rows-{fmt}")
        unload.write_rows(rows, path, fmt)
        parts.append(unload.read_rows(t.spark, path, rows.schema, fmt).withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("K07_row_serialisers", _rows, " UNION ALL ".join(
    f"SELECT o_orderkey, o_orderdate, o_orderpriority || chr(10) || '|\"x\"\\' || o_orderstatus || '\\n\\\\' AS o_note, '{f}' AS fmt FROM orders" for f in ("csv", "json", "parquet")))
add("K08_jdbc_rows", lambda t: unload.jdbc_rows(source(t), ["o_orderkey", "price"], target(t), ["o_orderkey"]),
    f"WITH {LOADS} SELECT o_orderkey, price FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source) "
    "UNION ALL SELECT o_orderkey, price FROM source")


def service_logs(t):
    """Cluster log lines: JSON text, except for errors. Their time is the half day of the event, as
    every hour and service becomes a folder."""
    body = F.to_json(F.struct("event_id", "user_id", "event_type"))
    return t.events.select(
        F.when(F.col("event_type") == "error", "plain text").otherwise(body).alias("log"),
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.when(F.hour("ts") < 12, " 00:00:00").otherwise(" 12:00:00")).alias("time"),
        F.create_map(F.lit("namespace_name"), F.when(F.col("event_type") == "view", "front").otherwise("back")).alias("kubernetes"))


def _service_logs(t):
    from tidemark.plans.marts import shred_service_logs
    path = scratch_dir(t.spark, "logs")
    logs.write_service_logs(shred_service_logs(service_logs(t)), path)
    return t.spark.read.schema("event_id bigint, user_id bigint, event_type string, service string, year string, month string, day string, hour string, log_type string").json(path)


SERVICE_SQL = ("SELECT event_id, user_id, event_type, CASE event_type WHEN 'view' THEN 'front' ELSE 'back' END AS service, "
               "strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, CASE WHEN hour(ts) < 12 THEN '00' ELSE '12' END AS hour, "
               "'general' AS log_type{more} FROM events WHERE event_type <> 'error'")
add("K09_service_logs", _service_logs, SERVICE_SQL.format(more=""))
add("K10_retention", lambda t: retention.expirable_slots(t.actions, "2024-01-20 00:00:00", 48),
    f"""WITH {ACTIONS}, s AS (SELECT count(DISTINCT partition_timestamp) AS slots FROM actions
WHERE partition_timestamp BETWEEN TIMESTAMP '2024-01-18' AND TIMESTAMP '2024-01-20')
SELECT TIMESTAMP '2024-01-18' AS slot, slots, slots > 48 AS expire FROM s""")
