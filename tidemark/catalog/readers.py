"""Readers (S). Raw files are first written from the tables, then read the way the raw logs are."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.base import add
from tidemark.functions.times import parse_ts_multi
from tidemark.operators.merges import last_increment_value
from tidemark.session import scratch_dir
from tidemark.sources import changes, extract, partitions, text

EVENT = "event_id bigint, user_id bigint, event_type string, value double"
EVENT_COLS = ["event_id", "user_id", "event_type", "value"]


def _register(t):
    """Two partitions of an external table whose slot is not part of their path."""
    base = scratch_dir(t.spark, "landing")
    table = "slots_" + base.rsplit("-", 1)[1][:12]
    for kind, at in (("view", "2024-01-01 00:00:00"), ("click", "2024-01-01 01:00:00")):
        place = f"{base}/{partitions.slot_dir(at)}"
        t.events.filter(F.col("event_type") == kind).select(*EVENT_COLS).write.mode("overwrite").parquet(place)
        for _ in range(2):
            partitions.register_partition(t.spark, table, EVENT, at, place, base=base)
    return t.spark.table(table)


add("S01_register_partition", _register,
    "SELECT event_id, user_id, event_type, value, CASE event_type WHEN 'view' THEN TIMESTAMP '2024-01-01 00:00:00' "
    "ELSE TIMESTAMP '2024-01-01 01:00:00' END AS partition_timestamp FROM events WHERE event_type IN ('view', 'click')")


def _json_lines(t):
    """Every error event's line is cut off, so it does not parse."""
    line = F.to_json(F.struct(*EVENT_COLS))
    cut = F.when(F.col("event_type") == "error", F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    path = scratch_dir(t.spark, "lines")
    t.events.withColumn("line", line).select(cut.alias("value")).write.text(path)
    counts = [F.count("*").alias("n"), F.count("event_id").alias("ids"), F.sum("event_id").alias("id_sum"), F.count("value").alias("vals"),
              F.count_if(F.col("event_type") == "error").alias("errors")]
    kept = text.read_json_lines(t.spark, path, EVENT).agg(*counts).withColumn("mode", F.lit("null"))
    dropped = text.read_json_lines(t.spark, path, EVENT, "drop").agg(*counts).withColumn("mode", F.lit("drop"))
    return kept.unionByName(dropped)


_GOOD = ("count(*) FILTER (event_type <> 'error') AS ids, CAST(sum(event_id) FILTER (event_type <> 'error') AS BIGINT) AS id_sum, "
         "count(value) FILTER (event_type <> 'error') AS vals, 0 AS errors")
add("S04_json_lines", _json_lines,
    f"SELECT count(*) AS n, {_GOOD}, 'null' AS mode FROM events UNION ALL SELECT count(*) FILTER (event_type <> 'error'), {_GOOD}, 'drop' FROM events")


def _formats(t):
    stamp = F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).when(
        F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(
        F.col("event_type") == "error", F.lit("?")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.S"))
    formats = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS",
               "yyyy-MM-dd'T'HH:mm:ss.S", "yyyy-MM-dd HH:mm:ss"]
    return t.events.select("event_id", parse_ts_multi(stamp, formats).alias("at"))


add("S05_timestamp_formats", _formats,
    "SELECT event_id, CASE event_type WHEN 'view' THEN ts WHEN 'click' THEN date_trunc('second', ts) WHEN 'error' THEN NULL "
    "ELSE date_trunc('second', ts) + (CAST(date_part('microsecond', ts) AS BIGINT) % 1000000 // 100000) * INTERVAL 100 MILLISECOND END AS at FROM events")

# Lines of the form: [2024-01-01 10:00:00] <view> user 7
LOG = r"^\[([-0-9]{10} [:0-9]{8})\] <(\w+)> (.*)$"


def log_lines(t):
    line = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] <"), F.col("event_type"),
                    F.lit("> user "), F.col("user_id").cast("string"))
    return t.events.select("event_id", F.when(F.col("event_type") == "error", "garbage").otherwise(line).alias("line"))


add("S06_regex_log", lambda t: text.parse_regex_log(log_lines(t), "line", LOG, ["time", "level", "msg"]).drop("line"),
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time, "
    "nullif(event_type, 'error') AS level, CASE WHEN event_type <> 'error' THEN 'user ' || user_id END AS msg FROM events")


def _delimited(t):
    """Every preset, with odd texts, NULLs and epoch times; the tab files are gzip, and notes are cut."""
    rows = t.orders.select("o_orderkey", F.concat("o_orderpriority", F.lit("|,\t'x")).alias("o_note"), F.nullif("o_orderstatus", F.lit("O")).alias("o_status"),
                           F.expr("unix_seconds(cast(o_orderdate as timestamp))").alias("o_at"))
    schema, out = "o_orderkey bigint, o_note string, o_status string, o_at timestamp_ntz", None
    for preset, options in text.DELIMITED.items():
        path, zipped = scratch_dir(t.spark, preset), {"compression": "gzip"} if preset == "tab" else {}
        rows.write.options(**options, **zipped, nullValue="", quoteAll="true").csv(path)
        read = text.read_delimited(t.spark, path, schema, preset, "epochsecs", {"o_note": 11}).withColumn("preset", F.lit(preset))
        out = read if out is None else out.unionByName(read)
    return out


_NOTE = "left(o_orderpriority || '|,' || chr(9) || chr(39) || 'x', 11) AS o_note"
add("S07_delimited", _delimited, " UNION ALL ".join(
    f"SELECT o_orderkey, {_NOTE}, nullif(o_orderstatus, 'O') AS o_status, date_trunc('second', o_orderdate) AS o_at, '{p}' AS preset FROM orders"
    for p in text.DELIMITED))


def _json_paths(t):
    record = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("n"), "event_type").alias("who"),
                                F.unix_micros(F.col("ts").cast("timestamp")).alias("us")))
    rows = t.events.select(record.alias("line"), F.expr("unix_seconds(cast(ts as timestamp))").alias("s"))
    lines = rows.select(F.concat(F.lit('{"at": '), F.col("s").cast("string"), F.lit(', "r": '), "line", F.lit("}")).alias("line"))
    return text.read_json_paths(lines, "line", {
        "event_id": ("$.r.id", "bigint"), "user_id": ("$.r.who.n", "bigint"), "kind": ("$.r.who.event_type", "string"),
        "at": ("$.at", "timestamp_ntz")}, "epochsecs")


add("S08_json_paths", _json_paths, "SELECT event_id, user_id, event_type AS kind, date_trunc('second', ts) AS at FROM events")


def _rejects(t):
    raw = t.events.select(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("kind"),
                          F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("value").cast("string"))).when(
                              F.col("event_type") == "view", "").otherwise(F.col("user_id").cast("string")).alias("user_id"))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("user_id", T.LongType())])
    good, bad = text.load_with_rejects(raw, schema, {"kind": 4})
    return good.withColumn("state", F.lit("good")).unionByName(bad.select(
        F.col("event_id").cast("bigint"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("bigint").alias("user_id"), F.lit("bad").alias("state")))


add("S09_rejects", _rejects,
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN substr(event_type, 1, 4) END AS kind, "
    "CASE WHEN event_type NOT IN ('error', 'view') THEN user_id END AS user_id, "
    "CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS state FROM events")


def _image(t):
    def n(c):
        return F.struct(F.col(c).cast("string").alias("n"))

    refer = F.struct(F.when(F.col("l_linestatus") == "F", F.col("l_partkey").cast("string")).otherwise(
        F.concat_ws("-", "l_partkey", "l_suppkey")).alias("s"))
    image = F.struct(n("l_orderkey").alias("did"), n("l_linenumber").alias("v"), F.struct((F.col("l_returnflag") == "R").alias("bool")).alias("r"),
                     refer.alias("rk"), F.struct(F.expr("cast(unix_seconds(cast(l_shipdate as timestamp)) as string)").alias("n")).alias("ca"),
                     F.struct(F.col("l_returnflag").alias("s")).alias("rt"),
                     F.struct(F.concat(F.lit('{"unit": {"id": "'), F.col("l_suppkey").cast("string"), F.lit('"}}')).alias("s")).alias("ext"))
    return changes.flatten_change_image(t.lineitem.select(F.lit("MODIFY").alias("event_name"), image.alias("newimage")), {
        "device_id": ("did.n", "bigint"), "version": ("v.n", "bigint"), "requested": ("r.bool", "boolean"),
        "campaign_id": ("rk.s", "try_int", 1), "created_at": ("ca.n", "epoch"), "kind": ("rt.s", "lower"),
        "unit_id": ("ext.s", "json", "$.unit.id")}, keep=["event_name"])


add("S10_change_image", _image,
    "SELECT 'MODIFY' AS event_name, l_orderkey AS device_id, CAST(l_linenumber AS BIGINT) AS version, l_returnflag = 'R' AS requested, "
    "CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS INTEGER) ELSE 1 END AS campaign_id, l_shipdate AS created_at, "
    "lower(l_returnflag) AS kind, CAST(l_suppkey AS VARCHAR) AS unit_id FROM lineitem")

COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
_RANGED = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CAST({n} AS INTEGER) AS range_no FROM orders"
_FIRST = "(SELECT min(o_orderkey) FROM orders)"
add("S11_dump", lambda t: extract.extract_table(extract.FrameReader(t.orders), COLS, key="o_orderkey", parts=7, number="range_no"),
    _RANGED.format(n=f"(o_orderkey - {_FIRST}) // (SELECT CAST(ceil((max(o_orderkey) + 1 - min(o_orderkey)) / 7.0) AS BIGINT) FROM orders)"))
add("S12_numeric_extract", lambda t: extract.extract_table(
    extract.FrameReader(t.orders), COLS, "numeric", "o_orderkey", step=2500, number="range_no"),
    _RANGED.format(n=f"(o_orderkey - {_FIRST}) // 2500"))
# The squared key is uneven: of eight ranges as wide, the first would hold over a third of the rows.
add("S12_balanced_extract", lambda t: extract.extract_table(
    extract.FrameReader(t.orders.withColumn("squared", F.col("o_orderkey") * F.col("o_orderkey"))), ["squared", *COLS], "numeric", "squared",
    parts=8, balanced=True), "SELECT o_orderkey * o_orderkey AS squared, o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
add("S13_timestamp_extract", lambda t: extract.extract_table(
    extract.FrameReader(t.orders), COLS, "timestamp", "o_orderdate", "2000-01-01 00:00:00", "2001-01-01 00:00:00", period="day", number="range_no"),
    _RANGED.format(n="date_sub('day', TIMESTAMP '2000-01-01', o_orderdate)")
    + " WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'")
add("S14_high_water_mark", lambda t: last_increment_value(t.orders, "o_orderdate").withColumn(
    "none", last_increment_value(t.orders.filter("o_orderkey < 0"), "o_orderkey").scalar()),
    "SELECT max(o_orderdate) AS last_value, CAST(NULL AS BIGINT) AS none FROM orders")


def _family(t):
    def one(kind, extra):
        rows = t.events.filter(F.col("event_type") == kind).select("event_id", "ts")
        return rows.withColumn(extra, F.lit(kind)) if extra else rows

    return partitions.expand_catalog(one, [{"alias": "v_log", "kind": "view", "extra": None},
                                           {"alias": "c_log", "kind": "click", "extra": "source"}])


add("S15_table_family", _family,
    "SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'v_log' ELSE 'c_log' END AS alias, nullif(event_type, 'view') AS source "
    "FROM events WHERE event_type IN ('view', 'click')")
