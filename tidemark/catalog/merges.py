"""Load modes (U) and deduplication (D)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog.base import add
from tidemark.functions.numbers import money
from tidemark.functions.times import ts
from tidemark.operators import dedup, merges

# Load modes: the target holds orders before 1999, the source those from 1998 on, with a higher price.
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate"]


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("price"), "o_orderdate")


def target(t):
    return _orders(t).filter(F.col("o_orderdate") < ts("1999-01-01 00:00:00"))


def source(t):
    rows = _orders(t).filter(F.col("o_orderdate") >= ts("1998-01-01 00:00:00"))
    return rows.withColumn("price", money(F.col("price") + 1))


LOADS = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(27,9)) AS p, o_orderdate FROM orders),
target AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(p AS DOUBLE) AS price, o_orderdate FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(p + 1 AS DOUBLE) AS price, o_orderdate FROM o WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""
KEEP_OLD = "SELECT * FROM target WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = target.o_orderkey)"

add("U01_replace", lambda t: merges.load(target(t), source(t), "replace"), f"WITH {LOADS} SELECT * FROM source")
add("U02_incremental", lambda t: merges.load(target(t), source(t), "incremental"),
    f"WITH {LOADS} SELECT * FROM target UNION ALL SELECT * FROM source")


def _null_keys(df):
    return df.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")))


add("U03_upsert", lambda t: merges.load(_null_keys(target(t)), _null_keys(source(t)), "upsert", ["o_orderkey"]),
    f"""WITH {LOADS}, a AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey) FROM target),
b AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey) FROM source)
SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = a.o_orderkey) UNION ALL SELECT * FROM b""")

# Line items repeat their key, so they serve as a change log.
LINE_KEYS = ["l_orderkey", "l_linenumber"]
TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_COLS = [*LINE_KEYS, "l_shipdate", *TIEBREAK]
NEWEST = [("l_shipdate", "desc"), *[(c, "desc") for c in TIEBREAK]]
BY_NEWEST = "l_shipdate DESC, " + ", ".join(f"{c} DESC" for c in TIEBREAK)
LINES = ", ".join(LINE_COLS)


def old_lines(t):
    return t.lineitem.select(*LINE_COLS).filter(F.col("l_shipdate") < ts("1998-01-01 00:00:00"))


def new_lines(t):
    return t.lineitem.select(*LINE_COLS).filter(F.col("l_shipdate") >= ts("1998-01-01 00:00:00"))


LINE_LOADS = f"""old AS (SELECT {LINES} FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
new AS (SELECT {LINES} FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
latest AS (SELECT {LINES} FROM new QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {BY_NEWEST}) = 1)"""
UNMATCHED = ("SELECT * FROM {t} o WHERE NOT EXISTS (SELECT 1 FROM latest n WHERE n.l_orderkey = o.l_orderkey "
             "AND n.l_linenumber = o.l_linenumber)")

add("U04_dedup_upsert", lambda t: merges.load(old_lines(t), new_lines(t), "dedup_upsert", LINE_KEYS, order=NEWEST),
    f"WITH {LINE_LOADS} {UNMATCHED.format(t='old')} UNION ALL SELECT * FROM latest")
add("U05_transform_reload", lambda t: merges.transform_reload(
    old_lines(t), new_lines(t), F.col("l_shipdate") >= ts("1997-06-01 00:00:00"), LINE_KEYS, NEWEST),
    f"WITH {LINE_LOADS}, kept AS (SELECT * FROM old WHERE NOT l_shipdate >= TIMESTAMP '1997-06-01') "
    f"{UNMATCHED.format(t='kept')} UNION ALL SELECT * FROM latest")
add("U06_replace_slot", lambda t: merges.replace_slot(target(t), source(t), F.col("o_orderdate") >= ts("1998-01-01 00:00:00")),
    f"WITH {LOADS} SELECT * FROM target WHERE NOT o_orderdate >= TIMESTAMP '1998-01-01' UNION ALL SELECT * FROM source")
add("U07_upsert_snapshot", lambda t: merges.upsert_snapshot(target(t), source(t), ["o_custkey"], "2001-09-01 00:00:00", "slot"),
    f"""WITH {LOADS} SELECT *, TIMESTAMP '2001-09-01' AS slot FROM target WHERE o_custkey NOT IN (SELECT o_custkey FROM source)
UNION ALL SELECT *, TIMESTAMP '2001-09-01' FROM source""")


def _property(t, df):
    """One row per customer, with the status as a second key that is sometimes NULL."""
    keyed = df.withColumn("status", F.nullif("o_orderstatus", F.lit("P"))).drop("o_orderstatus")
    return keyed


PROPERTY = """SELECT o_orderkey, o_custkey, price, o_orderdate, nullif(o_orderstatus, 'P') AS status FROM {t}"""
add("U08_merge_latest", lambda t: merges.merge_latest(
    dedup.one_per_key(_property(t, target(t)), ["o_custkey", "status"], [("o_orderdate", "desc"), "o_orderkey"]),
    _property(t, source(t)), ["o_custkey", "status"], [("o_orderdate", "desc"), "o_orderkey"]),
    f"""WITH {LOADS}, p AS ({PROPERTY.format(t='target')} QUALIFY row_number() OVER (PARTITION BY o_custkey, status ORDER BY o_orderdate DESC, o_orderkey) = 1),
n AS ({PROPERTY.format(t='source')} QUALIFY row_number() OVER (PARTITION BY o_custkey, status ORDER BY o_orderdate DESC, o_orderkey) = 1)
SELECT CASE WHEN n.o_custkey IS NULL AND n.status IS NULL THEN p.o_orderkey ELSE n.o_orderkey END AS o_orderkey,
 CASE WHEN n.o_custkey IS NULL AND n.status IS NULL THEN p.o_custkey ELSE n.o_custkey END AS o_custkey,
 CASE WHEN n.o_custkey IS NULL AND n.status IS NULL THEN p.price ELSE n.price END AS price,
 CASE WHEN n.o_custkey IS NULL AND n.status IS NULL THEN p.o_orderdate ELSE n.o_orderdate END AS o_orderdate,
 CASE WHEN n.o_custkey IS NULL AND n.status IS NULL THEN p.status ELSE n.status END AS status
FROM p FULL JOIN n ON p.o_custkey = n.o_custkey AND p.status = n.status""")
add("U09_merge_rank", lambda t: merges.merge_rank(target(t), source(t), "o_custkey", "o_orderdate"),
    f"""WITH {LOADS}, u AS (SELECT * FROM source UNION SELECT * FROM target)
SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC, price DESC) = 1""")
add("U10_rebuild_merge", lambda t: merges.rebuild_merge(target(t), _orders(t), "o_orderkey", 12000, ["o_orderkey"]),
    f"""WITH {LOADS} SELECT * FROM target WHERE NOT o_orderkey >= 12000 UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(p AS DOUBLE), o_orderdate FROM o WHERE o_orderkey >= 12000""")


def _query_load(t):
    totals = _orders(t).groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_at"))
    old = target(t).groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_at"))
    fresh = totals.filter(F.col("last_at") >= ts("1999-01-01 00:00:00"))
    return merges.query_load(fresh, old, "dedup_upsert", keys=["o_custkey"], order=[("last_at", "desc")])


add("U11_query_load", _query_load,
    f"""WITH {LOADS}, q AS (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_at FROM o GROUP BY 1 HAVING max(o_orderdate) >= TIMESTAMP '1999-01-01')
SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_at FROM target WHERE o_custkey NOT IN (SELECT o_custkey FROM q) GROUP BY 1
UNION ALL SELECT * FROM q""")

# Deduplication. A line lands some hours after its ship date; status order is A, N, R.
STATUS = ["A", "N", "R"]
REST = [c for c in TIEBREAK if c != "l_returnflag"]
WINDOW = {"start": datetime(1996, 1, 1), "end": datetime(2001, 1, 1), "scan_end": datetime(2001, 1, 8)}


def stream(t):
    landed = F.timestamp_add("HOUR", F.col("l_linenumber") * 24, F.col("l_shipdate"))
    return t.lineitem.select(*LINE_COLS, F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("updated_at"),
                             landed.alias("partition_timestamp"))


def _final(df):
    return df.select(*LINE_KEYS, "l_returnflag", "l_quantity", "updated_at", "partition_timestamp")


IN_WINDOW = """l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01'
 AND l_shipdate + l_linenumber * INTERVAL 24 HOUR >= TIMESTAMP '1996-01-01' - INTERVAL 1 HOUR
 AND l_shipdate + l_linenumber * INTERVAL 24 HOUR < TIMESTAMP '2001-01-08'"""
VERSION = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 0 END"
BY_REST = ", ".join(f"{c} DESC" for c in REST)
OUT = "l_orderkey, l_linenumber, l_returnflag, l_quantity, l_shipdate AS updated_at, l_shipdate AS partition_timestamp"

add("D01_dedup_status", lambda t: _final(dedup.compact_slot(
    stream(t), LINE_KEYS, "l_returnflag", WINDOW, ordered_values=STATUS, tiebreak=REST)),
    f"SELECT {OUT} FROM lineitem WHERE {IN_WINDOW} QUALIFY row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {VERSION} DESC, l_shipdate DESC, {BY_REST}) = 1")
add("D02_dedup_number", lambda t: _final(dedup.compact_slot(
    stream(t), LINE_KEYS, "l_quantity", WINDOW, tiebreak=TIEBREAK)),
    f"SELECT {OUT} FROM lineitem WHERE {IN_WINDOW} QUALIFY row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_shipdate DESC, "
    + ", ".join(f"{c} DESC" for c in TIEBREAK) + ") = 1")


def _delayed(t):
    from tidemark.operators.slots import dedup_window
    window = dedup_window(datetime(2001, 6, 1), datetime(2001, 6, 8), 31)
    return _final(dedup.compact_slot(stream(t), LINE_KEYS, "l_returnflag", window, ordered_values=STATUS, tiebreak=REST))


add("D03_delayed_compaction", _delayed,
    f"""SELECT {OUT} FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-05-01' AND l_shipdate < TIMESTAMP '2001-05-08'
 AND l_shipdate + l_linenumber * INTERVAL 24 HOUR < TIMESTAMP '2001-06-08' QUALIFY row_number() OVER
 (PARTITION BY l_orderkey, l_linenumber ORDER BY {VERSION} DESC, l_shipdate DESC, {BY_REST}) = 1""")


def _recent_plus(t):
    gold = dedup.compact_slot(stream(t), LINE_KEYS, "l_returnflag",
                              {"start": datetime(1995, 1, 1), "end": datetime(2001, 2, 1), "scan_end": datetime(2001, 3, 1)},
                              ordered_values=STATUS, tiebreak=REST)
    return _final(dedup.recent_plus_compacted(stream(t), gold, LINE_KEYS, "l_returnflag", "2000-06-01 00:00:00",
                                              "2002-01-01 00:00:00", ordered_values=STATUS))


add("D04_recent_plus_compacted", _recent_plus,
    f"""WITH gold AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-02-01'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {VERSION} DESC, l_shipdate DESC, {BY_REST}) = 1),
recent AS (SELECT DISTINCT * FROM (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01'
  QUALIFY rank() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {VERSION} DESC, l_shipdate DESC) = 1))
SELECT {OUT} FROM recent UNION ALL SELECT {OUT} FROM gold WHERE l_shipdate < TIMESTAMP '2000-06-01'""")
add("D05_latest_per_key", lambda t: dedup.latest_per_key(t.lineitem, LINE_KEYS, "l_shipdate", ["l_suppkey"]),
    """SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM (SELECT * FROM lineitem
 QUALIFY rank() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) = 1)""")


def _snapshots(t):
    return t.orders.select("o_orderkey", "o_totalprice", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("slot"))


def _pin(t):
    from tidemark.operators.slots import pin_snapshot
    return pin_snapshot(_snapshots(t), "2001-05-01 00:00:00", "orders_now", "slot")


def _switch(t):
    from tidemark.operators.slots import switch_if_nonempty
    return switch_if_nonempty(_snapshots(t), "2001-06-01 00:00:00", "orders_current", "slot")


SNAPSHOT = "SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS slot FROM orders WHERE date_trunc('month', o_orderdate) = "
add("D06_pinned_snapshot", _pin, SNAPSHOT + "TIMESTAMP '2001-05-01'")
add("D07_guarded_switch", _switch, SNAPSHOT + "TIMESTAMP '2001-06-01'")
add("D08_one_per_key", lambda t: dedup.one_per_key(t.lineitem, ["l_orderkey"], [*LINE_KEYS[1:], "l_shipdate", *TIEBREAK]).select(
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"),
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM lineitem QUALIFY row_number() OVER "
    "(PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, " + ", ".join(TIEBREAK) + ") = 1")
add("D09_distinct", lambda t: dedup.distinct(t.lineitem, ["l_orderkey", "l_linenumber"]),
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
