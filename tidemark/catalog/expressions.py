"""Projections (P), scalar functions (F), nested values (C) and function surface (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import ACTIONS, add
from tidemark.functions import nested, numbers, text, times
from tidemark.operators import aggregates
from tidemark.operators.joins import enrich_profiles

E = "event_id"
KST = "Asia/Seoul"

# Projections and predicates
add("P01_project", lambda t: t.events.select(
    F.col(E).alias("id"), F.col("user_id").cast("string").alias("viewer"), F.lit("log").alias("origin"),
    F.lit(None).cast("string").alias("allocation_id"), F.col("value").cast("decimal(18,9)").alias("sales")),
    "SELECT event_id AS id, CAST(user_id AS VARCHAR) AS viewer, 'log' AS origin, "
    "CAST(NULL AS VARCHAR) AS allocation_id, CAST(CAST(value AS DECIMAL(18,9)) AS DOUBLE) AS sales FROM events")
add("P02_try_cast", lambda t: t.orders.select(
    "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
    F.col("o_orderpriority").try_cast("int").alias("none")),
    "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, "
    "TRY_CAST(o_orderpriority AS INTEGER) AS none FROM orders")
add("P03_filter", lambda t: t.events.filter(
    (F.col("event_type") != "error") & F.col("props").isNotNull() & (F.col("props") != "")
    & ~((F.col("value") < 1) & (F.col("event_type") == "view"))).select(E, "value"),
    "SELECT event_id, value FROM events WHERE event_type <> 'error' AND props IS NOT NULL AND props <> '' "
    "AND NOT (value < 1 AND event_type = 'view')")
add("P04_in_list", lambda t: t.events.filter(
    F.col("event_type").isin("view", "click", "purchase") & ~F.col("user_id").isin(1, 2, 3)).select(E),
    "SELECT event_id FROM events WHERE event_type IN ('view', 'click', 'purchase') AND user_id NOT IN (1, 2, 3)")
add("P05_between", lambda t: t.orders.filter(
    F.col("o_orderdate").between(times.ts("1996-01-01 00:00:00"), times.ts("1997-01-01 00:00:00"))).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-01-01'")
add("P06_like", lambda t: t.part.filter(
    F.upper("p_name").like("%RED%") | F.col("p_type").like("ECON%Y")).select("p_partkey", "p_name"),
    "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE '%RED%' OR p_type LIKE 'ECON%Y'")


def account_type():
    """Neutral stand-in for an account classification: name patterns, then organisation, then type."""
    name = F.upper("unit_name")
    return numbers.classify([
        (name.like("%_1%") & (F.col("organization_id") == 1), "PARTNER_A"),
        (F.col("organization_id") == 2, "PARTNER_B"),
        (F.col("unit_id").isin(3, 8), "PARTNER_C"),
        (F.col("unit_type").like("AM%"), "REGIONAL"),
        (F.col("unit_type").isin("ASIA", "EUROPE"), "OFFERWALL")], "STANDARD")


ACCOUNT_SQL = """CASE
  WHEN upper(unit_name) LIKE '%_1%' AND organization_id = 1 THEN 'PARTNER_A'
  WHEN organization_id = 2 THEN 'PARTNER_B'
  WHEN unit_id IN (3, 8) THEN 'PARTNER_C'
  WHEN unit_type LIKE 'AM%' THEN 'REGIONAL'
  WHEN unit_type IN ('ASIA', 'EUROPE') THEN 'OFFERWALL'
  ELSE 'STANDARD' END"""

add("P07_classify", lambda t: t.actions.join(t.units, "unit_id").select(E, account_type().alias("account_type")),
    f"WITH {ACTIONS}, units AS (SELECT CAST(n_nationkey AS BIGINT) AS unit_id, n_name AS unit_name, r_name AS unit_type, "
    "n_regionkey AS organization_id FROM nation JOIN region ON n_regionkey = r_regionkey) "
    f"SELECT event_id, {ACCOUNT_SQL} AS account_type FROM actions JOIN units USING (unit_id)")


def demographics(t):
    """Sex and birth year spelled the way raw logs spell them."""
    raw = F.when(F.col("event_type") == "view", "m").when(F.col("event_type") == "click", "W").when(
        F.col("event_type") == "purchase", "x").when(F.col("event_type") == "signup", "M")
    return t.actions.withColumns({"sex": raw, "year_of_birth": (F.col("lineitem_id") * 3 + 1850).cast("int")})


DEMOGRAPHICS = f"""{ACTIONS}, raw AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'm' WHEN 'click' THEN 'W' WHEN 'purchase' THEN 'x'
                            WHEN 'signup' THEN 'M' END AS sex0,
         CAST(lineitem_id * 3 + 1850 AS INTEGER) AS yob0
  FROM actions), clean AS (
  SELECT *, CASE WHEN sex0 IN ('m', 'M') THEN 'M' WHEN sex0 IN ('f', 'F', 'W') THEN 'F' END AS sex,
         CASE WHEN yob0 BETWEEN 1900 AND 2024 THEN yob0 END AS year_of_birth
  FROM raw)"""

add("P08_clean_demographics", lambda t: numbers.clean_demographics(demographics(t), 2024).select(
    E, "sex", "year_of_birth", numbers.clean_age("lineitem_id").alias("age")),
    f"WITH {DEMOGRAPHICS} SELECT event_id, sex, year_of_birth, "
    "CASE WHEN lineitem_id > 0 AND lineitem_id <= 100 THEN lineitem_id END AS age FROM clean")
add("P09_null_handling", lambda t: t.customer.select(
    "c_custkey", F.when(F.col("c_acctbal") > 0, "credit").otherwise("debit").alias("side"),
    F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment")),
    "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'credit' ELSE 'debit' END AS side, "
    "coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment FROM customer")


def payload(t):
    return t.events.select(E, "ts", nested.payload_map({
        "user": "user_id", "kind": "event_type", "props": "props"}).alias("payload"))


add("P10_payload_columns", lambda t: nested.payload_columns(
    payload(t), {"user": "bigint", "kind": "string", "absent": "string"}).drop("payload", "ts"),
    'SELECT event_id, user_id AS "user", event_type AS kind, CAST(NULL AS VARCHAR) AS absent FROM events')
add("P11_alias_reuse", lambda t: t.lineitem.selectExpr(
    "l_orderkey", "l_linenumber", "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
    "CAST(price * CAST(1 - l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS net").filter("net > 50000"),
    "WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, "
    "CAST(1 - l_discount AS DECIMAL(4,2)) AS f FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS price, CAST(price * f AS DOUBLE) AS net "
    "FROM p WHERE price * f > 50000")
add("P12_time_parameters", lambda t: t.spark.sql(
    "SELECT event_type, count(*) AS n FROM {e} WHERE ts >= CAST(:start_time AS TIMESTAMP_NTZ) "
    "AND ts < CAST(:end_time AS TIMESTAMP_NTZ) GROUP BY event_type",
    args={"start_time": "2024-01-08 00:00:00", "end_time": "2024-01-15 00:00:00"}, e=t.events),
    "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' "
    "GROUP BY event_type")

# Scalar functions
add("F01_split_part", lambda t: t.pages.select(
    "page_id", text.split_part_or_null("url", "/", 3).alias("host"), text.split_part_or_null("url", "/", 9).alias("none")),
    "SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[9] AS none FROM pages")
add("F02_case_trim", lambda t: t.part.select(
    "p_partkey", F.upper("p_name").alias("u"), F.lower("p_type").alias("l"),
    F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("b")),
    "SELECT p_partkey, upper(p_name) AS u, lower(p_type) AS l, trim('  ' || p_brand || ' ') AS b FROM part")
add("F03_substring", lambda t: t.customer.select(
    "c_custkey", F.substring("c_name", 10, 4).alias("mid"), text.right("c_name", 9).alias("tail")),
    "SELECT c_custkey, substr(c_name, 10, 4) AS mid, right(c_name, 9) AS tail FROM customer")
add("F04_iso_timestamp", lambda t: t.events.select(
    E, times.iso_to_ts(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T"), F.date_format("ts", "HH:mm:ss"),
                                F.lit("Z"))).alias("at")),
    "SELECT event_id, date_trunc('second', ts) AS at FROM events")
add("F05_csv_record", lambda t: t.events.select(
    E, text.csv_record(F.nullif("event_type", F.lit("error")), "user_id", "props").alias("record")),
    "SELECT event_id, coalesce(nullif(event_type, 'error'), '') || ',' || user_id || ',' || props AS record FROM events")
add("F06_date_trunc", lambda t: t.events.select(
    E, *[times.trunc_ts("ts", u).alias(f"{u}_at") for u in ("hour", "day", "week", "month")]),
    "SELECT event_id, date_trunc('hour', ts) AS hour_at, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_at, "
    "CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_at, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_at FROM events")
add("F07_business_day", lambda t: t.events.select(
    E, times.business_day("ts").alias("kst_day"), times.business_day("ts", in_utc=True).alias("kst_day_utc"),
    times.convert_zone("ts", KST).alias("kst"), times.convert_zone("ts", "UTC", KST).alias("back")),
    "SELECT event_id, CAST(date_trunc('day', ts + INTERVAL 9 HOUR) AS TIMESTAMP) AS kst_day, "
    "CAST(date_trunc('day', ts + INTERVAL 9 HOUR) AS TIMESTAMP) - INTERVAL 9 HOUR AS kst_day_utc, "
    "ts + INTERVAL 9 HOUR AS kst, ts - INTERVAL 9 HOUR AS back FROM events")
add("F08_shift", lambda t: t.orders.select(
    "o_orderkey", times.shift_ts("o_orderdate", -2, "month").alias("m"), times.shift_ts("o_orderdate", -30, "minute").alias("h")),
    "SELECT o_orderkey, o_orderdate - INTERVAL 2 MONTH AS m, o_orderdate - INTERVAL 30 MINUTE AS h FROM orders")
add("F09_diff_complete", lambda t: t.events.select(
    E, *[times.diff_complete(u, "ts", times.ts("2024-01-31 00:00:00")).alias(u) for u in ("hour", "day", "millisecond")]),
    "SELECT event_id, " + ", ".join(f"date_sub('{u}', ts, TIMESTAMP '2024-01-31') AS {u}" for u in ("hour", "day", "millisecond"))
    + " FROM events")
add("F10_diff_boundaries", lambda t: t.events.select(
    E, *[times.diff_boundaries(u, "ts", times.ts("2024-01-31 00:00:00")).alias(u) for u in ("second", "hour")]),
    "SELECT event_id, " + ", ".join(f"date_diff('{u}', ts, TIMESTAMP '2024-01-31') AS {u}" for u in ("second", "hour"))
    + " FROM events")
add("F11_epoch", lambda t: t.events.select(
    E, times.epoch_to_ts(F.col(E) * 1000).alias("s"), times.epoch_to_ts(F.col(E), "ms", zero_null=True).alias("ms")),
    "SELECT event_id, make_timestamp(event_id * 1000 * 1000000) AS s, "
    "CASE WHEN event_id <> 0 THEN make_timestamp(event_id * 1000) END AS ms FROM events")
add("F12_parse_timestamp", lambda t: t.events.select(
    E, times.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss").alias("at"),
    times.parse_ts("event_type", "yyyy-MM-dd").alias("none")),
    "SELECT event_id, date_trunc('second', ts) AS at, CAST(NULL AS TIMESTAMP) AS none FROM events")
add("F13_year", lambda t: t.orders.select("o_orderkey", times.year("o_orderdate").alias("y")),
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
add("F14_round_extremes", lambda t: t.lineitem.select(
    "l_orderkey", "l_linenumber", F.round(numbers.money("l_extendedprice"), 1).alias("r"),
    F.greatest("l_discount", "l_tax", F.lit(None)).alias("g"), F.least("l_discount", "l_tax").alias("l")),
    "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(27,9)), 1) AS DOUBLE) AS r, "
    "greatest(l_discount, l_tax, NULL) AS g, least(l_discount, l_tax) AS l FROM lineitem")
# The checksum in SQL: fold the bytes, eight shifts each, with the reversed polynomial.
_SHIFT = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
_FOLD = "x"
for _ in range(8):
    _FOLD = f"list_transform([{_FOLD}], lambda x: {_SHIFT})[1]"
add("F15_hash_bucket", lambda t: t.customer.select("c_custkey", text.hash_bucket("c_name").alias("crc")),
    "SELECT c_custkey, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c_name, ''), lambda c: ascii(c)::BIGINT)), "
    f"lambda a, b: list_transform([xor(a, b)], lambda x: {_FOLD})[1]), 4294967295) % 100 AS INTEGER) AS crc FROM customer"),


def _random(t):
    """All numbers lie in [0, 1), one seed repeats them, another does not, and the mean is near a half."""
    r = t.events.select(F.rand(7).alias("a"), F.rand(7).alias("b"), F.rand(8).alias("c"))
    n = F.count("*")
    return r.agg(n.alias("n"), F.count_if((F.col("a") >= 0) & (F.col("a") < 1)).alias("in_range"), F.count_if(F.col("a") == F.col("b")).alias("same"),
                 (F.count_if(F.col("a") == F.col("c")) * 100 < n).alias("differs"),
                 (F.abs(F.avg("a") - 0.5) < F.lit(2) / F.sqrt(n)).alias("mean_ok"))


add("F16_random", _random,
    "SELECT count(*) AS n, count(*) AS in_range, count(*) AS same, TRUE AS differs, TRUE AS mean_ok FROM events")
add("F17_url_parameter", lambda t: t.pages.select("page_id", text.url_param("url", "page").alias("page"),
                                                  text.url_param("url", "ref").alias("ref")),
    "SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, "
    "nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
add("F18_casts", lambda t: t.lineitem.select(
    "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("s"), numbers.money("l_extendedprice").alias("d"),
    F.col("l_quantity").cast("bigint").alias("q"), F.col("l_linenumber").cast("double").alias("f")),
    "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS s, "
    "CAST(CAST(l_extendedprice AS DECIMAL(27,9)) AS DOUBLE) AS d, CAST(l_quantity AS BIGINT) AS q, "
    "CAST(l_linenumber AS DOUBLE) AS f FROM lineitem")
add("F19_since_run_time", lambda t: t.orders.filter(
    F.col("o_orderdate") >= times.since("2001-08-02 00:00:00", 1, "month")).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-02' - INTERVAL 1 MONTH")

# Nested values
add("C01_explode_list", lambda t: nested.explode_list(t.part, "p_name", "word", " ").select("p_partkey", "word"),
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
add("C02_explode_identities", lambda t: nested.explode_identities(
    t.actions, {"IFA": "ifa", "CLICK": F.when(F.col("event_type") == "click", F.col(E)), "EMPTY": F.lit("")}).select(
    E, "uid_key", "uid_value"),
    "SELECT event_id, 'IFA' AS uid_key, CAST(user_id AS VARCHAR) AS uid_value FROM events UNION ALL "
    "SELECT event_id, 'CLICK', CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'click'")
add("C03_payload_map", lambda t: payload(t).select(
    E, F.size("payload").alias("n"), F.col("payload")["kind"].alias("kind"), F.col("payload")["user"].alias("u")),
    "SELECT event_id, 3 AS n, event_type AS kind, CAST(user_id AS VARCHAR) AS u FROM events")


def cards(t):
    """Events with a JSON attribute that lists cards, or broken text for errors."""
    k = F.col("lineitem_id")
    body = F.concat(F.lit('{"exposure_0": "1", "exposure_'), (k + 1).cast("string"), F.lit('": "1", "session_id": "'),
                    F.col(E).cast("string"), F.lit('", "unit": "x"}'))
    return t.actions.withColumn("attributes", F.when(F.col("event_type") == "error", "{broken").otherwise(body))


CARDS = f"""{ACTIONS}, cards AS (
  SELECT *, CASE WHEN event_type <> 'error' THEN lineitem_id + 1 END AS top FROM actions)"""

add("C04_key_numbers", lambda t: cards(t).withColumn("m", nested.try_json_map("attributes")).filter(
    F.col("m").isNotNull()).select(E, nested.key_numbers("m", "exposure_").alias("c")).select(
    E, F.size("c").alias("n"), F.array_max(F.transform("c", lambda x: x.cast("int"))).alias("highest")),
    f"WITH {CARDS} SELECT event_id, 2 AS n, CAST(top AS INTEGER) AS highest FROM cards WHERE top IS NOT NULL")
add("C05_json_value", lambda t: t.events.select(E, nested.json_value("props", "$.k").alias("k"),
                                                nested.json_value("props", "$.none").alias("none")),
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS none FROM events")
add("C06_json_nested", lambda t: t.events.select(
    E, nested.json_value(F.concat(F.lit('{"unit": {"id": '), F.col("user_id").cast("string"), F.lit("}}")),
                         "$.unit.id").alias("unit_id")),
    "SELECT event_id, CAST(user_id AS VARCHAR) AS unit_id FROM events")


def _json_maps(t):
    """Flat objects, some with values that begin like a nested one; views are nested, errors are cut off."""
    flat = F.to_json(F.struct(F.concat(F.lit("[x] {"), "event_type").alias("a"), F.concat(F.lit("{"), F.col(E).cast("string")).alias("b")))
    deep = F.to_json(F.struct(F.struct(F.col(E).alias("n")).alias("a")))
    line = F.when(F.col("event_type") == "view", deep).when(F.col("event_type") == "error", F.expr("left(flat, length(flat) - 1)")).otherwise(F.col("flat"))
    m = t.events.withColumn("flat", flat).select(E, nested.try_json_map(line).alias("m"))
    return m.select(E, F.col("m").isNotNull().alias("is_flat"), F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"))


add("C07_try_json_map", _json_maps,
    "SELECT event_id, event_type NOT IN ('view', 'error') AS is_flat, CASE WHEN event_type NOT IN ('view', 'error') THEN '[x] {' || event_type END AS a, "
    "CASE WHEN event_type NOT IN ('view', 'error') THEN '{' || event_id END AS b FROM events")
add("C08_array_size", lambda t: t.documents.select("doc_id", F.size(F.split("text", " ")).alias("n")),
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n FROM documents")
add("C09_array_join", lambda t: t.part.select("p_partkey", F.array_join(F.split("p_name", " "), "|").alias("j")),
    "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS j FROM part")
add("C10_shred_json", lambda t: nested.shred_json(
    cards(t).select(E, "attributes").unionByName(t.events.select(E, F.col("props").alias("attributes"))),
    "attributes", defaults={"log_type": "general"}).select(E, "k", "session_id", "log_type"),
    f"WITH {CARDS} SELECT event_id, CAST(NULL AS BIGINT) AS k, CAST(event_id AS VARCHAR) AS session_id, 'general' AS log_type "
    "FROM cards WHERE top IS NOT NULL UNION ALL "
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT), NULL, 'general' FROM events")

# Function surface
add("N01_is_json", lambda t: cards(t).select(E, nested.is_json("attributes").alias("ok")),
    "SELECT event_id, event_type <> 'error' AS ok FROM events")


def _profiles(t):
    """Identity table: every customer by account, and every other one also by cookie."""
    key = F.col("c_custkey").cast("string")
    account = t.customer.select(F.lit("account_id").alias("uid_key"), key.alias("uid_value"),
                                (F.col("c_custkey") + 5000).alias("profile_id"))
    cookie = t.customer.filter(F.col("c_acctbal") > 0).select(
        F.lit("cookie_id"), F.concat(F.lit("c"), key), (F.col("c_custkey") + 900000).alias("profile_id"))
    return account.union(cookie)


def _enriched(t):
    user = F.col("user_id").cast("string")
    batch = t.events.select(E, "event_type", nested.payload_map({
        "cookie_id": F.when(F.col("event_type") != "view", F.concat(F.lit("c"), user)),
        "account_id": user}).alias("payload"))
    return enrich_profiles(batch, _profiles(t), ["cookie_id", "account_id"], [E, "event_type", "cookie_id", "profile_id"])


add("N02_enrich_profiles", _enriched,
    "SELECT event_id, event_type, CASE WHEN event_type <> 'view' THEN 'c' || user_id ELSE '' END AS cookie_id, "
    "CASE WHEN event_type <> 'view' AND c_acctbal > 0 THEN c_custkey + 900000 ELSE c_custkey + 5000 END AS profile_id "
    "FROM events LEFT JOIN customer ON c_custkey = user_id")


def _creatives(t):
    """Each part lists the words of its name and as many links."""
    words = F.split("p_name", " ")
    listed = t.part.select("p_partkey", F.array_join(words, ",").alias("names"),
                           F.array_join(F.transform(words, lambda w, i: F.concat(F.col("p_partkey").cast("string"), F.lit("/"), i.cast("string"))), ",").alias("urls"))
    zipped = listed.withColumn("creative", F.explode(nested.zip_lists("names", "urls")))
    return zipped.select("p_partkey", "creative.name", "creative.image_url")


add("N03_zip_lists", _creatives,
    "SELECT p_partkey, name, p_partkey || '/' || (i - 1) AS image_url FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name, "
    "generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)")
