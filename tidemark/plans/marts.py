"""Statistics marts, logs and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.nested import json_value, key_numbers, shred_json, try_json_map
from tidemark.functions.text import split_part_or_null, try_whole
from tidemark.functions.times import NTZ, business_day, diff_complete, epoch_to_ts, trunc_ts
from tidemark.operators.aggregates import merge_measures
from tidemark.operators.joins import enrich, fallback_join, union_all

FILL_KINDS = ["direct_normal", "direct_backfill", "adnetwork", "sdk", "rtb", "js"]


def fill_stats(requests: DataFrame, units: DataFrame, kinds: list[str] = FILL_KINDS,
               time: str = "partition_timestamp") -> DataFrame:
    """Requests per hour and unit against the target fill, the request's own or the unit's.

    Requests are (unit_id, target_fill, filled_request, <kinds>); units (id, name, unit_type, target_fill).
    """
    u = units.select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name"), "unit_type",
                     F.col("target_fill").alias("__target"))
    rows = requests.join(u, "unit_id").withColumn("target_fill", F.coalesce("target_fill", "__target"))
    t, f = F.col("target_fill"), F.col("filled_request")

    def ones(c: Column) -> Column:
        return F.count_if(c)

    return rows.groupBy(trunc_ts(time, "hour").alias("data_at"), "unit_type", "unit_id", "unit_name", "target_fill").agg(
        F.count("filled_request").alias("request_count"),
        ones(t > f).alias("underfilled_request_count"), ones(t < f).alias("overfilled_request_count"),
        ones(t <= f).alias("sufficiently_filled_request_count"), ones(t == f).alias("on_point_filled_request_count"),
        ones(f > 0).alias("filled_request_count"), F.sum(t).alias("request_volume"), F.sum(f).alias("fill_volume"),
        F.sum(F.when(t < f, f - t).otherwise(0)).alias("overfill_volume"),
        F.sum(F.when(t > f, t - f).otherwise(0)).alias("underfill_volume"),
        *[F.sum(k).alias(f"{k}_fill_volume") for k in kinds])


def roll_up(stats: DataFrame, keys: list[str], time: str = "data_at") -> DataFrame:
    """Hourly statistics summed per local day."""
    measures = [c for c in stats.columns if c.endswith(("_count", "_volume"))]
    return stats.groupBy(business_day(time).alias("kst_at"), *keys).agg(*[F.sum(m).alias(m) for m in measures])


def fill_counts(fills: DataFrame, dims: list[str], time: str = "created_at") -> DataFrame:
    return fills.filter("filled").groupBy(trunc_ts(time, "hour").alias("data_at"), *dims).agg(
        F.count("*").alias("fill_count"))


def dau_engagement(dau: DataFrame, measures: dict[str, tuple[DataFrame, Column]], points: DataFrame,
                   devices: DataFrame | None = None) -> DataFrame:
    """Daily actives with each user's measures (0 without any) and points.

    ``measures`` is name -> (log with ifa, value to sum); the logs meet in one aggregate per user.
    Points are (device_id, amount, base_reward); devices, unique by device_id, give the ifa.
    """
    per_user = merge_measures([(df, {n: v}) for n, (df, v) in measures.items()], ["ifa"])
    sums = points.groupBy("device_id").agg(F.sum("amount").alias("reward"), F.sum("base_reward").alias("base_reward"))
    rows = dau if devices is None else dau.join(devices, "device_id", "left")
    joined = rows.join(per_user, "ifa", "left").join(sums, "device_id", "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in [*measures, "reward", "base_reward"]})


def ad_metric_mart(stats: DataFrame, dims: list[tuple], required: list[tuple], flag: Column | None,
                   keys: list[str], measures: list[str], time: str = "data_at") -> DataFrame:
    """Daily statistics with every dimension's attributes and a test-unit flag.

    Statistics are summed to their own keys first; dimensions come as for ``enrich``. ``required``
    dimensions (dim, dim key, fact key, values) drop rows without a match.
    """
    summed = stats.groupBy(business_day(time).alias("kst_at"), *keys).agg(*[F.sum(m).alias(m) for m in measures])
    rows = enrich(summed, dims)
    for dim, dim_key, fact_key, values in required:
        small = dim.select(F.col(dim_key).alias("__k"), *[F.col(c).alias(n) for n, c in values.items()])
        rows = rows.join(small, F.col(fact_key) == F.col("__k")).drop("__k")
    return rows if flag is None else rows.withColumn("is_test", flag)


def test_unit(name: Column, unit_id: Column, first_live: int, app_is_test: Column, live: list[int] = ()) -> Column:
    """Units that look like test units by name, low id or app flag, except listed live ones."""
    upper = F.upper(name)
    looks = F.lit(False)
    for word in ("TEST", "QA", "DEV", "STG"):
        looks = looks | upper.like(f"%{word}%")
    looks = looks | (unit_id < first_live) | app_is_test
    listed = unit_id.isin(*live) if live else F.lit(False)
    return F.when(listed, False).otherwise(F.coalesce(looks, F.lit(False)))


def unit_lineitem_stats(stats: DataFrame, units: DataFrame, lineitems: DataFrame, users: DataFrame,
                        measures: list[str]) -> DataFrame:
    """Creative statistics summed per unit, line item and hour, with names and owner."""
    summed = stats.groupBy("lineitem_id", "unit_id", "data_at").agg(*[F.sum(m).alias(m) for m in measures])
    return enrich(summed, [
        (units, "id", "unit_id", {"unit_name": "name", "unit_currency": "currency"}),
        (lineitems, "id", "lineitem_id", {"lineitem_name": "item_name", "revenue_type": "revenue_type",
                                          "lineitem_owner_id": "owner_id"}),
        (users, "id", "lineitem_owner_id", {"lineitem_owner_name": "name"})])


def map_network_reports(reports: DataFrame, configs: DataFrame) -> DataFrame:
    """Network reports matched to line items by network, app and placement; country exactly, else 'ZZ'.

    Configs without app and placement are not used; the first target unit is the unit.
    """
    usable = configs.filter(~((F.col("app_id") == "") & (F.col("placement_id") == "")))
    usable = usable.withColumn("unit_id", try_whole(split_part_or_null("target_unit", ",", 1))).drop("target_unit")
    return fallback_join(reports, usable, ["adnetwork_id", "app_id", "placement_id"], "country", "ZZ")


def export_activity(ad_events: list[tuple[str, DataFrame]], content_events: list[tuple[str, DataFrame]],
                    units: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Ad and content events of the partner's units in one shape, content with its campaign."""
    mine = units.select("unit_id").distinct()
    common = ["ifa", "country", "year_of_birth", "sex", "created_at"]

    def rows(sources: list, id_col: str, other: str) -> DataFrame:
        parts = [df.join(mine, "unit_id", "left_semi").select(
            F.col(id_col).cast("bigint").alias(id_col), F.lit(None).cast("bigint").alias(other),
            F.lit(n).alias("event"), *common) for n, df in sources]
        return union_all(*parts)

    none = F.lit(None)
    ads = rows(ad_events, "lineitem_id", "content_id").withColumns({
        "content_provider_id": none.cast("bigint"), "content_channel_id": none.cast("bigint"),
        "content_url": none.cast("string")})
    content = rows(content_events, "content_id", "lineitem_id").join(
        campaigns.select(F.col("id").alias("content_id"), F.col("provider_id").alias("content_provider_id"),
                         F.col("channel_id").alias("content_channel_id"), F.col("click_url").alias("content_url")),
        "content_id")
    return ads.unionByName(content).withColumnsRenamed({"ifa": "idfa", "sex": "gender"})


def card_sessions(events: DataFrame, name: str, col: str = "attributes", prefix: str = "exposure_") -> DataFrame:
    """Cards seen in a session, from keys ``exposure_<n>``: how many, how many skipped, the last one."""
    rows = events.filter(F.col("name") == name).withColumn("__m", try_json_map(col)).filter(F.col("__m").isNotNull())
    cards = key_numbers("__m", prefix)
    highest = F.array_max(F.transform(cards, lambda c: c.cast("int")))
    listed = rows.withColumns({"watched_cards": cards, "__max": highest})
    n = F.size("watched_cards")
    return listed.withColumns({
        "report_ratio": json_value(col, "$.report_ratio"),
        **{k: F.coalesce(json_value(col, f"$.{k}"), F.lit("0")) for k in ("session_id", "duration")},
        "watched_count": n, "skipped_count": F.coalesce(F.col("__max") - n + 1, F.lit(0)),
        "last_watched_card": F.coalesce(F.col("__max") + 1, F.lit(0))}).drop("__m", "__max")


def feed_sessions(events: DataFrame, name: str, col: str = "attributes") -> DataFrame:
    return events.filter(F.col("name") == name).withColumns({
        "report_ratio": json_value(col, "$.report_ratio"),
        **{k: F.coalesce(json_value(col, f"$.{k}"), F.lit("0")) for k in ("session_id", "duration")}})


def latency_offsets(requests: DataFrame, request: str, steps: list[str]) -> DataFrame:
    """Milliseconds from the request to each step; both are epoch milliseconds, 0 meaning never."""
    at = requests.withColumns({"requested_at": epoch_to_ts(request, "ms", zero_null=True),
                               **{s: epoch_to_ts(s, "ms", zero_null=True) for s in steps}})
    return at.withColumns({s: diff_complete("millisecond", "requested_at", s) for s in steps}).drop(request)


def installed_apps(devices: DataFrame, id_col: str = "device_id", apps: str = "package_names",
                   time: str = "partition_timestamp") -> DataFrame:
    """One row per device and package; repeated reports count once."""
    rows = devices.select(id_col, split_part_or_null(id_col, "ifa:", 2).alias("ifa"), apps,
                          F.col(time).alias("updated_at")).distinct()
    return rows.withColumn("package_name", F.explode(F.split(apps, ","))).drop(apps)


def shred_service_logs(df: DataFrame, schema: str | None = None) -> DataFrame:
    """JSON service logs as columns with service, hour folders and log type ('general' by default)."""
    t = F.col("time").cast(NTZ)
    parts = {n: F.date_format(t, p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    base = df.select("log", F.col("kubernetes")["namespace_name"].alias("service"),
                     *[c.alias(n) for n, c in parts.items()], t.alias("log_timestamp"))
    out = shred_json(base, "log", schema)
    return out if "log_type" in out.columns else out.withColumn("log_type", F.lit("general"))


def video_event_counts(events: DataFrame, keys: list[str], time: str) -> DataFrame:
    return events.groupBy(trunc_ts(time, "hour").alias("data_at"), *keys).agg(F.count("*").alias("event_count"))
