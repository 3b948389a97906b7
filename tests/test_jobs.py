"""Jobs on small fixtures with known answers."""

from datetime import datetime as D
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregates, quality
from tidemark.plans import labels, marts, money, popularity, reach


def one(spark, v):
    return spark.createDataFrame([(v,)], "x double")


def test_linear_checks(spark):
    ten = quality.check_linear("c", one(spark, 1.0), "eq", 0, one(spark, 2.0), 10, -5).first()
    assert (ten.lhs, ten.passed) == (0.0, True)
    assert quality.check_linear("c", one(spark, 1.0), "eq", 1).first().passed
    assert not quality.check_linear("c", one(spark, 1.0), "lt", 1).first().passed
    assert quality.check_linear("c", one(spark, None), "eq", 0).first().passed
    with pytest.raises(Exception):
        quality.check_linear("c", one(spark, None), "eq", 0, null_as_zero=False).first()
    with pytest.raises(Exception):
        quality.check_linear("c", one(spark, 1.0).union(one(spark, 2.0)), "eq", 0).first()
    with pytest.raises(ValueError):
        quality.check_linear("c", one(spark, 1.0), "ne", 0)
    with pytest.raises(ValueError):
        quality.require(quality.check_linear("c", one(spark, 1.0), "lt", 1))


def test_dedup_check_counts_lost_and_doubled(frame):
    src = frame("k int", (1,), (2,), (3,), (3,))
    assert quality.check_dedup("c", src, frame("k int", (1,), (2,), (3,)), ["k"]).first().passed
    assert quality.check_dedup("c", src, frame("k int", (1,), (3,), (3,)), ["k"]).first().lhs == 3.0


@pytest.mark.parametrize("size", [10, 200_000])
def test_lists_have_one_shape_at_every_size(spark, size):
    hot = spark.range(size).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(spark.createDataFrame([("none", None), ("none", None), ("one", 7), ("one", None)], "k string, v bigint"))
    got = aggregates.item_list(df, ["k"], "v")
    assert got.columns == ["k", "position", "item", "n"]
    found = got.filter("k <> 'hot'").collect()
    assert sorted((r.k, r.position, r.item, r.n) for r in found if r.k == "one") == [("one", 1, 7, 1)]
    assert [(r.position, r.item, r.n) for r in found if r.k == "none"] == [(None, None, 0)]
    large = got.filter("k = 'hot'")
    assert large.filter(F.col("position") == F.col("item") + 1).count() == size and large.select("n").distinct().collect()[0].n == size


def test_lists_of_whole_groups_lose_nothing(spark):
    from tidemark.catalog import load_all
    df = spark.range(120).select(F.lit(1).alias("k"), "id", F.format_string("n%03d", "id").alias("a"), F.when(F.col("id") != 7, F.lit("u")).alias("b"))
    got = aggregates.item_lists(df, ["k"], {"name": "a", "url": "b"}, ["id"]).orderBy("position").collect()
    assert [(r.position, r.name, r.url, r.n) for r in got] == [(i + 1, f"n{i:03d}", None if i == 7 else "u", 120) for i in range(120)]
    folder = "/root/testdata/sf0.01"
    assert load_all()["A08_whole_lists"](spark, folder).count() == spark.read.parquet(f"{folder}/part.parquet").count()


def test_extended_budgets_keep_every_distinct_value(spark, frame):
    groups = frame("id int, name string, sales_manager_id int, owner_id int, budget decimal(27,9)", (1, "g", 1, 1, Decimal(5)))
    extra = frame("ad_group_id int, extra_budget_type string, budget decimal(27,9)", (1, "C", Decimal(2)))
    items = spark.range(300).select(F.lit(1).alias("ad_group_id"), F.format_string("t%03d", F.col("id") % 150).alias("revenue_type"), F.lit("KRW").alias("currency"))
    got = money.extended_budgets(groups, extra, items, frame("id int, name string", (1, "p"))).first()
    assert got.revenue_types == ",".join(f"t{i:03d}" for i in range(150)) and got.currencies == "KRW"


def test_baskets_of_text_ids(spark):
    from tidemark.plans.labels import baskets
    bought = [(f"u{u}", f"p{p}") for u in range(6) for p in range(u + 1)]
    lines = spark.createDataFrame(bought, "viewer_id string, product_id string").withColumns({
        "is_occurred": F.lit(True), "user_action": F.lit("purchase_from_view_detail"), "product_feed_id": F.lit(1),
        "occurred_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")})
    got = baskets(lines, "2024-01-02 00:00:00").collect()
    # counts 6 5 4 3 2 1: the rarest product goes
    assert {(r.viewer_id, r.product_id) for r in got} == {b for b in bought if b[1] != "p5"}


def test_many_expiries_of_one_person(spark):
    """2,000 expiries of one person: each (expiry, month) is made once."""
    n = 2000
    at = lambda c: F.timestamp_add("DAY", c.cast("int"), F.lit("2010-01-01").cast("timestamp_ntz"))
    e = spark.range(n).select(F.lit(1).alias("person_id"), (F.col("id") * 2 + 1).alias("version"), at(F.col("id") * 2 + 1).alias("expire_date"),
                              F.lit(5).cast("decimal(27,9)").alias("amount"))
    ledger = spark.range(n).select(F.lit(1).alias("person_id"), (F.col("id") * 2).alias("version"), at(F.col("id") * 2).alias("created_at"),
                                   F.lit(10).cast("decimal(27,9)").alias("collected"))
    got = money.expire_points(e, ledger)
    totals = got.groupBy("expire_date").agg(F.sum("points_withdraw").alias("s")).agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).first()
    assert (totals.n, int(totals.lo), int(totals.hi)) == (n, 5, 5)


def test_overspend_is_none_partial_or_whole(frame):
    prev = frame("ad_group_id int, created_at timestamp_ntz, sales decimal(27,9), o int", (1, D(2024, 1, 1), Decimal(80), 0))
    spend = frame("ad_group_id int, unit_id int, created_at timestamp_ntz, sales decimal(27,9), o int",
                  (1, 7, D(2024, 1, 1, 1), Decimal(10), 1), (1, 8, D(2024, 1, 1, 2), Decimal(30), 2), (1, 7, D(2024, 1, 1, 3), Decimal(5), 3))
    budgets = frame("id int, total_budget decimal(27,9)", (1, Decimal(100)))
    got = money.overspend_attribution(prev, spend, budgets, ["created_at", "o"])
    assert {(r.unit_id, int(r.cumulative_spent), int(r.cumulative_overspent)) for r in got.collect()} == {(None, 80, 0), (7, 15, 5), (8, 30, 20)}


def test_points_expire_from_the_newest_month(frame):
    e = frame("person_id int, version int, expire_date timestamp_ntz, amount decimal(27,9)", (1, 10, D(2024, 4, 1), Decimal(50)))
    ledger = frame("person_id int, version int, created_at timestamp_ntz, collected decimal(27,9)",
                   (1, 1, D(2024, 1, 5), Decimal(100)), (1, 2, D(2024, 2, 5), Decimal(20)), (1, 3, D(2024, 3, 5), Decimal(15)),
                   (1, 3, D(2024, 3, 6), Decimal(5)), (1, 10, D(2024, 3, 7), Decimal(999)), (2, 1, D(2024, 1, 1), Decimal(1)))
    got = money.expire_points(e, ledger)
    assert [(r.collected_date, int(r.points_withdraw)) for r in got.orderBy("collected_date").collect()] == [
        (D(2024, 1, 1), 10), (D(2024, 2, 1), 20), (D(2024, 3, 1), 20)]


def test_click_label_needs_an_impression(frame):
    cols = "viewer_id string, allocation_id string, lineitem_id int, unit_id int, product_id int, time timestamp_ntz"
    t = D(2024, 1, 1)
    imps = frame(cols, ("v", "a", 1, 1, 5, t), ("v", "a", 1, 1, 5, t), ("v", "b", 1, 1, None, t))
    clicks = frame(cols, ("v", "a", 1, 1, 5, D(2024, 1, 2)), ("v", "c", 1, 1, 5, t))
    items = frame("id int, action_point int, landing_point int, revenue_type string", (1, 0, 3, "cpc"))
    got = labels.click_labels(imps, clicks, frame("id int, product_feed_id int", (5, 9)), items)
    assert rows(got, "allocation_id", "is_occurred", "reward_condition", "product_feed_id") == [
        ("a", True, "click", 9), ("b", False, "click", None)]


def test_basket_leaves_out_only_the_rarest_product(frame):
    df = frame("viewer_id int, product_id int", (1, 10), (2, 10), (1, 10), (1, 20), (2, 30)).withColumns({
        "product_feed_id": F.lit(5), "is_occurred": F.lit(True), "user_action": F.lit("purchase_from_view_detail"),
        "occurred_at": F.lit("2024-01-05").cast("timestamp_ntz")})
    got = labels.baskets(df, "2024-01-06", feed=5)
    assert rows(got, "viewer_id", "position", "product_id", "product_count") == [(1, 1, 10, 2), (1, 2, 20, 2), (2, 1, 10, 1)]


def test_recent_products_keep_repeats(frame):
    t = D(2024, 1, 5)
    df = frame("viewer_id int, product_feed_id int, product_id int, event_type string, event_time timestamp_ntz",
               (1, 1, 7, "p", t), (1, 1, 7, "p", t), (1, 1, 8, "v", t), (1, 1, 9, "p", D(2023, 1, 1)))
    got = popularity.recent_products(df, {"view": "v", "buy": "p"}, "2024-01-06")
    assert rows(got, "action", "position", "product_id", "times", "action_count") == [("buy", 1, 7, 2, 2), ("view", 1, 8, 1, 1)]


def test_reach_without_group_is_left_out(frame):
    events = frame("viewer_id string, lineitem_id int, time timestamp_ntz", ("a", 1, D(2024, 1, 1, 14, 59)), ("a", 1, D(2024, 1, 1, 15)),
                   ("b", 1, D(2024, 1, 1, 15)), ("c", 2, D(2024, 1, 1, 15)))
    dim = frame("id int, ad_group_id int", (1, 5), (2, None))
    got = reach.unique_reach(events, dim, "day")
    assert rows(got) == [(D(2023, 12, 31, 15), 5, 1), (D(2024, 1, 1, 15), 5, 2)]


def test_cards(frame):
    df = frame("name string, attributes string", ("s", '{"exposure_0": "1", "exposure_4": "1"}'), ("s", "{}"), ("s", "{x"), ("t", "{}"))
    got = marts.card_sessions(df, "s")
    assert rows(got, "watched_count", "skipped_count", "last_watched_card", "session_id") == [(0, 0, 0, "0"), (2, 3, 5, "0")]


def test_network_reports_match_in_the_join_alone(frame):
    reports = frame("report_id int, adnetwork_id int, app_id string, placement_id string, country string",
                    *[(1, 1, "a", None, "KR"), (2, 1, "a", None, "US"), (3, 1, None, None, "KR")] * 2)
    configs = frame("adnetwork_id int, app_id string, placement_id string, country string, target_unit string, lineitem_id int",
                    *[(1, "a", "", "KR", "5,6", 7), (1, "a", None, "ZZ", "8", 9), (1, "", "", "KR", "1", 1)] * 2)
    got = marts.map_network_reports(reports, configs)
    assert rows(got, "report_id", "unit_id", "lineitem_id") == [(1, 5, 7), (2, 8, 9)]
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_page_views_with_repeated_rows_keep_no_second_set_of_pairs(frame):
    imps = frame("unit_id long, initial_allocation_id long", *[(1, 1), (1, 1), (1, 2), (2, 1), (1, None), (None, 1), (1, 9)] * 2)
    allocs = frame("request_id long, created_at timestamp_ntz", *[(1, D(2024, 1, 1)), (1, D(2024, 1, 1, 1)), (1, D(2024, 1, 3)), (2, None)] * 2)
    units = frame("unit_id long, unit_name string, unit_type string", *[(1, "a", "x"), (1, "b", None), (2, "c", "x")] * 2)
    got = reach.page_views(imps, allocs, units)
    day, later = D(2024, 1, 1), D(2024, 1, 3)
    assert rows(got) == sorted([(d, u, n, k, 1) for d in (day, later, None) for u, n, k in ((1, "a", "x"), (1, "b", None), (2, "c", "x")) if d or u == 1],
                               key=lambda r: tuple((v is not None, str(v)) for v in r))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan and plan.count("RepartitionByExpression [initial_allocation_id") == 2
