"""Rewards, budgets, payouts and settlement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numbers import int_div, money, safe_ratio
from tidemark.functions.times import business_day, trunc_ts, ts
from tidemark.operators.aggregates import conditional_agg, joined_distinct, merge_measures
from tidemark.operators.joins import attribute, enrich, lookback_join, offset_join, union_all
from tidemark.operators.ordered import running_sum

OFFSET = 10**9


def reward_stats(points: DataFrame, lineitems: DataFrame, campaigns: DataFrame,
                 units: DataFrame | None = None) -> DataFrame:
    """Rewards per hour, unit and campaign with the campaign's owner and name.

    Points are (created_at, unit_id, campaign_id, amount, base_reward); ids above the offset are
    line items. They are summed before the dimensions (id, organization_id, name) are joined.
    """
    grouped = points.groupBy(trunc_ts("created_at", "hour").alias("data_at"), "unit_id", "campaign_id").agg(
        F.count("*").alias("reward_count"), F.sum("amount").alias("reward_sum"),
        F.sum("base_reward").alias("base_reward_sum"))
    joined = offset_join(grouped, lineitems, campaigns, "campaign_id", "id", ["organization_id", "name"], OFFSET)
    out = joined.select("data_at", "unit_id", "campaign_id",
                        F.coalesce("organization_id", F.lit(1)).alias("campaign_organization_id"),
                        F.coalesce("name", F.lit("")).alias("campaign_name"),
                        "reward_count", "reward_sum", "base_reward_sum")
    return out if units is None else out.join(units, "unit_id", "left")


def unit_point_stats(points: DataFrame, lineitems: DataFrame, campaigns: DataFrame, units: DataFrame) -> DataFrame:
    """Rewards per hour, unit, type and owners, split into the base reward and the rest."""
    hour = trunc_ts("created_at", "hour").alias("data_at")
    extra = points.filter(F.col("amount") > F.col("base_reward")).groupBy(
        hour, "unit_id", "point_type", "campaign_id").agg(
        F.count("*").alias("reward_count"), F.sum(F.col("amount") - F.col("base_reward")).alias("reward"))
    owned = offset_join(extra, lineitems, campaigns, "campaign_id", "id", ["organization_id"], OFFSET)
    owned = owned.withColumn("campaign_organization_id", F.coalesce("organization_id", F.lit(1)))
    base = points.groupBy(hour, "unit_id").agg(
        F.count("*").alias("reward_count"), F.sum("base_reward").alias("reward")).withColumns({
            "point_type": F.lit("base"), "campaign_organization_id": F.lit(1)})
    cols = ["data_at", "unit_id", "point_type", "campaign_organization_id", "reward_count", "reward"]
    rows = union_all(owned.select(*cols), base.select(*cols))
    summed = rows.groupBy(*cols[:4]).agg(F.sum("reward_count").alias("reward_count"), F.sum("reward").alias("reward"))
    owners = units.select(F.col("id").alias("unit_id"), F.col("organization_id").alias("unit_organization_id"))
    return summed.join(owners, "unit_id", "left")


def ad_reward_stats(points: DataFrame, units: DataFrame, lineitems: DataFrame) -> DataFrame:
    """Redeemed ad rewards (negative amounts) per hour, unit and line-item class."""
    used = points.filter((F.col("amount") < 0) & (F.col("redeem_status") == "succeeded")
                         & (F.col("resource_type") == "ad"))
    grouped = used.groupBy(trunc_ts("created_at", "hour").alias("data_at"), "unit_id", "resource_id").agg(
        F.count("*").alias("n"), F.sum(-F.col("amount")).alias("r"))
    u = units.select(F.col("id").alias("unit_id"), F.col("organization_id").alias("unit_organization_id"))
    item = lineitems.select(F.col("id").alias("resource_id"), "country", F.col("item_type").alias("lineitem_type"),
                            "revenue_type", F.col("organization_id").alias("lineitem_organization_id"))
    return grouped.join(u, "unit_id").join(item, "resource_id").groupBy(
        "data_at", "unit_id", "country", "lineitem_type", "revenue_type", "lineitem_organization_id",
        "unit_organization_id").agg(F.sum("n").alias("reward_count"), F.sum("r").alias("reward"))


def extended_budgets(groups: DataFrame, extra: DataFrame, lineitems: DataFrame, users: DataFrame) -> DataFrame:
    """Ad groups with budget by kind, totals, revenue types and the names of two users in charge."""
    kinds = {"compensation_budget": "C", "addition_budget": "A", "promotion_budget": "P", "carryover_budget": "O"}
    extras = conditional_agg(extra, ["ad_group_id"], {
        n: (F.col("extra_budget_type") == k, F.col("budget")) for n, k in kinds.items()})
    types = joined_distinct(lineitems, ["ad_group_id"], "revenue_type", ",", "revenue_types")
    currencies = joined_distinct(lineitems, ["ad_group_id"], "currency", ",", "currencies")
    named = enrich(groups, [(users, "id", "sales_manager_id", {"sales_manager_name": "name"}),
                            (users, "id", "owner_id", {"owner_name": "name"})])
    joined = (named.withColumnRenamed("id", "ad_group_id").join(extras, "ad_group_id", "left")
              .join(types, "ad_group_id", "left").join(currencies, "ad_group_id", "left"))
    filled = joined.withColumns({n: F.coalesce(n, F.lit(0).cast("decimal(27,9)")) for n in kinds})
    total = F.col("initial_budget")
    for n in kinds:
        total = total + F.col(n)
    return filled.withColumnRenamed("budget", "initial_budget").withColumn(
        "total_budget", total).withColumnRenamed("ad_group_id", "id")


def budget_consumption(spend: DataFrame, budgets: DataFrame, order: list[str]) -> DataFrame:
    """Cumulative spend per ad group at its daily peak, with overspend and capped revenue.

    Spend is (ad_group_id, created_at, sales); budgets (id, initial_budget, carryover_budget,
    total_budget). All figures follow from the cumulative spend, so the daily row is a maximum.
    """
    summed = running_sum(spend, "sales", ["ad_group_id"], order, "cum")
    days = summed.groupBy(business_day("created_at").alias("kst_at"), "ad_group_id").agg(
        F.max("cum").alias("cumulative_spent"))
    b = budgets.withColumnRenamed("id", "ad_group_id")
    over = F.greatest(F.col("cumulative_spent") - F.col("total_budget"), F.lit(0))
    return days.join(b, "ad_group_id").withColumn("cumulative_overspent", over).select(
        "kst_at", "ad_group_id", "initial_budget", "total_budget", "cumulative_spent", "cumulative_overspent",
        F.least(F.col("cumulative_spent") - F.col("cumulative_overspent"),
                F.col("initial_budget") + F.col("carryover_budget")).alias("cumulative_revenue"))


def overspend_attribution(previous: DataFrame, spend: DataFrame, budgets: DataFrame, order: list[str]) -> DataFrame:
    """How much each unit spent beyond the ad group's budget.

    ``previous`` (ad_group_id, created_at, sales) seeds each group with what was spent before, without
    a unit; spend is (ad_group_id, unit_id, created_at, sales). A row is within budget, wholly beyond
    it, or partly. The last running row of a unit is its total, so plain sums finish the job.
    """
    none = F.lit(None).cast(spend.schema["unit_id"].dataType)
    seeds = previous.withColumn("unit_id", none).select(*spend.columns)
    rows = union_all(seeds, spend)
    b = budgets.select(F.col("id").alias("ad_group_id"), F.col("total_budget").alias("ad_group_total_budget"))
    summed = running_sum(rows, "sales", ["ad_group_id"], order, "cum").join(b, "ad_group_id")
    beyond = F.col("cum") - F.col("ad_group_total_budget")
    over = F.when(beyond <= 0, 0).when(beyond < F.col("sales"), beyond).otherwise(F.col("sales"))
    return summed.withColumn("over", over).groupBy("ad_group_id", "unit_id").agg(
        business_day(F.max("created_at")).alias("kst_at"),
        F.max("ad_group_total_budget").alias("ad_group_total_budget"),
        F.sum("sales").alias("cumulative_spent"), F.sum("over").alias("cumulative_overspent"))


def expire_points(expiries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Withdraw each expiry from the person's monthly collections, newest month first.

    Expiries are (person_id, version, expire_date, amount), several per person possible; the ledger is
    (person_id, version, created_at, collected). Ledger rows are first summed per month and per
    stretch between two expiries and accumulated per month, so that every (expiry, month) is formed
    once and a person's rows never meet each of their expiries.
    """
    none, when = F.lit(None), expiries.schema["expire_date"].dataType
    marks = expiries.select("person_id", "version", F.lit(1).alias("__e"), none.cast("timestamp_ntz").alias("month"),
                            money("amount").alias("amount"), "expire_date")
    rows = ledger.select("person_id", "version", F.lit(0).alias("__e"), trunc_ts("created_at", "month").alias("month"),
                         money("collected").alias("amount"), none.cast(when).alias("expire_date"))
    # Expiries before a row: a row at the expiry's own version does not count towards it.
    order = ["version", ("__e", "desc")]
    tagged = running_sum(union_all(marks, rows), "__e", ["person_id"], order, "__nth")
    e = tagged.filter(F.col("__e") == 1).select("person_id", "expire_date", "__nth", F.col("amount").alias("total"),
                                                F.col("version").alias("__version"))
    sums = tagged.filter(F.col("__e") == 0).groupBy("person_id", "month", F.col("__nth").alias("__after")).agg(
        F.sum("amount").alias("collected"))
    # A month's sum so far holds from one of its stretches to the next: each (expiry, month) is made once.
    by_month = Window.partitionBy("person_id", "month").orderBy("__after")
    upto = sums.withColumns({"collected": F.sum("collected").over(by_month.rowsBetween(Window.unboundedPreceding, 0)),
                             "__next": F.lead("__after").over(by_month)})
    last = e.groupBy("person_id").agg(F.max("__nth").alias("__last"))
    held = upto.join(last, "person_id").withColumn("__to", F.coalesce("__next", "__last")).filter("__after < __to")
    each = held.withColumn("__nth", F.explode(F.sequence(F.col("__after") + 1, F.col("__to"))))
    months = e.join(each.select("person_id", "month", "collected", "__nth"), ["person_id", "__nth"])
    cumulative = running_sum(months, "collected", ["person_id", "__version"], [("month", "desc")], "cum", bucket=False)
    left = F.when(F.col("cum") <= F.col("total"), F.col("collected")).otherwise(
        F.col("collected") - (F.col("cum") - F.col("total")))
    return cumulative.select("person_id", "expire_date", F.col("month").alias("collected_date"),
                             F.greatest(left, F.lit(0)).alias("points_withdraw")).filter("points_withdraw > 0")


def click_conversions(clicks: DataFrame, convs: DataFrame, start, end, back: tuple[int, str] = (2, "month"),
                      shift: tuple[int, str] = (30, "minute")) -> DataFrame:
    """Conversions with the click that caused them; columns of the conversion carry ``conv_``."""
    c = convs.select(*[F.col(x).alias(f"conv_{x}") for x in convs.columns])
    return lookback_join(clicks, c, "click_id", "conv_click_id", "created_at", "conv_created_at", start, end, back, shift)


def efficiency(stats: DataFrame, events: DataFrame, clicks: DataFrame, lineitems: DataFrame, units: DataFrame,
               since, within: tuple[int, str] = (1, "day")) -> DataFrame:
    """CTR, cost per event and return on spend per local day, unit and line item.

    Purchases count when they follow their click within a day; clicks are unique by click_id.
    """
    items = lineitems.select(F.col("id").alias("lineitem_id"), "item_name", "ad_group_id")
    s = stats.filter(F.col("data_at") >= ts(since)).groupBy(
        business_day("data_at").alias("date_at"), "unit_id", "lineitem_id").agg(
        F.sum("impression_count").alias("imps"), F.sum("click_count").alias("clicks"),
        F.sum("sales_total").alias("spent_budget")).join(items, "lineitem_id")
    s = s.withColumn("ctr", safe_ratio("clicks", "imps", 2, pct=True))
    bought = events.filter((F.col("event_time") >= ts(since)) & (F.col("event_type") == "purchase"))
    causes = clicks.filter(F.col("created_at") >= ts(since)).select("click_id", F.col("created_at").alias("clicked_at"))
    hits = attribute(bought, causes, "click_id", "event_time", "clicked_at", within)
    e = hits.groupBy(business_day("event_time").alias("date_at"), "unit_id", "lineitem_id").agg(
        F.count("*").alias("event_count"), F.sum(F.coalesce("event_revenue", F.lit(0))).alias("revenue"))
    joined = s.join(units.select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name")), "unit_id").join(
        e, ["date_at", "unit_id", "lineitem_id"], "left")
    n = F.coalesce("event_count", F.lit(0))
    return joined.select(
        "date_at", "unit_id", "unit_name", "lineitem_id", F.col("item_name").alias("lineitem_name"), "ad_group_id",
        "imps", "clicks", "ctr", "spent_budget", n.alias("event_count"),
        safe_ratio("spent_budget", n).alias("cost_per_event"),
        int_div(n, "clicks").alias("event_over_clicks"),
        F.coalesce("revenue", F.lit(0)).alias("purchase_revenue"),
        F.when(F.col("spent_budget") > 0, F.round(F.col("revenue") * 100 / F.col("spent_budget"), 2))
        .otherwise(0).alias("roas"))


def payouts(sources: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Payouts of several sources with their adjustments added and the latest adjustment's note.

    Each source is (name, payouts (id, unit_id, month_at, ours, theirs, status), adjustments
    (id, payout_id, ours, theirs, note)).
    """
    parts = []
    for name, pay, adj in sources:
        a = adj.groupBy(F.col("payout_id").alias("id")).agg(
            F.sum("ours").alias("__ours"), F.sum("theirs").alias("__theirs"), F.max_by("note", "id").alias("memo"))
        zero = F.lit(0).cast("decimal(27,9)")
        parts.append(pay.join(a, "id", "left").select(
            "unit_id", "month_at", (F.col("ours") + F.coalesce("__ours", zero)).alias("ours"),
            (F.col("theirs") + F.coalesce("__theirs", zero)).alias("theirs"), "status", "memo",
            F.lit(name).alias("data_source")))
    return union_all(*parts)


@dataclass(frozen=True)
class PayoutRule:
    """Payout formulas of one account type, over the summed row and its contract."""

    account: str
    contract: str
    display_revenue: Column
    action_revenue: Column
    display_cost: Column
    action_cost: Column


MEASURES = ["display_revenue", "media_display_revenue", "media_action_revenue", "action_revenue",
            "action_unit_revenue", "display_cost", "action_cost", "base_reward_cost"]


def revenue_split(stats: DataFrame, account: Column, own_org: int = 1, excluded_network: int | None = None) -> DataFrame:
    """Sales and rewards per day, user, unit and account type, split by revenue type and owner.

    Stats are (date_at, ifa, unit_id, lineitem_organization_id, lineitem_revenue_type, adnetwork_id,
    sales_total, unit_sales_total, reward_total) plus what ``account`` needs.
    """
    own = F.col("lineitem_organization_id") == own_org
    display = F.col("lineitem_revenue_type").isin("cpc", "cpm")
    counted = own if excluded_network is None else own & (
        (F.col("adnetwork_id") != excluded_network) | F.col("adnetwork_id").isNull())
    rules = {
        "display_revenue": (own & display, "sales_total"),
        "media_display_revenue": (~own & display, "sales_total"),
        "media_action_revenue": (~own & ~display, "unit_sales_total"),
        "action_revenue": (own & ~display, "sales_total"),
        "action_unit_revenue": (own & ~display, "unit_sales_total"),
        "action_cost": (counted, "reward_total"),
    }
    return conditional_agg(stats.withColumn("account_type", account),
                           ["date_at", "ifa", "unit_id", "account_type"],
                           {n: (c, F.coalesce(money(v), money(F.lit(0)))) for n, (c, v) in rules.items()})


def settle_revenue(stats: DataFrame, costs: DataFrame, contracts: dict[str, DataFrame],
                   rules: list[PayoutRule]) -> DataFrame:
    """Payouts per day, user, unit and account type.

    ``stats`` comes from ``revenue_split``, ``costs`` holds display and base reward costs on the same
    keys, and each contract frame is unique by unit_id. One join per contract source and one formula
    per account type, chosen by the account, replace a join per account type.
    """
    keys = ["date_at", "ifa", "unit_id", "account_type"]
    summed = merge_measures([
        (stats, {m: F.col(m) for m in MEASURES if m in stats.columns}),
        (costs, {m: F.col(m) for m in ("display_cost", "base_reward_cost")})], keys)
    wanted = F.lit(None).cast("string")
    for r in rules:
        wanted = F.when(F.col("account_type") == r.account, r.contract).otherwise(wanted)
    tagged = union_all(*[c.withColumn("__contract", F.lit(n)) for n, c in contracts.items()])
    # An account type without a rule, or a unit without a contract, keeps its sums and has no payouts.
    joined = summed.withColumn("__contract", wanted).join(tagged, ["unit_id", "__contract"], "left")

    def pick(part: str) -> Column:
        out = F.lit(None).cast("decimal(27,9)")
        for r in rules:
            out = F.when(F.col("account_type") == r.account, money(getattr(r, part))).otherwise(out)
        return out.alias(f"{part}_payout")

    kept = ["display_revenue", "action_revenue", "display_cost", "action_cost", "base_reward_cost"]
    return joined.select(*keys, *kept, *[pick(p) for p in kept[:4]])


def latest_contracts(payouts_made: DataFrame, contracts: DataFrame, since) -> DataFrame:
    """Contract of each unit's newest payout."""
    recent = payouts_made.filter(F.col("created_at") >= ts(since))
    newest = recent.groupBy("unit_id").agg(F.max_by("billing_contract_id", "created_at").alias("id"))
    return newest.join(contracts, "id").drop("id")


def point_costs(points: DataFrame, units: DataFrame, lineitems: DataFrame, campaigns: DataFrame,
                account: Column) -> DataFrame:
    """Point, display and base reward costs per day, user, unit and account type, in currency units.

    Points are (created_at, ifa, unit_id, refer_key, amount, base_reward); units (id, name,
    organization_id, unit_type, currency).
    """
    from tidemark.functions.numbers import point_rate
    owner = offset_join(points, lineitems, campaigns, "refer_key", "id", ["organization_id"], OFFSET)
    owner = owner.withColumnRenamed("organization_id", "campaign_organization_id")
    rows = owner.join(units.withColumnRenamed("id", "unit_id"), "unit_id").withColumns({
        "account_type": account, "point_rate": point_rate("currency")})
    foreign = F.col("campaign_organization_id") != F.col("organization_id")
    zero = F.lit(0)
    per_rate = rows.groupBy(business_day("created_at").alias("date_at"), "ifa", "unit_id", "account_type",
                            "point_rate").agg(
        F.sum("amount").alias("point_cost"),
        F.sum(F.when(foreign, F.coalesce("amount", zero) - F.coalesce("base_reward", zero)).otherwise(0)).alias("d"),
        F.sum(F.coalesce("base_reward", zero)).alias("b"))
    return per_rate.select(
        "date_at", F.coalesce("ifa", F.lit("00000000-0000-0000-0000-000000000000")).alias("ifa"), "unit_id",
        "account_type", "point_cost", (F.col("d") / F.col("point_rate")).alias("display_cost"),
        (F.col("b") / F.col("point_rate")).alias("base_reward_cost"))
