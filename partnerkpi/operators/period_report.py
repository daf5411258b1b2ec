"""Period report: seven KPI families by month and by ISO week, the rolling-7-day snapshot and the top stores.

Each family is one function taking ``grain`` ('month' or 'week'). The order-based families (financial, operational,
failed orders, campaigns) are projections of one conditional-aggregation pass per grain (``orders_mart``) straight from
the pruned, date-filtered fact, aggregated map-side; a family alone reads only its own columns. The weekly-metric families
share one pass of mergeable (sum v*w, sum w) pairs per grain (``weekly_mart``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import MONTH, WEEK, month_key, period_key, stamp_key, ts_between, ts_from
from ..functions.measures import coalesce_sum, distinct_count, finish_pair, mart, round_half_up, safe_div, weighted_rate
from ..sources.schema import MERCHANT_SPEND, PLATFORM_SPEND
from .scope import failed_resolutions, is_delivered, not_delivered, partner_orders, partner_weekly

WEEKLY_PAIRS = ["adjustment", "replacement", "acceptance", "active", "rating"]


def _order_window(ctx: KpiContext, grain: str):
    p = ctx.params
    if grain == MONTH:
        return p.data_start, p.data_end
    if grain == WEEK:
        return p.week_start, p.week_end
    raise ValueError(grain)


# ---- shared per-grain marts ----------------------------------------------------------------------------------------
def orders_mart(ctx: KpiContext, grain: str) -> DataFrame:
    """Per period, every measure of the four order-based families, in one pass over the partner's order slice.

    Delivered-only measures are conditional (``when(delivered, ...)``), so a period without delivered orders has
    ``n_delivered = 0`` and is dropped by those families, as a WHERE on the state would.
    """
    return ctx.stage(f"pr_orders_{grain}", lambda: orders_mart_plan(ctx, grain))


def orders_mart_plan(ctx: KpiContext, grain: str) -> DataFrame:
    """The unstaged plan of ``orders_mart``."""
    s, e = _order_window(ctx, grain)
    f = partner_orders(ctx, ctx.wh.ordered_between(s, e), part=grain).withColumn("period", period_key("order_date", grain))
    return f.groupBy("period").agg(*order_measures(ctx.params.approx_distinct_rsd))


def order_measures(rsd: float | None = None) -> list[Column]:
    """Every measure of the four order-based families, as aggregates over order rows."""
    dl = is_delivered()

    def dsum(c: Column | str) -> Column:
        return F.sum(F.when(dl, F.col(c) if isinstance(c, str) else c))

    def dcount(cond: Column) -> Column:
        return F.count(F.when(dl & cond, 1))

    return [
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(dl, 1)).alias("n_delivered"),
        F.count(F.when(not_delivered(), 1)).alias("n_failed"),
        dsum("gross").cast("double").alias("gross"),
        dsum("gmv").cast("double").alias("gmv"),
        dsum("gmv_eur").cast("double").alias("gmv_eur"),
        dsum("refunded").cast("double").alias("refunded"),
        dsum("discount").cast("double").alias("discount"),
        dsum(coalesce_sum(PLATFORM_SPEND)).cast("double").alias("platform_spend"),
        dsum(coalesce_sum(MERCHANT_SPEND)).cast("double").alias("merchant_spend"),
        dcount(F.col("discount") > 0).alias("campaign_orders"),
        distinct_count(F.when(dl & F.col("is_first"), F.col("user_id")), rsd).alias("users_activated"),
        distinct_count(F.when(dl, F.col("user_id")), rsd).alias("active_users"),
        distinct_count(F.when(dl, F.col("provider_id")), rsd).alias("active_stores"),
        dcount(F.col("is_honey")).alias("n_honey"),
        dcount(F.col("is_bad")).alias("n_bad"),
        dcount(F.col("is_late")).alias("n_late"),
        dcount(F.col("is_late_pickup")).alias("n_late_pickup"),
        dsum("delivery_minutes").alias("minutes_sum"),
        F.count(F.when(dl, F.col("delivery_minutes"))).alias("minutes_n"),
        dsum("courier_minutes").alias("courier_sum"),
        F.count(F.when(dl, F.col("courier_minutes"))).alias("courier_n"),
    ]


def weekly_pairs() -> list[Column]:
    """The (sum v*w, sum w) aggregates of the weekly rates."""
    aggs = []
    for r in WEEKLY_PAIRS:
        aggs += [F.sum(F.col(f"{r}_value") * F.col(f"{r}_weight")).alias(f"{r}_vw"), F.sum(f"{r}_weight").alias(f"{r}_w")]
    return aggs


def weekly_mart(ctx: KpiContext, grain: str) -> DataFrame:
    """Per period, the (sum v*w, sum w) pairs of the weekly metric table; a week goes whole to its stamp's month."""

    def build() -> DataFrame:
        p = ctx.params
        if grain == MONTH:
            rows = partner_weekly(ctx, ts_between("ts", p.data_start, p.data_end), part=grain).withColumn("period", month_key("ts"))
        elif grain == WEEK:
            rows = partner_weekly(ctx, ts_between("ts", p.week_start, p.week_end), part=grain).withColumn("period", stamp_key("ts"))
        else:
            raise ValueError(grain)
        return rows.groupBy("period").agg(*weekly_pairs())

    return ctx.stage(f"pr_weekly_{grain}", build)


def _delivered_periods(ctx: KpiContext, grain: str) -> DataFrame:
    return orders_mart(ctx, grain).where(F.col("n_delivered") > 0)


def _pct(num: str, den: str) -> Column:
    return mart(safe_div(num, den) * 100)


# ---- families -----------------------------------------------------------------------------------------------------
def financial_columns() -> list:
    return [
        F.col("n_delivered").alias("orders"),
        mart("gross").alias("merchant_price"),
        mart(safe_div("gross", "n_delivered")).alias("merchant_price_per_order"),
        mart("gmv").alias("gmv"),
        mart(safe_div("gmv", "n_delivered")).alias("aov"),
        "users_activated",
        "active_users",
        _pct("refunded", "gmv").alias("refund_rate_pct"),
        mart(safe_div("gmv", "gmv_eur")).alias("fx_rate"),
    ]


def financial(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q01/Q02: orders, merchant price, GMV, AOV, activated and active users, refund rate, implied FX rate.

    Price per order and AOV divide by all delivered rows (rows with a NULL price included), not by the non-NULL ones.
    """
    return _delivered_periods(ctx, grain).select("period", *financial_columns()).orderBy("period")


def operational_columns() -> list:
    return [
        F.col("n_delivered").alias("delivered_orders"),
        "active_stores",
        _pct("n_honey", "n_delivered").alias("honey_order_rate"),
        _pct("n_bad", "n_delivered").alias("bad_order_rate"),
        _pct("n_late", "n_delivered").alias("late_delivery_rate"),
        _pct("n_late_pickup", "n_delivered").alias("late_pickup_rate"),
        mart(safe_div("minutes_sum", "minutes_n")).alias("avg_delivery_minutes"),
        mart(safe_div("courier_sum", "courier_n")).alias("avg_courier_delivery_min"),
    ]


def operational(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q03/Q04: delivered orders, active stores, honey/bad/late/late-pickup shares (NULL flag = 0), mean times."""
    return _delivered_periods(ctx, grain).select("period", *operational_columns()).orderBy("period")


def failed_orders_columns() -> list:
    return [
        F.col("n_all").alias("total_placed"),
        F.col("n_delivered").alias("delivered"),
        F.col("n_failed").alias("failed_total"),
        _pct("n_failed", "n_all").alias("failed_rate_pct"),
    ]


def failed_orders(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q07/Q08: placed, delivered and failed orders over all states; a NULL state is in neither count."""
    return orders_mart(ctx, grain).select("period", *failed_orders_columns()).orderBy("period")


def campaigns_columns() -> list:
    return [
        mart("discount").alias("campaigns_discount"),
        mart("platform_spend").alias("platform_spend"),
        mart("merchant_spend").alias("merchant_spend"),
        "campaign_orders",
    ]


def campaigns(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q11/Q12: campaign discount, platform and merchant spend (six null-safe columns each), campaign orders."""
    return _delivered_periods(ctx, grain).select("period", *campaigns_columns()).orderBy("period")


def failed_reasons(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q09/Q10: resolution rows of the partner's non-delivered orders by reason and actor (rows, not orders)."""
    s, e = _order_window(ctx, grain)
    rows = failed_resolutions(ctx, ctx.wh.ordered_between(s, e))
    return (
        rows.withColumn("period", period_key("order_date", grain))
        .groupBy("period", "reason", "actor_type")
        .agg(F.sum("n").alias("cnt"))
        .orderBy("period", F.desc("cnt"), "reason", "actor_type")
    )


def replacement_adjustment_columns() -> list:
    return [
        round_half_up(finish_pair("adjustment_vw", "adjustment_w", pct=True), 2).alias("adjustment_rate"),
        round_half_up(finish_pair("replacement_vw", "replacement_w", pct=True), 2).alias("replacement_rate"),
    ]


def replacement_adjustment(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q05/Q06: item adjustment and replacement rates, % rounded to 2 dp, from the weekly metric table."""
    return weekly_mart(ctx, grain).select("period", *replacement_adjustment_columns()).orderBy("period")


def acceptance_columns() -> list:
    return [
        round_half_up(finish_pair("acceptance_vw", "acceptance_w", pct=True), 1).alias("acceptance_rate"),
        round_half_up(finish_pair("active_vw", "active_w", pct=True), 1).alias("availability_rate"),
        round_half_up(finish_pair("rating_vw", "rating_w"), 3).alias("avg_rating"),
    ]


def acceptance(ctx: KpiContext, grain: str = MONTH) -> DataFrame:
    """Q14/Q15: acceptance, availability and rating by month of the weekly stamp / by raw stamp."""
    return weekly_mart(ctx, grain).select("period", *acceptance_columns()).orderBy("period")


def acceptance_current(ctx: KpiContext) -> DataFrame:
    """Q13: acceptance, availability and rating over stamps from 7 days before ``as_of`` on; always exactly one row.

    There is no upper bound: a run at ``as_of`` on tables that go on later reads the later stamps too.
    """
    rows = partner_weekly(ctx, ts_from("ts", ctx.params.rolling_start))
    return rows.agg(
        round_half_up(weighted_rate("acceptance_value", "acceptance_weight", pct=True), 1).alias("acceptance_rate"),
        round_half_up(weighted_rate("active_value", "active_weight", pct=True), 1).alias("availability_rate"),
        round_half_up(weighted_rate("rating_value", "rating_weight"), 3).alias("avg_rating"),
    )


def top_stores_last_month(ctx: KpiContext) -> DataFrame:
    """Q16: previous calendar month, stores (name, city) by merchant price, top N (TakeOrderedAndProject)."""
    p = ctx.params
    f = partner_orders(ctx, is_delivered() & ctx.wh.ordered_between(p.prev_month_start, p.data_end))
    return (
        f.groupBy("provider_name", "city_name")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("gross").cast("double").alias("merchant_price"))
        .select("provider_name", "city_name", "orders", mart("merchant_price").alias("merchant_price"))
        .orderBy(F.desc("merchant_price"), "provider_name", "city_name")
        .limit(p.top_stores)
    )
