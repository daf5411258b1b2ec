"""Partner and peer scopes: fact and metric tables joined to the provider dimension and filtered.

The dimension side is filtered first (country, partner group / grocery flag); how it is joined is left to Catalyst and
AQE, which know its bytes. Date predicates are written on the raw date or timestamp column and reach the parquet scan as
pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import KpiContext

DELIVERED = "delivered"


def is_delivered() -> Column:
    return F.col("order_state") == DELIVERED


def not_delivered() -> Column:
    """``order_state != 'delivered'``; a NULL state is in neither set."""
    return F.col("order_state") != DELIVERED


def partner_providers(ctx: KpiContext) -> DataFrame:
    p = ctx.params
    return ctx.wh.dim_provider.where(
        (F.col("country_code") == p.country) & (F.col("group_name") == p.partner_group)
    ).select("provider_id")


def peer_providers(ctx: KpiContext) -> DataFrame:
    """Peers: same country, grocery flag set. The partner itself is included unless the parameter excludes it."""
    p = ctx.params
    cond = (F.col("country_code") == p.country) & F.col("is_grocery")
    if p.peers_exclude_partner:
        cond = cond & ~F.coalesce(F.col("group_name") == p.partner_group, F.lit(False))
    return ctx.wh.dim_provider.where(cond).select("provider_id")


def partner_orders(ctx: KpiContext, where: Column | None = None, part: str | None = None) -> DataFrame:
    """The partner's order rows; with ``part`` the run's input counts see all rows of ``where`` under that name."""
    f = ctx.wh.fact_order if where is None else ctx.wh.fact_order.where(where)
    f = ctx.watched(f"fact_order/{part}", f) if part else f
    return f.join(partner_providers(ctx), "provider_id")


def peer_orders(ctx: KpiContext, where: Column | None = None) -> DataFrame:
    f = ctx.wh.fact_order if where is None else ctx.wh.fact_order.where(where)
    return f.join(peer_providers(ctx), "provider_id")


def partner_weekly(ctx: KpiContext, where: Column | None = None, part: str | None = None) -> DataFrame:
    """The partner's weekly metric rows."""
    t = ctx.wh.provider_weekly if where is None else ctx.wh.provider_weekly.where(where)
    t = ctx.watched(f"provider_weekly/{part}", t) if part else t
    return t.join(partner_providers(ctx), "provider_id")


def peer_metrics(ctx: KpiContext, table: DataFrame, where: Column | None = None) -> DataFrame:
    t = table if where is None else table.where(where)
    return t.join(peer_providers(ctx), "provider_id")


def failed_resolutions(ctx: KpiContext, where: Column) -> DataFrame:
    """Resolution rows of the partner's non-delivered orders in a date range, counted by date, reason and actor.

    The order side is pruned to its date range and a few columns first; beyond the size that AQE broadcasts, the join
    shuffles on the order key and splits skewed keys. On bucketed tables it needs no exchange, see ``counted_failures``.
    """
    if ctx.wh.bucketed:
        return counted_failures(ctx, where).join(partner_providers(ctx), "provider_id").select("order_date", "reason", "actor_type", "n")
    orders = partner_orders(ctx, not_delivered() & where).select("order_id", "order_date")
    return ctx.wh.resolution.join(orders, "order_id").select("order_date", "reason", "actor_type", F.lit(1).alias("n"))


def counted_failures(ctx: KpiContext, where: Column) -> DataFrame:
    """Resolutions of non-delivered orders in a date range by provider, date, reason and actor (count ``n``), bucket by bucket.

    Fact and resolutions lie in the same buckets by order id, so each task merges one bucket of both. The resolutions of an
    order are counted by reason and actor first (within the bucket too): an order with very many is a few rows in the
    join. Providers are joined after the counts, when few rows are left to move.
    """
    orders = ctx.wh.fact_order.where(not_delivered() & where).select("order_id", "order_date", "provider_id")
    reasons = ctx.wh.resolution.groupBy("order_id", "reason", "actor_type").agg(F.count(F.lit(1)).alias("n"))
    failed = orders.hint("merge").join(reasons, "order_id")
    return failed.groupBy("provider_id", "order_date", "reason", "actor_type").agg(F.sum("n").alias("n"))
