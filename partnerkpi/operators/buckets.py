"""City buckets: provider->city history map, city ranking, top-N buckets, populated months.

The original pulls the top cities and the populated months back to the client and splices them into later SQL.
Here both stay DataFrames: the top-N list (at most ``top_cities`` rows) is broadcast into a left join, and the
populated months (at most one row per month of the window) into a left-semi join, so the scorecard is one lazy DAG.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import month_key
from .scope import is_delivered, partner_orders


def provider_city_history(ctx: KpiContext) -> DataFrame:
    """Per partner provider: MAX city and MAX name over its whole order history (any state, any date)."""

    def build() -> DataFrame:
        f = partner_orders(ctx)
        # MAX over strings cannot use a hash aggregate buffer (it would sort the whole history); the distinct
        # (provider, city, name) triples are reduced by a hash aggregate first, so only they are sorted. The variant
        # count (providers seen under several cities or names) keeps that distinct step in the optimized plan.
        triples = f.select("provider_id", "city_name", "provider_name").distinct()
        return triples.groupBy("provider_id").agg(
            F.max("city_name").alias("city_name"),
            F.max("provider_name").alias("provider_name"),
            F.count(F.lit(1)).alias("n_variants"),
        )

    return ctx.stage("city_map", build)


def provider_city_map(ctx: KpiContext) -> DataFrame:
    """Q17."""
    return provider_city_history(ctx).select("provider_id", "city_name")


def city_orders_rank(ctx: KpiContext) -> DataFrame:
    """Q18: delivered partner orders per city in the benchmark window, descending."""
    p = ctx.params
    f = partner_orders(ctx, is_delivered() & ctx.wh.ordered_between(p.bench_start, p.bench_end))
    return (
        f.groupBy(F.col("city_name").alias("city"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("city"))
    )


def top_cities(ctx: KpiContext) -> DataFrame:
    """The top ``top_cities`` named cities by orders (ties by name); NULL never takes a slot. At most N rows."""
    n = ctx.params.top_cities

    def build() -> DataFrame:
        top = (
            city_orders_rank(ctx)
            .where(F.col("city").isNotNull())
            .orderBy(F.desc("orders"), F.asc("city"))
            .limit(n)
        )
        # a window over the <= N rows of the limit, not over data
        return top.select(
            F.col("city").alias("bucket"),
            F.row_number().over(Window.orderBy(F.desc("orders"), F.asc("city"))).cast("long").alias("bucket_ord"),
        )

    return ctx.stage("top_cities", build)


def city_bucket(ctx: KpiContext, top: DataFrame | None = None) -> DataFrame:
    """Q19: the bucket list - top cities in rank order, then the 'other' bucket (always present)."""
    p = ctx.params
    top = top_cities(ctx) if top is None else top
    other = ctx.spark.range(1).select(
        F.lit(p.other_bucket).alias("bucket"), F.lit(p.top_cities + 1).cast("long").alias("bucket_ord")
    )
    return top.unionByName(other)


def bucketize(ctx: KpiContext, df: DataFrame, city_col: str, top: DataFrame | None = None) -> DataFrame:
    """Add ``bucket``: the city when it is a top city, else the 'other' bucket (NULL cities included)."""
    top = top_cities(ctx) if top is None else top
    t = F.broadcast(top.select(F.col("bucket").alias("_top_city")))  # bounded: at most top_cities rows
    return df.join(t, F.col(city_col) == F.col("_top_city"), "left").withColumn(
        "bucket", F.coalesce(F.col("_top_city"), F.lit(ctx.params.other_bucket))
    ).drop("_top_city")


def scorecard_orders(ctx: KpiContext) -> DataFrame:
    """Delivered partner orders in the scorecard window with their month key."""
    p = ctx.params
    f = partner_orders(ctx, is_delivered() & ctx.wh.ordered_between(p.scorecard_start, p.scorecard_end))
    return f.withColumn("month", month_key("order_date"))


def populated_months_from(ctx: KpiContext, business: DataFrame) -> DataFrame:
    """Months whose orders summed over buckets reach ``min_month_orders`` (the code's >=)."""
    return (
        business.groupBy("month")
        .agg(F.sum("orders").cast("long").alias("orders"))
        .where(F.col("orders") >= ctx.params.min_month_orders)
    )


def keep_months(df: DataFrame, months: DataFrame, month_col: Column | str = "month") -> DataFrame:
    """Left-semi join to the populated months; the month list is bounded by the window length, so broadcast."""
    m = F.broadcast(months.select(F.col("month").alias("_pm")))
    c = F.col(month_col) if isinstance(month_col, str) else month_col
    return df.join(m, c == F.col("_pm"), "left_semi")
