"""Mapping of the TPC-H-style test tables onto the five warehouse inputs of the workload.

The test data ships ``orders``, ``lineitem``, ``supplier`` and ``nation``; the workload reads an order fact, a
provider dimension, monthly and weekly per-provider metric tables and an order-resolution table. This module derives
those with ordinary DataFrame jobs, so their size (and all downstream work) grows with the given tables.

Scale notes: the only wide operations are one aggregation of ``lineitem`` by order key (map-side partial
aggregation), one aggregation of ``orders`` by (customer, year) joined back (instead of a window, so a hot customer
is not funnelled into one task), and the order-key join between the two (AQE splits skewed partitions). The supplier
dimension grows with the data (10,000 rows per TPC-H scale unit), so its join strategy is left to Catalyst's size
estimate; only the fixed 25-row nation table is broadcast by hint.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import safe_div
from .schema import MERCHANT_SPEND, PLATFORM_SPEND, SPEND_KINDS

RAW_TABLES = ("orders", "lineitem", "supplier", "nation")

# Fixed values of the test mapping (they must equal the oracle SQL in partnerkpi/oracle.py).
# country split: regions 0,1,2 -> 'xa', others -> 'xb'; partner groups by supplier key parity: even 'P0', odd 'P1';
# grocery flag: supplier key not divisible by 3.
# order state: status 'P' -> 'rejected' (even customer) or 'cancelled' (odd customer); any other -> 'delivered'.
# priority digit -> spend kind: 1 am, 2 liquidity, 3 marketing, 4 user_lifecycle, 5 merchant_lifecycle;
# platform share 0.4, merchant share 0.6 of the discount; 'other' spend 0.01 of net value when customer % 7 == 0
# (platform) or % 11 == 0 (merchant).
# resolution reason by return flag: R item_unavailable, A partner_closed, N client_cancelled;
# actor by line status: F provider, O client.
# monthly active weight 720, weekly active weight 168, active value (90 + provider % 10) / 100.
REASONS = {"R": "item_unavailable", "A": "partner_closed", "N": "client_cancelled"}
ACTORS = {"F": "provider", "O": "client"}
ACTIVE_WEIGHT_MONTH = 720
ACTIVE_WEIGHT_WEEK = 168


def read_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in RAW_TABLES}


def _case(col: str, mapping: dict[str, str]):
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out


def dim_provider(raw: dict[str, DataFrame]) -> DataFrame:
    s, n = raw["supplier"], raw["nation"]
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(  # nation: 25 fixed rows
        F.col("s_suppkey").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.col("n_name").alias("city_name"),
        F.when(F.col("n_regionkey") < 3, "xa").otherwise("xb").alias("country_code"),
        F.when(F.col("s_suppkey") % 2 == 0, "P0").otherwise("P1").alias("group_name"),
        (F.col("s_suppkey") % 3 != 0).alias("is_grocery"),
    )


def order_lines(raw: dict[str, DataFrame]) -> DataFrame:
    """Per-order line summary (one partial-aggregated shuffle of lineitem on the order key)."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    net = price * (F.lit(1) - disc)
    flag = F.col("l_returnflag")
    return raw["lineitem"].groupBy("l_orderkey").agg(
        F.min_by("l_suppkey", F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("provider_id"),
        F.sum(price).alias("gross"),
        F.sum(net).alias("net"),
        F.sum(price * disc).alias("incent"),
        F.sum(F.when(flag == "R", net).otherwise(F.lit(0))).alias("refunded"),
        F.min("l_shipdate").alias("ship"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(flag == "A", 1)).alias("n_adj"),
        F.count(F.when(flag == "R", 1)).alias("n_rep"),
    )


def enriched_orders(raw: dict[str, DataFrame], providers: DataFrame) -> DataFrame:
    """Order fact plus the per-order line counts the weekly table needs (``n_lines``, ``n_adj``, ``n_rep``)."""
    o = raw["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    first = o.groupBy(F.col("o_custkey").alias("f_custkey"), F.year("o_orderdate").alias("f_year")).agg(
        F.min("o_orderdate").alias("first_orderdate")
    )
    lines = order_lines(raw)
    prov = providers.select("provider_id", "provider_name", "city_name")
    j = (
        o.join(lines, o.o_orderkey == lines.l_orderkey)
        .join(first, (F.col("o_custkey") == F.col("f_custkey")) & (F.year("o_orderdate") == F.col("f_year")))
        .join(prov, "provider_id")
    )
    dd = F.abs(F.datediff(F.to_date("ship"), F.to_date("o_orderdate")))
    minutes = (dd % 60 + 10).cast("double")
    digit = F.substring("o_orderpriority", 1, 1)
    is_late = minutes > 50
    spend = []
    for i, kind in enumerate(SPEND_KINDS[:5], start=1):
        spend.append(F.when(digit == str(i), F.col("incent") * F.lit(Decimal("0.4"))).alias(f"platform_spend_{kind}"))
        spend.append(F.when(digit == str(i), F.col("incent") * F.lit(Decimal("0.6"))).alias(f"merchant_spend_{kind}"))
    spend.append(F.when(F.col("o_custkey") % 7 == 0, F.col("net") * F.lit(Decimal("0.01"))).alias("platform_spend_other"))
    spend.append(F.when(F.col("o_custkey") % 11 == 0, F.col("net") * F.lit(Decimal("0.01"))).alias("merchant_spend_other"))
    out = j.select(
        F.col("o_orderkey").alias("order_id"),
        "provider_id",
        "provider_name",
        "city_name",
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") != "P", "delivered")
        .when(F.col("o_custkey") % 2 == 0, "rejected")
        .otherwise("cancelled")
        .alias("order_state"),
        F.col("gross"),
        F.col("net").alias("gmv"),
        (F.col("net") * F.lit(Decimal("0.02"))).alias("gmv_eur"),
        F.col("refunded"),
        F.col("incent").alias("discount"),
        (F.col("o_orderdate") == F.col("first_orderdate")).alias("is_first"),
        (minutes <= 25).alias("is_honey"),
        (is_late | (F.col("n_rep") >= 2)).alias("is_bad"),
        is_late.alias("is_late"),
        (dd % 25 > 15).alias("is_late_pickup"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_ticket"),
        minutes.alias("delivery_minutes"),
        F.when(F.col("o_custkey") % 10 != 0, (dd % 60 + 2).cast("double")).alias("courier_minutes"),
        *spend,
        "n_lines",
        "n_adj",
        "n_rep",
    )
    return out.select(*[c for c in out.columns if c not in PLATFORM_SPEND + MERCHANT_SPEND],
                      *PLATFORM_SPEND, *MERCHANT_SPEND)


def _flag_avg(cond) -> F.Column:
    return F.avg(F.when(cond, 1).otherwise(0))


def _rating_parts():
    rated = F.col("user_id") % 3 == 0
    return [
        F.avg(F.when(rated, 1 + F.col("user_id") % 5)).alias("rating_value"),
        F.count(F.when(rated, 1)).alias("rating_weight"),
    ]


def _active_parts(weight: int):
    return [
        ((90 + F.col("provider_id") % 10).cast("double") / 100).alias("active_value"),
        F.lit(weight).cast("long").alias("active_weight"),
    ]


def provider_monthly(enriched: DataFrame) -> DataFrame:
    delivered = F.col("order_state") == "delivered"
    n = F.count(F.lit(1))
    return enriched.groupBy("provider_id", F.trunc("order_date", "month").cast("timestamp_ntz").alias("ts")).agg(
        F.count(F.when(delivered, 1)).alias("delivered_orders"),
        F.avg(F.when(delivered, F.col("delivery_minutes"))).alias("minutes_value"),
        F.count(F.when(delivered, 1)).alias("minutes_weight"),
        _flag_avg(F.col("is_late")).alias("late_value"),
        n.alias("late_weight"),
        _flag_avg(F.col("is_late_pickup")).alias("prep_value"),
        n.alias("prep_weight"),
        _flag_avg(~delivered).alias("failed_value"),
        n.alias("failed_weight"),
        _flag_avg(F.col("is_bad")).alias("bad_value"),
        n.alias("bad_weight"),
        _flag_avg(F.col("is_ticket")).alias("ticket_value"),
        n.alias("ticket_weight"),
        _flag_avg(delivered).alias("completion_value"),
        n.alias("completion_weight"),
        *_rating_parts(),
        *_active_parts(ACTIVE_WEIGHT_MONTH),
    )


def provider_weekly(enriched: DataFrame) -> DataFrame:
    lines = F.sum("n_lines")
    return enriched.groupBy(
        "provider_id", F.date_trunc("week", "order_date").cast("date").cast("timestamp_ntz").alias("ts")
    ).agg(
        safe_div(F.sum("n_adj"), lines).alias("adjustment_value"),
        lines.alias("adjustment_weight"),
        safe_div(F.sum("n_rep"), lines).alias("replacement_value"),
        lines.alias("replacement_weight"),
        _flag_avg(F.col("order_state") != "rejected").alias("acceptance_value"),
        F.count(F.lit(1)).alias("acceptance_weight"),
        *_rating_parts(),
        *_active_parts(ACTIVE_WEIGHT_WEEK),
    )


def resolution(raw: dict[str, DataFrame]) -> DataFrame:
    pending = raw["orders"].where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("l_orderkey"))
    return raw["lineitem"].join(pending, "l_orderkey", "left_semi").select(
        F.col("l_orderkey").alias("order_id"),
        _case("l_returnflag", REASONS).alias("reason"),
        _case("l_linestatus", ACTORS).alias("actor_type"),
    )
