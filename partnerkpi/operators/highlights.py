"""Highlights per bucket: orders trend, new-users trend, biggest quality gaps versus the benchmark.

Every step is a grouped aggregate over the (metric x bucket x month) matrix, which is bounded by the catalogue and
the window; the ordered gap text uses ``sort_array`` over at most ``max_gaps`` structs per bucket, so its order does
not depend on shuffle order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.measures import round_half_up, safe_div
from .scorecard import QUALITY_GROUP, Scorecard, _sc

# Fixed text of the highlight rows (level / kind / wording).
LEVEL_WIN, LEVEL_WATCH, LEVEL_CRIT = "win", "watch", "crit"
KIND_ORDERS, KIND_NEW_USERS, KIND_GAPS = "Orders", "New users", "Where to improve"


TREND_METRICS = ["Orders", "New Users"]


def trends(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """First and last non-NULL month value per bucket for both trend metrics, where there are two such months."""
    return _sc(ctx, sc).summary.where(F.col("metric_key").isin(TREND_METRICS) & (F.col("n_months") >= 2))


def _trend(sc: Scorecard, metric_key: str) -> DataFrame:
    return trends(sc.ctx, sc).where(F.col("metric_key") == metric_key)


def trend_pct(first, last):
    """|last - first| / first in whole percent (half-up); 0 when the first value is 0."""
    return F.when(first != 0, round_half_up(safe_div(F.abs(last - first), first) * 100, 0)).otherwise(
        F.lit(0.0)).cast("long")


def _as_int_text(c):
    return round_half_up(c, 0).cast("long").cast("string")


def highlight_orders_trend(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q32: orders first vs last month; win when not lower; pct = |change| / first, 0 when first is 0."""
    return _trend(_sc(ctx, sc), "Orders").select("bucket", *[c.alias(n) for n, c in orders_trend_columns().items()])


def orders_trend_columns() -> dict[str, Column]:
    a1, a2 = F.col("first_value"), F.col("last_value")
    up = a2 >= a1
    pct = trend_pct(a1, a2)
    text = F.concat(
        F.lit("Orders "), _as_int_text(a1), F.lit("→"), _as_int_text(a2),
        F.lit(" ("), F.col("m_first"), F.lit("→"), F.col("m_last"), F.lit("), "),
        F.when(up, F.lit("growth ")).otherwise(F.lit("decline ")), pct.cast("string"), F.lit("%."),
    )
    level = F.when(up, LEVEL_WIN).otherwise(LEVEL_WATCH)
    return {"first_value": a1, "last_value": a2, "level": level, "pct": pct, "kind": F.lit(KIND_ORDERS), "text": text}


def highlight_new_users_trend(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q33: the same on New Users, without the percentage."""
    return _trend(_sc(ctx, sc), "New Users").select("bucket", *[c.alias(n) for n, c in new_users_trend_columns().items()])


def new_users_trend_columns() -> dict[str, Column]:
    a1, a2 = F.col("first_value"), F.col("last_value")
    text = F.concat(
        F.lit("New users "), _as_int_text(a1), F.lit("→"), _as_int_text(a2),
        F.lit(" ("), F.col("m_first"), F.lit("→"), F.col("m_last"), F.lit(")."),
    )
    level = F.when(a2 >= a1, LEVEL_WIN).otherwise(LEVEL_WATCH)
    return {"first_value": a1, "last_value": a2, "level": level, "kind": F.lit(KIND_NEW_USERS), "text": text}


def _gap_value_text(v, fmt):
    """Number to text by display format: minutes and % as whole numbers, 'dec' with two decimals."""
    whole = _as_int_text(v)
    return (
        F.when(fmt == "min", F.concat(whole, F.lit(" min")))
        .when(fmt == "pct", F.concat(whole, F.lit("%")))
        .when(fmt == "dec", F.format_string("%.2f", round_half_up(v, 2)))
        .otherwise(whole)
    )


def quality_gaps(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Quality metrics whose mean is strictly worse than the benchmark, ranked per bucket by raw mean desc."""
    return ranked_gaps(ctx, _sc(ctx, sc).means)


def _is_gap() -> Column:
    """A quality metric whose mean is strictly worse than the benchmark."""
    a, b, d = F.col("mean_value"), F.col("bench"), F.col("dir")
    return b.isNotNull() & (d != 0) & a.isNotNull() & ((d * (a - b)) < 0) & (F.col("metric_group") == QUALITY_GROUP)


def _gap_size(gap_order: str) -> Column:
    """What the gaps are ranked by, largest first."""
    a, b = F.col("mean_value"), F.col("bench")
    if gap_order == "distance":
        return F.coalesce(safe_div(F.abs(a - b), F.abs(b)), F.lit(float("inf")))  # zero benchmark: farthest
    if gap_order == "mean":
        return a
    raise ValueError(f"gap_order must be 'mean' or 'distance', not {gap_order!r}")


def _gap_item() -> Column:
    return F.concat(F.col("metric_key"), F.lit(" ("), _gap_value_text(F.col("mean_value"), F.col("fmt")), F.lit(")"))


def _gaps_text(items: Column) -> Column:
    return F.concat(F.lit("Biggest gaps with the market: "), F.array_join(items, "; "), F.lit("."))


def ranked_gaps(ctx: KpiContext, summary: DataFrame) -> DataFrame:
    """The quality gaps, the first ``max_gaps`` of each bucket."""
    w = Window.partitionBy("bucket").orderBy(F.desc(_gap_size(ctx.params.gap_order)), F.asc("metric_ord"))
    return summary.where(_is_gap()).withColumn("gap_rank", F.row_number().over(w)).where(F.col("gap_rank") <= ctx.params.max_gaps)


def highlight_gaps(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q34: one 'crit' row per bucket with gaps; the text joins the top gaps with '; '."""
    return ctx.stage("sc_gaps", lambda: _highlight_gaps(ctx, sc))


def _highlight_gaps(ctx: KpiContext, sc: Scorecard | None) -> DataFrame:
    per_bucket = quality_gaps(ctx, sc).withColumn("item", _gap_item()).groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("gap_rank", "item"))).alias("items"),  # <= max_gaps per bucket
        F.count(F.lit(1)).alias("n_gaps"),
    )
    return per_bucket.select(
        "bucket", F.lit(LEVEL_CRIT).alias("level"), F.lit(KIND_GAPS).alias("kind"), _gaps_text(F.col("items.item")).alias("text"), "n_gaps"
    )


def highlight_rows(summary: DataFrame, max_gaps: int, gap_order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """All highlights of each bucket from one reading of its summary (19 rows): trends, then the gaps' text."""
    place = [*keys, "bucket_ord", "bucket"]

    def trend(metric: str, columns: dict[str, Column], ord_: int) -> Column:
        row = F.struct(F.lit(ord_).alias("ord"), *[columns[c].alias(c) for c in ("level", "kind", "text")])
        return F.max(F.when((F.col("metric_key") == metric) & (F.col("n_months") >= 2), row))

    gap = F.when(_is_gap(), F.struct((-_gap_size(gap_order)).alias("size"), F.col("metric_ord"), _gap_item().alias("item")))
    per_bucket = summary.groupBy(*place).agg(
        trend("Orders", orders_trend_columns(), 1).alias("o"),
        trend("New Users", new_users_trend_columns(), 2).alias("u"),
        F.slice(F.sort_array(F.collect_list(gap)), 1, max_gaps).alias("gaps"),  # at most 19 a bucket
    )
    gaps = F.when(F.size("gaps") > 0, F.struct(F.lit(3).alias("ord"), F.lit(LEVEL_CRIT).alias("level"), F.lit(KIND_GAPS).alias("kind"), _gaps_text(F.col("gaps.item")).alias("text")))
    return per_bucket.select(*place, F.inline(F.array_compact(F.array("o", "u", gaps))))


def highlights(ctx: KpiContext) -> DataFrame:
    """Q35: orders trend, new-users trend, gaps - in that order, 0 to 3 rows per bucket, buckets by rank."""
    rows = highlight_rows(Scorecard(ctx).summary, ctx.params.max_gaps, ctx.params.gap_order)
    return rows.select("bucket_ord", "bucket", "ord", "level", "kind", "text").orderBy("bucket_ord", "ord")
