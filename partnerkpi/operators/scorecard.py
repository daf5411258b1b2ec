"""Scorecard: business and quality series per city bucket and month, peer benchmarks, the 19-metric matrix,
cell classes and verdicts.

Sizes: every table past the scans is bounded by (buckets x months) or by the 19-row metric catalogue, so the joins
among them are broadcast by construction; how the scans join the provider ids is left to Catalyst and AQE.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import KpiContext
from ..functions.calendar import month_key, ts_half_open
from ..functions.measures import distinct_count, finish_pair, mart, round_half_up, safe_div, weighted_pair
from .buckets import (
    bucketize,
    city_bucket,
    keep_months,
    populated_months_from,
    provider_city_history,
    scorecard_orders,
    top_cities,
)
from ..sources.schema import MONTHLY_RATES
from .scope import is_delivered, partner_weekly, peer_metrics, peer_orders

# The metric catalogue (order, key, group, direction, display format).
# direction 1 = higher is better, -1 = lower is better; groups: scale, unit, availability, quality.
METRICS = [
    (1, "GMV", "scale", 1, "eur"),
    (2, "Orders", "scale", 1, "int"),
    (3, "Active Users", "scale", 1, "int"),
    (4, "New Users", "scale", 1, "int"),
    (5, "Frequency", "scale", 1, "dec"),
    (6, "Active Merchants", "scale", 1, "int"),
    (7, "AOV", "unit", 1, "eur"),
    (8, "GMV per Merchant", "unit", 1, "eur"),
    (9, "Orders per Merchant", "unit", 1, "int"),
    (10, "Availability", "availability", 1, "pct"),
    (11, "Total Delivery Time", "quality", -1, "min"),
    (12, "Late Delivery 10+", "quality", -1, "pct"),
    (13, "Late Prep 10+", "quality", -1, "pct"),
    (14, "Failed", "quality", -1, "pct"),
    (15, "Bad Order Rate", "quality", -1, "pct"),
    (16, "Replacement", "quality", -1, "pct"),
    (17, "CS Ticket", "quality", -1, "pct"),
    (18, "Completion", "quality", 1, "pct"),
    (19, "Rating", "quality", 1, "dec"),
]
METRIC_KEYS = [m[1] for m in METRICS]
QUALITY_GROUP = "quality"

METRIC_DEF_SCHEMA = T.StructType(
    [
        T.StructField("metric_ord", T.LongType(), False),
        T.StructField("metric_key", T.StringType(), False),
        T.StructField("metric_group", T.StringType(), False),
        T.StructField("dir", T.LongType(), False),
        T.StructField("fmt", T.StringType(), False),
    ]
)


def metric_def(ctx: KpiContext) -> DataFrame:
    """The catalogue as a 19-row table built from literals (JVM-side, no Python data path)."""
    rows = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(m, METRIC_DEF_SCHEMA.fields)])
        for m in METRICS
    ]
    return ctx.spark.range(1).select(F.inline(F.array(*rows)))


# ---- shared parts --------------------------------------------------------------------------------------------------
class Scorecard:
    """The scorecard's intermediate tables.

    Every output of the scorecard, highlight and store families is derived from these members. In a staging run each is
    persisted once (``KpiContext.stage``), so the top-city ranking, the business series, the city map and the benchmark
    scans run once, however many outputs use them.
    """

    def __init__(self, ctx: KpiContext):
        self.ctx = ctx

    @cached_property
    def top(self) -> DataFrame:
        return top_cities(self.ctx)

    @cached_property
    def buckets(self) -> DataFrame:
        return city_bucket(self.ctx, self.top)

    @cached_property
    def metric_def(self) -> DataFrame:
        return metric_def(self.ctx)

    @cached_property
    def city_map(self) -> DataFrame:
        """Provider -> MAX city/name: one row per partner provider."""
        return provider_city_history(self.ctx)

    @cached_property
    def business(self) -> DataFrame:
        return self.ctx.stage("sc_business", self._business)

    def _business(self) -> DataFrame:
        f = bucketize(self.ctx, scorecard_orders(self.ctx), "city_name", self.top)
        return f.groupBy("bucket", "month").agg(*business_aggs(self.ctx.params.approx_distinct_rsd))

    @cached_property
    def months(self) -> DataFrame:
        return self.ctx.stage("sc_months", lambda: populated_months_from(self.ctx, self.business))

    def _metric_rows(self, table: DataFrame) -> DataFrame:
        p = self.ctx.params
        rows = table.where(ts_half_open("ts", p.scorecard_start.replace(day=1), p.scorecard_end_excl)).withColumn(
            "month", month_key("ts")
        )
        rows = keep_months(rows, self.months)
        rows = rows.join(self.city_map.select("provider_id", "city_name"), "provider_id")
        return bucketize(self.ctx, rows, "city_name", self.top)

    @cached_property
    def quality(self) -> DataFrame:
        def build() -> DataFrame:
            aggs = []
            for rate in MONTHLY_RATES:
                aggs += weighted_pair(f"{rate}_value", f"{rate}_weight", rate)
            return self._metric_rows(self.ctx.wh.provider_monthly).groupBy("bucket", "month").agg(*aggs)

        return self.ctx.stage("sc_quality", build)

    @cached_property
    def adjustment(self) -> DataFrame:
        def build() -> DataFrame:
            pair = weighted_pair("adjustment_value", "adjustment_weight", "adjustment")
            return self._metric_rows(partner_weekly(self.ctx)).groupBy("bucket", "month").agg(*pair)

        return self.ctx.stage("sc_adjustment", build)

    # ---- peer benchmarks (one row each, even over an empty scope) --------------------------------------------------
    def _bench_rows(self, table: DataFrame) -> DataFrame:
        p = self.ctx.params
        return peer_metrics(self.ctx, table, ts_half_open("ts", p.bench_start.replace(day=1), p.bench_end_excl))

    @cached_property
    def bench_business(self) -> DataFrame:
        return self.ctx.stage("sc_bench_business", self._bench_business)

    def _bench_business(self) -> DataFrame:
        p = self.ctx.params
        f = peer_orders(self.ctx, is_delivered() & self.ctx.wh.ordered_between(p.bench_start, p.bench_end))
        return f.agg(*business_aggs(p.approx_distinct_rsd))

    @cached_property
    def bench_quality(self) -> DataFrame:
        return self.ctx.stage("sc_bench_quality", lambda: self._bench_rows(self.ctx.wh.provider_monthly).agg(
            *[mart(_w2(rate, rate not in ("minutes", "rating"))).alias(rate) for rate in MONTHLY_RATES]
        ))

    @cached_property
    def bench_adjustment(self) -> DataFrame:
        return self.ctx.stage(
            "sc_bench_adjustment",
            lambda: self._bench_rows(self.ctx.wh.provider_weekly).agg(mart(_w2("adjustment", True)).alias("adjustment")),
        )

    # ---- matrix, benchmarks, means ---------------------------------------------------------------------------------
    def _long(self, wide: DataFrame, ids: list[str], value_name: str) -> DataFrame:
        long_df = wide.unpivot(ids, METRIC_KEYS, "metric_key", value_name)
        return long_df.join(F.broadcast(self.metric_def), "metric_key")  # 19 rows

    @cached_property
    def matrix(self) -> DataFrame:
        return self.ctx.stage("sc_matrix", self._matrix)

    def _matrix(self) -> DataFrame:
        # dense grid: every bucket gets the (bounded) array of populated months, one scalar subquery, no join
        months = self.months.select(F.sort_array(F.collect_list("month"))).scalar()
        spine = self.buckets.select("bucket", "bucket_ord", F.explode(months).alias("month"))
        # every input below is bounded by (buckets x months): broadcast by construction
        wide = (
            spine.join(F.broadcast(self.business), ["bucket", "month"], "left")
            .join(F.broadcast(self.quality), ["bucket", "month"], "left")
            .join(F.broadcast(self.adjustment), ["bucket", "month"], "left")
        )
        wide = wide.select("bucket", "bucket_ord", "month", *[v.alias(k) for v, k in zip(matrix_values(), METRIC_KEYS)])
        return self._long(wide, ["bucket", "bucket_ord", "month"], "value").select(
            "metric_ord", "metric_key", "bucket_ord", "bucket", "month", "value"
        )

    @cached_property
    def benchmarks(self) -> DataFrame:
        return self.ctx.stage("sc_benchmarks", self._benchmarks)

    def _benchmarks(self) -> DataFrame:
        p = self.ctx.params
        # three one-row aggregates: quality and adjustment attach to the business row as scalar subqueries
        one = (
            self.bench_business.withColumn("_q", self.bench_quality.select(F.struct("*")).scalar())
            .withColumn("_a", self.bench_adjustment.select(F.struct("*")).scalar())
            .select("*", "_q.*", "_a.*")
        )
        vals = benchmark_values(p.bench_months)
        wide = one.select(*[v.cast("double").alias(k) for v, k in zip(vals, METRIC_KEYS)])
        return self._long(wide, [], "bench").select("metric_ord", "metric_key", "bench")

    def with_bench(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.benchmarks.select("metric_key", "bench")), "metric_key")  # 19 rows

    @cached_property
    def summary(self) -> DataFrame:
        """One row per metric and bucket (``summary_measures``) with benchmark and catalogue: all that is read from series."""

        def build() -> DataFrame:
            rows = self.matrix.groupBy("metric_ord", "metric_key", "bucket_ord", "bucket").agg(*summary_measures())
            return self.with_bench(rows).join(F.broadcast(self.metric_def.drop("metric_ord")), "metric_key")

        return self.ctx.stage("sc_summary", build)

    @property
    def means(self) -> DataFrame:
        return self.summary


def summary_measures() -> list:
    """Of a metric's dense month series: mean over the non-NULL (already rounded) months, first and last non-NULL value, their
    number, and the first and last month. The month is ordered as a DATE (fixed width), for a hash aggregate."""
    day = F.when(F.col("value").isNotNull(), F.to_date("month", "yyyy-MM"))
    months = F.to_date("month", "yyyy-MM")
    return [
        F.avg("value").alias("mean_value"),
        F.min_by("value", day).alias("first_value"),
        F.max_by("value", day).alias("last_value"),
        F.count("value").alias("n_months"),
        F.date_format(F.min(months), "yyyy-MM").alias("m_first"),
        F.date_format(F.max(months), "yyyy-MM").alias("m_last"),
    ]


def business_aggs(rsd: float | None) -> list:
    """Orders, GMV EUR and the three distinct counts (exact unless an HLL error is requested)."""
    return [
        F.count(F.lit(1)).alias("orders"),
        mart(F.sum("gmv_eur").cast("double")).alias("gmv_eur"),
        distinct_count("user_id", rsd).alias("active_users"),
        distinct_count(F.when(F.col("is_first"), F.col("user_id")), rsd).alias("new_users"),
        distinct_count("provider_id", rsd).alias("merchants"),
    ]


def _w2(rate: str, pct: bool):
    return finish_pair(F.sum(F.col(f"{rate}_value") * F.col(f"{rate}_weight")), F.sum(f"{rate}_weight"), pct)


def benchmark_values(bench_months: int) -> list:
    """The 19 benchmarks from one row of peer aggregates (business, quality and adjustment parts)."""
    nm = F.when(F.coalesce(F.col("merchants"), F.lit(0)) == 0, F.lit(1)).otherwise(F.col("merchants"))
    months = float(bench_months)

    def per_merchant_month(c):
        return round_half_up(safe_div(safe_div(c, nm), F.lit(months)), 1)

    o, g, au = F.col("orders"), F.col("gmv_eur"), F.col("active_users")
    return [
        per_merchant_month(g),
        per_merchant_month(o),
        per_merchant_month(au),
        per_merchant_month(F.col("new_users")),
        round_half_up(safe_div(o, au), 2),
        F.lit(None).cast("double"),
        round_half_up(safe_div(g, o), 1),
        per_merchant_month(g),
        per_merchant_month(o),
        round_half_up(F.col("active"), 1),
        round_half_up(F.col("minutes"), 1),
        round_half_up(F.col("late"), 1),
        round_half_up(F.col("prep"), 1),
        round_half_up(F.col("failed"), 1),
        round_half_up(F.col("bad"), 1),
        F.when(F.col("adjustment") != 0, round_half_up(F.col("adjustment"), 1)),  # 0 counts as missing
        round_half_up(F.col("ticket"), 1),
        round_half_up(F.col("completion"), 1),
        round_half_up(F.col("rating"), 2),
    ]


def matrix_values() -> list:
    """The 19 cell values of one (bucket, month) row from the joined business/quality/adjustment parts."""
    o, g, au, nu, mc = (F.col(c) for c in ("orders", "gmv_eur", "active_users", "new_users", "merchants"))

    def q(rate, pct, scale):
        return round_half_up(finish_pair(f"{rate}_vw", f"{rate}_w", pct), scale)

    return [
        round_half_up(g, 0),
        o.cast("double"),
        au.cast("double"),
        nu.cast("double"),
        round_half_up(safe_div(o, au), 2),
        mc.cast("double"),
        round_half_up(safe_div(g, o), 0),
        round_half_up(safe_div(g, mc), 1),
        round_half_up(safe_div(o, mc), 1),
        q("active", True, 1),
        q("minutes", False, 2),
        q("late", True, 1),
        q("prep", True, 1),
        q("failed", True, 1),
        q("bad", True, 1),
        q("adjustment", True, 1),
        q("ticket", True, 1),
        q("completion", True, 1),
        q("rating", False, 2),
    ]


def _sc(ctx: KpiContext, sc: Scorecard | None) -> Scorecard:
    return Scorecard(ctx) if sc is None else sc


# ---- registered outputs -------------------------------------------------------------------------------------------
def business_by_bucket_month(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q20: per bucket (the order's own city) and month: orders, GMV EUR, active/new users, merchants."""
    return _sc(ctx, sc).business


def populated_months(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q21: months whose orders summed over buckets reach the threshold, in calendar order."""
    return _sc(ctx, sc).months.orderBy("month")


def quality_by_bucket_month(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q22: nine (sum v*w, sum w) pairs per bucket (provider's MAX city) and populated month."""
    return _pairs_at_edge(_sc(ctx, sc).quality)


def adjustment_by_bucket_month(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q23: the item-adjustment pair from the weekly table (a week goes to its stamp's month)."""
    return _pairs_at_edge(_sc(ctx, sc).adjustment)


def _pairs_at_edge(pairs: DataFrame) -> DataFrame:
    """Merged pairs as a result: sums rounded to 6 dp (the parts themselves stay raw, so they merge further)."""
    return pairs.select(*[mart(c).alias(c) if c.endswith("_vw") else c for c in pairs.columns])


def benchmark_business(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q24: peers' orders, GMV EUR, active/new users, merchants over the benchmark window (one row)."""
    return _sc(ctx, sc).bench_business


def benchmark_quality(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q25: nine finished weighted rates of the peers over the benchmark months (one row)."""
    return _sc(ctx, sc).bench_quality


def benchmark_adjustment(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q26: peers' item adjustment % over the benchmark months (one row)."""
    return _sc(ctx, sc).bench_adjustment


def metric_matrix(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q28: 19 metrics x every bucket x every populated month, missing parts give NULL (dense series)."""
    return _sc(ctx, sc).matrix


def metric_benchmarks(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q29: one benchmark per metric; per-merchant-per-month for scale metrics, NULL for Active Merchants."""
    return _sc(ctx, sc).benchmarks


def good_or_bad(value, ref, direction):
    """'good' when the value is at least as good as the reference in the metric's direction; NULL when undefined."""
    good = ((direction == 1) & (value >= ref)) | ((direction == -1) & (value <= ref))
    return F.when(value.isNull() | ref.isNull() | (direction == 0), F.lit(None).cast("string")).when(
        good, "good"
    ).otherwise("bad")


def metric_cell_class(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q30: good/bad per matrix cell against the metric's benchmark."""
    sc = _sc(ctx, sc)
    m = sc.with_bench(sc.matrix).join(F.broadcast(sc.metric_def.select("metric_key", "dir")), "metric_key")
    return m.select(
        "metric_ord", "metric_key", "bucket", "month", "value", "bench",
        good_or_bad(F.col("value"), F.col("bench"), F.col("dir")).alias("cell_class"),
    )


def metric_verdict(ctx: KpiContext, sc: Scorecard | None = None) -> DataFrame:
    """Q31: mean vs benchmark: 'par' within +-par_band (relative), else above/below; tone flips for dir -1."""
    m = _sc(ctx, sc).means
    a = F.col("mean_value")
    verdict, tone = verdict_columns(a, F.col("bench"), F.col("dir"), ctx.params.par_band)
    return m.select("metric_ord", "metric_key", "bucket", mart(a).alias("mean_value"), "bench",
                    verdict.alias("verdict"), tone.alias("tone"))


def verdict_columns(a, b, d, band: float):
    """(verdict, tone) of a mean ``a`` against benchmark ``b`` for direction ``d``.

    'par' when |a - b| / |b| <= band; a zero benchmark gives no ratio, so it is never 'par' and falls to
    above/below. No verdict (tone 'eq') when the mean or the benchmark is NULL.
    """
    rel = safe_div(a - b, F.abs(b))
    undefined = a.isNull() | b.isNull()
    par = F.coalesce(F.abs(rel) <= band, F.lit(False))
    verdict = F.when(undefined, F.lit(None).cast("string")).when(par, "par").when(a > b, "above").otherwise("below")
    tone = (
        F.when(undefined | par, "eq")
        .when(a > b, F.when(d == -1, "down").otherwise("up"))
        .otherwise(F.when(d == -1, "up").otherwise("down"))
    )
    return verdict, tone
