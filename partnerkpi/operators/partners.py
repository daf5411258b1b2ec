"""Both reports for all partners of all countries in one run: the partner is a key, not a literal.

A partner is a (``country_code``, ``partner_group``) of the provider dimension. Every result has these columns in front of
what a run for that one partner gives (``params.country`` and ``partner_group`` are not read). What a single run does by
literals and scalar subqueries is keyed here: top cities, stores and gaps by grouped limits (the window cuts each map task to
N rows a partner before the shuffle), medians and month spans by grouped aggregates, peer benchmarks by country.

The order families of both grains come from one scan of the fact: a row is dealt to the month and to the week that it counts
for (only rows of the last four weeks count twice), and one aggregation by (partner, grain, period) follows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import MONTH, WEEK, date_between, month_key, stamp_key, ts_between, ts_from, ts_half_open, week_key
from ..functions.measures import finish_pair, mart, round_half_up, weighted_pair, weighted_rate
from ..sources.schema import MONTHLY_RATES
from . import period_report as pr
from . import stores as st
from .highlights import highlight_rows
from .scope import counted_failures, is_delivered, not_delivered
from .scorecard import METRIC_KEYS, benchmark_values, business_aggs, good_or_bad, matrix_values, metric_def, summary_measures, verdict_columns

COUNTRY, PARTNER = "country_code", "partner_group"
KEYS = (COUNTRY, PARTNER)


def _either(grains: dict[str, Column], key: dict[str, Column]) -> Column:
    """One row for each grain whose window holds the row: struct (grain, period)."""
    cells = [F.when(inside, F.struct(F.lit(g).alias("grain"), key[g].alias("period"))) for g, inside in grains.items()]
    return F.explode(F.array_compact(F.array(*cells)))


class AllPartners:
    """The two reports' tables for every partner. In a staging context shared parts are persisted once per run."""

    def __init__(self, ctx: KpiContext):
        if ctx.params.peers_exclude_partner:
            raise ValueError("peers_exclude_partner has other peers for each partner: run the partners one by one")
        self.ctx, self.p = ctx, ctx.params

    # ---- scope -----------------------------------------------------------------------------------------------------
    @cached_property
    def providers(self) -> DataFrame:
        dim = self.ctx.wh.dim_provider.where(F.col("group_name").isNotNull() & F.col("country_code").isNotNull())
        return dim.select("provider_id", "country_code", F.col("group_name").alias(PARTNER))

    @cached_property
    def partners(self) -> DataFrame:
        return self.ctx.stage("ap_partners", lambda: self.providers.select(*KEYS).distinct())

    def _orders(self, where: Column | None = None) -> DataFrame:
        f = self.ctx.wh.fact_order
        return (f if where is None else f.where(where)).join(self.providers, "provider_id")

    # ---- period report ---------------------------------------------------------------------------------------------
    def _grains(self, inside) -> dict[str, Column]:
        p = self.p
        return {MONTH: inside(p.data_start, p.data_end), WEEK: inside(p.week_start, p.week_end)}

    def _span(self) -> Column:
        """Order dates of either window."""
        p = self.p
        return self.ctx.wh.ordered_between(min(p.data_start, p.week_start), max(p.data_end, p.week_end))

    def _period_of(self) -> Column:
        """The (grain, period) structs that deal an order row out to both windows."""
        return _either(self._grains(lambda s, e: date_between("order_date", s, e)), {MONTH: month_key("order_date"), WEEK: week_key("order_date")})

    @cached_property
    def orders_mart(self) -> DataFrame:
        def build() -> DataFrame:
            rows = self.ctx.watched("fact_order/both grains", self.ctx.wh.fact_order.where(self._span())).join(self.providers, "provider_id")
            return rows.withColumn("g", self._period_of()).groupBy(*KEYS, "g.grain", "g.period").agg(*pr.order_measures(self.p.approx_distinct_rsd))

        return self.ctx.stage("ap_orders", build)

    @cached_property
    def weekly_mart(self) -> DataFrame:
        def build() -> DataFrame:
            p = self.p
            span = ts_between("ts", min(p.data_start, p.week_start), max(p.data_end, p.week_end))
            rows = self.ctx.watched("provider_weekly/both grains", self.ctx.wh.provider_weekly.where(span)).join(self.providers, "provider_id")
            g = _either(self._grains(lambda s, e: ts_between("ts", s, e)), {MONTH: month_key("ts"), WEEK: stamp_key("ts")})
            return rows.withColumn("g", g).groupBy(*KEYS, "g.grain", "g.period").agg(*pr.weekly_pairs())

        return self.ctx.stage("ap_weekly", build)

    def _family(self, frame: DataFrame, columns: list) -> DataFrame:
        return frame.select(*KEYS, "grain", "period", *columns)

    @cached_property
    def _delivered(self) -> DataFrame:
        return self.orders_mart.where(F.col("n_delivered") > 0)

    def financial(self) -> DataFrame:
        """Q01/Q02 of every partner."""
        return self._family(self._delivered, pr.financial_columns())

    def operational(self) -> DataFrame:
        """Q03/Q04 of every partner."""
        return self._family(self._delivered, pr.operational_columns())

    def failed_orders(self) -> DataFrame:
        """Q07/Q08 of every partner."""
        return self._family(self.orders_mart, pr.failed_orders_columns())

    def campaigns(self) -> DataFrame:
        """Q11/Q12 of every partner."""
        return self._family(self._delivered, pr.campaigns_columns())

    def replacement_adjustment(self) -> DataFrame:
        """Q05/Q06 of every partner."""
        return self._family(self.weekly_mart, pr.replacement_adjustment_columns())

    def acceptance(self) -> DataFrame:
        """Q14/Q15 of every partner."""
        return self._family(self.weekly_mart, pr.acceptance_columns())

    def failed_reasons(self) -> DataFrame:
        """Q09/Q10 of every partner: resolution rows of non-delivered orders by reason and actor."""
        g = self._period_of()
        if self.ctx.wh.bucketed:
            counted = counted_failures(self.ctx, self._span()).join(self.providers, "provider_id")
        else:
            orders = self._orders(not_delivered() & self._span()).select("order_id", "order_date", *KEYS)
            counted = self.ctx.wh.resolution.join(orders, "order_id").select("order_date", "reason", "actor_type", F.lit(1).alias("n"), *KEYS)
        return counted.withColumn("g", g).groupBy(*KEYS, "g.grain", "g.period", "reason", "actor_type").agg(F.sum("n").alias("cnt"))

    def acceptance_current(self) -> DataFrame:
        """Q13 of every partner; a partner without rows has one row of NULLs."""
        rows = self.ctx.wh.provider_weekly.where(ts_from("ts", self.p.rolling_start)).join(self.providers, "provider_id")
        rates = rows.groupBy(*KEYS).agg(
            round_half_up(weighted_rate("acceptance_value", "acceptance_weight", pct=True), 1).alias("acceptance_rate"),
            round_half_up(weighted_rate("active_value", "active_weight", pct=True), 1).alias("availability_rate"),
            round_half_up(weighted_rate("rating_value", "rating_weight"), 3).alias("avg_rating"),
        )
        return self.partners.join(rates, list(KEYS), "left")

    def top_stores_last_month(self) -> DataFrame:
        """Q16 of every partner."""
        f = self._orders(is_delivered() & self.ctx.wh.ordered_between(self.p.prev_month_start, self.p.data_end))
        stores = f.groupBy(*KEYS, "provider_name", "city_name").agg(
            F.count(F.lit(1)).alias("orders"), mart(F.sum("gross").cast("double")).alias("merchant_price")
        )
        place = Window.partitionBy(*KEYS).orderBy(F.desc("merchant_price"), "provider_name", "city_name")
        return stores.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= self.p.top_stores).drop("_n")

    # ---- buckets ---------------------------------------------------------------------------------------------------
    @cached_property
    def city_map(self) -> DataFrame:
        """Provider -> MAX city and name over its whole history, with its partner (Q17)."""

        def build() -> DataFrame:
            seen = self._orders().select(*KEYS, "provider_id", "city_name", "provider_name").distinct()
            return seen.groupBy(*KEYS, "provider_id").agg(
                F.max("city_name").alias("city_name"), F.max("provider_name").alias("provider_name"), F.count(F.lit(1)).alias("n_variants")
            )

        return self.ctx.stage("ap_city_map", build)

    def provider_city_map(self) -> DataFrame:
        return self.city_map.select(*KEYS, "provider_id", "city_name")

    def city_orders_rank(self) -> DataFrame:
        """Q18 of every partner."""
        f = self._orders(is_delivered() & self.ctx.wh.ordered_between(self.p.bench_start, self.p.bench_end))
        return f.groupBy(*KEYS, F.col("city_name").alias("city")).agg(F.count(F.lit(1)).alias("orders"))

    @cached_property
    def top(self) -> DataFrame:
        """(partner, bucket, bucket_ord): the first named cities of each partner, by a grouped limit."""

        def build() -> DataFrame:
            place = Window.partitionBy(*KEYS).orderBy(F.desc("orders"), F.asc("bucket"))
            named = self.city_orders_rank().where(F.col("city").isNotNull()).withColumnRenamed("city", "bucket")
            ranked = named.withColumn("n", F.row_number().over(place)).where(F.col("n") <= self.p.top_cities)
            return ranked.select(*KEYS, "bucket", F.col("n").cast("long").alias("bucket_ord"))

        return self.ctx.stage("ap_top", build)

    @cached_property
    def buckets(self) -> DataFrame:
        """Q19 of every partner."""
        other = self.partners.select(*KEYS, F.lit(self.p.other_bucket).alias("bucket"), F.lit(self.p.top_cities + 1).cast("long").alias("bucket_ord"))
        return self.top.unionByName(other)

    def _bucketed(self, df: DataFrame, city: str) -> DataFrame:
        """Add ``bucket``; the top cities grow with the partners, so how they are joined is left to Catalyst."""
        top = self.top.select(*KEYS, F.col("bucket").alias(city), F.lit(True).alias("_top"))
        named = df.join(top, [*KEYS, city], "left")
        return named.withColumn("bucket", F.when(F.col("_top"), F.col(city)).otherwise(self.p.other_bucket)).drop("_top")

    # ---- scorecard -------------------------------------------------------------------------------------------------
    @cached_property
    def business(self) -> DataFrame:
        """Q20 of every partner."""

        def build() -> DataFrame:
            f = self._orders(is_delivered() & self.ctx.wh.ordered_between(self.p.scorecard_start, self.p.scorecard_end))
            f = self._bucketed(f.withColumn("month", month_key("order_date")), "city_name")
            return f.groupBy(*KEYS, "bucket", "month").agg(*business_aggs(self.p.approx_distinct_rsd))

        return self.ctx.stage("ap_business", build)

    @cached_property
    def months(self) -> DataFrame:
        """Q21 of every partner."""

        def build() -> DataFrame:
            total = self.business.groupBy(*KEYS, "month").agg(F.sum("orders").cast("long").alias("orders"))
            return total.where(F.col("orders") >= self.p.min_month_orders)

        return self.ctx.stage("ap_months", build)

    def _metric_rows(self, table: DataFrame) -> DataFrame:
        inside = ts_half_open("ts", self.p.scorecard_start.replace(day=1), self.p.scorecard_end_excl)
        rows = table.where(inside).withColumn("month", month_key("ts")).join(self.city_map.drop("provider_name", "n_variants"), "provider_id")
        return self._bucketed(rows.join(self.months.select(*KEYS, "month"), [*KEYS, "month"], "left_semi"), "city_name")

    @cached_property
    def quality(self) -> DataFrame:
        pairs = [c for r in MONTHLY_RATES for c in weighted_pair(f"{r}_value", f"{r}_weight", r)]
        return self.ctx.stage("ap_quality", lambda: self._metric_rows(self.ctx.wh.provider_monthly).groupBy(*KEYS, "bucket", "month").agg(*pairs))

    @cached_property
    def adjustment(self) -> DataFrame:
        pair = weighted_pair("adjustment_value", "adjustment_weight", "adjustment")
        return self.ctx.stage("ap_adjustment", lambda: self._metric_rows(self.ctx.wh.provider_weekly).groupBy(*KEYS, "bucket", "month").agg(*pair))

    @staticmethod
    def _at_edge(pairs: DataFrame) -> DataFrame:
        return pairs.select(*[mart(c).alias(c) if c.endswith("_vw") else c for c in pairs.columns])

    def quality_by_bucket_month(self) -> DataFrame:
        """Q22 of every partner."""
        return self._at_edge(self.quality)

    def adjustment_by_bucket_month(self) -> DataFrame:
        """Q23 of every partner."""
        return self._at_edge(self.adjustment)

    # ---- benchmarks: the peers of a partner are its country's grocery providers ---------------------------------------
    @cached_property
    def _peers(self) -> DataFrame:
        return self.ctx.wh.dim_provider.where(F.col("is_grocery")).select("provider_id", "country_code")

    def _bench(self, rows: DataFrame, aggs: list, zero: tuple[str, ...] = ()) -> DataFrame:
        """One row per country, also where no peer has rows (counts 0, the rest NULL)."""
        found = rows.join(self._peers, "provider_id").groupBy(COUNTRY).agg(*aggs)
        all_rows = self.partners.select(COUNTRY).distinct().join(found, COUNTRY, "left")
        return all_rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in zero}) if zero else all_rows

    @cached_property
    def bench_business(self) -> DataFrame:
        """Q24 of every country."""
        rows = self.ctx.wh.fact_order.where(is_delivered() & self.ctx.wh.ordered_between(self.p.bench_start, self.p.bench_end))
        zero = ("orders", "active_users", "new_users", "merchants")
        return self.ctx.stage("ap_bench_business", lambda: self._bench(rows, business_aggs(self.p.approx_distinct_rsd), zero))

    def _in_bench(self, table: DataFrame) -> DataFrame:
        return table.where(ts_half_open("ts", self.p.bench_start.replace(day=1), self.p.bench_end_excl))

    @cached_property
    def bench_quality(self) -> DataFrame:
        """Q25 of every country."""
        rates = [mart(weighted_rate(f"{r}_value", f"{r}_weight", r not in ("minutes", "rating"))).alias(r) for r in MONTHLY_RATES]
        return self.ctx.stage("ap_bench_quality", lambda: self._bench(self._in_bench(self.ctx.wh.provider_monthly), rates))

    @cached_property
    def bench_adjustment(self) -> DataFrame:
        """Q26 of every country."""
        rate = mart(weighted_rate("adjustment_value", "adjustment_weight", True)).alias("adjustment")
        return self.ctx.stage("ap_bench_adjustment", lambda: self._bench(self._in_bench(self.ctx.wh.provider_weekly), [rate]))

    @cached_property
    def _metric_def(self) -> DataFrame:
        return metric_def(self.ctx)

    def _long(self, wide: DataFrame, ids: list[str], value: str) -> DataFrame:
        return wide.unpivot(ids, METRIC_KEYS, "metric_key", value).join(F.broadcast(self._metric_def), "metric_key")  # 19 rows

    @cached_property
    def benchmarks(self) -> DataFrame:
        """Q29 of every country."""

        def build() -> DataFrame:
            one = self.bench_business.join(self.bench_quality, COUNTRY).join(self.bench_adjustment, COUNTRY)
            wide = one.select(COUNTRY, *[v.cast("double").alias(k) for v, k in zip(benchmark_values(self.p.bench_months), METRIC_KEYS)])
            return self._long(wide, [COUNTRY], "bench").select(COUNTRY, "metric_ord", "metric_key", "bench")

        return self.ctx.stage("ap_benchmarks", build)

    # ---- matrix and what is read from it ----------------------------------------------------------------------------
    @cached_property
    def matrix(self) -> DataFrame:
        """Q28 of every partner: 19 metrics x the partner's buckets x its populated months."""

        def build() -> DataFrame:
            cell = [*KEYS, "bucket", "month"]
            wide = (
                self.buckets.join(self.months.select(*KEYS, "month"), list(KEYS))
                .join(self.business, cell, "left").join(self.quality, cell, "left").join(self.adjustment, cell, "left")
            )
            wide = wide.select(*KEYS, "bucket", "bucket_ord", "month", *[v.alias(k) for v, k in zip(matrix_values(), METRIC_KEYS)])
            return self._long(wide, [*KEYS, "bucket", "bucket_ord", "month"], "value").select(
                *KEYS, "metric_ord", "metric_key", "bucket_ord", "bucket", "month", "value", "dir", "fmt", "metric_group"
            )

        return self.ctx.stage("ap_matrix", build)

    def metric_matrix(self) -> DataFrame:
        return self.matrix.drop("dir", "fmt", "metric_group")

    def _with_bench(self, df: DataFrame) -> DataFrame:
        return df.join(self.benchmarks.select(COUNTRY, "metric_key", "bench"), [COUNTRY, "metric_key"])

    def metric_cell_class(self) -> DataFrame:
        """Q30 of every partner."""
        cls = good_or_bad(F.col("value"), F.col("bench"), F.col("dir"))
        return self._with_bench(self.matrix).select(*KEYS, "metric_ord", "metric_key", "bucket", "month", "value", "bench", cls.alias("cell_class"))

    @cached_property
    def summary(self) -> DataFrame:
        def build() -> DataFrame:
            ids = [*KEYS, "metric_ord", "metric_key", "bucket_ord", "bucket", "dir", "fmt", "metric_group"]
            return self._with_bench(self.matrix.groupBy(*ids).agg(*summary_measures()))

        return self.ctx.stage("ap_summary", build)

    def metric_verdict(self) -> DataFrame:
        """Q31 of every partner."""
        a = F.col("mean_value")
        verdict, tone = verdict_columns(a, F.col("bench"), F.col("dir"), self.p.par_band)
        return self.summary.select(*KEYS, "metric_ord", "metric_key", "bucket", mart(a).alias("mean_value"), "bench", verdict.alias("verdict"), tone.alias("tone"))

    def highlights(self) -> DataFrame:
        """Q35 of every partner (Q32 to Q34 are its rows of ``ord`` 1 to 3)."""
        return highlight_rows(self.summary, self.p.max_gaps, self.p.gap_order, KEYS)

    # ---- stores ------------------------------------------------------------------------------------------------------
    @cached_property
    def store_rows(self) -> DataFrame:
        """Q27 of every partner."""

        def build() -> DataFrame:
            adj = self._in_bench(self.ctx.wh.provider_weekly).groupBy("provider_id").agg(
                finish_pair(F.sum(F.col("adjustment_value") * F.col("adjustment_weight")), F.sum("adjustment_weight"), pct=True).alias("replacement")
            )
            rows = self._in_bench(self.ctx.wh.provider_monthly).join(self.city_map, "provider_id").join(adj, "provider_id", "left")
            stores = rows.groupBy(*KEYS, F.col("provider_name").alias("addr"), F.col("city_name").alias("city")).agg(*st.store_measures())
            return stores.where(F.col("orders") > 0).select(*KEYS, "addr", "city", *st.STORE_KEYS)

        return self.ctx.stage("ap_stores", build)

    @cached_property
    def store_bucketed(self) -> DataFrame:
        """Q36 of every partner."""

        def build() -> DataFrame:
            rounded = [round_half_up(k, 2).alias(k) for k in st.STORE_KEYS if k != "orders"]
            return self._bucketed(self.store_rows, "city").select(*KEYS, "addr", "city", "bucket", "orders", *rounded)

        return self.ctx.stage("ap_store_bucketed", build)

    @cached_property
    def medians(self) -> DataFrame:
        """Q37 of every partner that has stores."""
        return self.ctx.stage("ap_medians", lambda: st.medians_of(self.ctx, self.store_bucketed, KEYS))

    @cached_property
    def _scored(self) -> DataFrame:
        med = self.medians.select(*KEYS, *[F.col(k).alias(f"med_{k}") for k in st.STORE_KEYS])
        return self.store_bucketed.join(med, list(KEYS))

    @cached_property
    def flags(self) -> DataFrame:
        """Q38 of every partner."""
        return self.ctx.stage("ap_flags", lambda: self._scored.select(*KEYS, "addr", "city", "bucket", *st.STORE_KEYS, st.flag_count().alias("flags")))

    def worst_stores(self) -> DataFrame:
        """Q39 of every partner."""
        place = Window.partitionBy(*KEYS).orderBy(F.desc("flags"), F.desc(F.coalesce(F.col("late"), F.lit(0.0))), F.desc("orders"), "addr", "city")
        return self.flags.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= self.p.worst_stores).drop("_n")

    def store_severity(self) -> DataFrame:
        """Q40 of every partner."""
        return self.flags.select(*KEYS, "addr", "city", "bucket", "flags", st.severity(self.ctx, F.col("flags")).alias("severity"))

    def store_cell_class(self) -> DataFrame:
        """Q41 of every partner."""
        return st.cell_classes(self._scored, KEYS)

    def store_ranked(self) -> DataFrame:
        """Q42 of every partner."""
        return st.ranked(self.flags, keys=KEYS)

    def bucket_store_counts(self) -> DataFrame:
        """Q43 of every partner."""
        counts = self.store_bucketed.groupBy(*KEYS, "bucket").agg(F.count(F.lit(1)).alias("stores"))
        return counts.join(self.buckets, [*KEYS, "bucket"]).select(*KEYS, "bucket_ord", "bucket", "stores")

    def result(self, name: str) -> DataFrame:
        """A result by its query name (without ``partners_``)."""
        found = getattr(self, _HELD_AS.get(name, name))
        return found if isinstance(found, DataFrame) else found()


#: Results that are shared parts too.
_HELD_AS = {
    "city_bucket": "buckets", "business_by_bucket_month": "business", "populated_months": "months", "store_quality": "store_rows",
    "store_medians": "medians", "store_flags": "flags", "benchmark_business": "bench_business", "benchmark_quality": "bench_quality",
    "benchmark_adjustment": "bench_adjustment", "metric_benchmarks": "benchmarks",
}

#: Results with both grains, results with one row set per partner, and results per country.
PERIOD = ("financial", "operational", "replacement_adjustment", "failed_orders", "failed_reasons", "campaigns", "acceptance")
PER_PARTNER = (
    "acceptance_current", "top_stores_last_month", "provider_city_map", "city_orders_rank", "city_bucket", "business_by_bucket_month",
    "populated_months", "quality_by_bucket_month", "adjustment_by_bucket_month", "store_quality", "metric_matrix", "metric_cell_class",
    "metric_verdict", "highlights", "store_bucketed", "store_medians", "store_flags", "worst_stores", "store_severity",
    "store_cell_class", "store_ranked", "bucket_store_counts",
)
PER_COUNTRY = ("benchmark_business", "benchmark_quality", "benchmark_adjustment", "metric_benchmarks")
