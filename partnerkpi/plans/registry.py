"""Named queries: one entry per dataset operator of the workload (the ``queries()`` contract)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..context import KpiContext
from ..functions.calendar import MONTH, WEEK
from ..operators import buckets, highlights, partners, period_report, scorecard, states, stores
from ..operators.input_quality import input_quality
from ..params import FIXTURE_PARAMS, ReportParams
from ..sources.catalog import fixture_warehouse

QueryFn = Callable[[KpiContext], DataFrame]

PERIOD_REPORT: dict[str, QueryFn] = {
    "financial_monthly": lambda c: period_report.financial(c, MONTH),
    "financial_weekly": lambda c: period_report.financial(c, WEEK),
    "operational_monthly": lambda c: period_report.operational(c, MONTH),
    "operational_weekly": lambda c: period_report.operational(c, WEEK),
    "replacement_adjustment_monthly": lambda c: period_report.replacement_adjustment(c, MONTH),
    "replacement_adjustment_weekly": lambda c: period_report.replacement_adjustment(c, WEEK),
    "failed_orders_monthly": lambda c: period_report.failed_orders(c, MONTH),
    "failed_orders_weekly": lambda c: period_report.failed_orders(c, WEEK),
    "failed_reasons_monthly": lambda c: period_report.failed_reasons(c, MONTH),
    "failed_reasons_weekly": lambda c: period_report.failed_reasons(c, WEEK),
    "campaigns_monthly": lambda c: period_report.campaigns(c, MONTH),
    "campaigns_weekly": lambda c: period_report.campaigns(c, WEEK),
    "acceptance_current": period_report.acceptance_current,
    "acceptance_monthly": lambda c: period_report.acceptance(c, MONTH),
    "acceptance_weekly": lambda c: period_report.acceptance(c, WEEK),
    "top_stores_last_month": period_report.top_stores_last_month,
}

SCORECARD: dict[str, QueryFn] = {
    "provider_city_map": buckets.provider_city_map,
    "city_orders_rank": buckets.city_orders_rank,
    "city_bucket": buckets.city_bucket,
    "business_by_bucket_month": scorecard.business_by_bucket_month,
    "populated_months": scorecard.populated_months,
    "quality_by_bucket_month": scorecard.quality_by_bucket_month,
    "adjustment_by_bucket_month": scorecard.adjustment_by_bucket_month,
    "benchmark_business": scorecard.benchmark_business,
    "benchmark_quality": scorecard.benchmark_quality,
    "benchmark_adjustment": scorecard.benchmark_adjustment,
    "store_quality": stores.store_quality,
    "metric_matrix": scorecard.metric_matrix,
    "metric_benchmarks": scorecard.metric_benchmarks,
    "metric_cell_class": scorecard.metric_cell_class,
    "metric_verdict": scorecard.metric_verdict,
    "highlight_orders_trend": highlights.highlight_orders_trend,
    "highlight_new_users_trend": highlights.highlight_new_users_trend,
    "highlight_gaps": highlights.highlight_gaps,
    "highlights": highlights.highlights,
    "store_bucketed": stores.store_bucketed,
    "store_medians": stores.store_medians,
    "store_medians_distributed": lambda c: stores.store_medians(c.with_params(distributed_medians=True)),
    "store_flags": stores.store_flags,
    "worst_stores": stores.worst_stores,
    "store_severity": stores.store_severity,
    "store_cell_class": stores.store_cell_class,
    "store_ranked": stores.store_ranked,
    "bucket_store_counts": stores.bucket_store_counts,
}

#: Every result for all partners in one run, as ``partners_<name>``.
ALL_PARTNERS: dict[str, QueryFn] = {
    f"partners_{name}": (lambda c, name=name: partners.AllPartners(c).result(name))
    for name in (*partners.PERIOD, *partners.PER_PARTNER, *partners.PER_COUNTRY)
}

ALL_PARTNERS["partners_store_medians_distributed"] = lambda c: partners.AllPartners(c.with_params(distributed_medians=True)).result("store_medians")

#: The results for all partners that are folded from day states, as ``states_<name>``.
FROM_STATES: dict[str, QueryFn] = {
    f"states_{name}": (lambda c, name=name: states.StatePartners(c, states.state_frames(c.wh)).result(name)) for name in states.FROM_STATES
}

QUERIES: dict[str, QueryFn] = {**PERIOD_REPORT, **SCORECARD, **ALL_PARTNERS, **FROM_STATES, "input_quality": input_quality}


def context_for(spark: SparkSession, sf_dir: str, params: ReportParams = FIXTURE_PARAMS) -> KpiContext:
    """A context over the test tables as they are now: nothing is kept between calls, the mapping is part of the plan."""
    return KpiContext(spark, fixture_warehouse(spark, sf_dir), params)


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(context_for(spark, sf_dir))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run
