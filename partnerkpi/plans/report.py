"""The two report runs as Spark jobs: the period report and the scorecard with store scoring.

Each run builds every section from one staging context, then writes the sections as datasets. Nothing is collected to the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import KpiContext
from ..functions.calendar import MONTH, WEEK
from ..operators import highlights, partners, period_report, scorecard, stores
from ..operators.buckets import city_bucket
from ..operators.input_quality import InputWatch
from ..sources.bundle import write_bundle
from ..sources.sinks import nested_metrics, write_sections

FAMILIES = {
    "financial": period_report.financial,
    "operational": period_report.operational,
    "replacement_adjustment": period_report.replacement_adjustment,
    "failed_orders": period_report.failed_orders,
    "failed_reasons": period_report.failed_reasons,
    "campaigns": period_report.campaigns,
    "acceptance_availability": period_report.acceptance,
}


#: What the benchmark is, for the scorecard's reader.
BENCHMARK_NOTE = (
    "Benchmark: grocery providers of the same country over the benchmark months; scale metrics per merchant and month, "
    "rates weighted by their orders."
)


def _one_row(ctx: KpiContext, **values: str) -> DataFrame:
    return ctx.spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def run_meta(ctx: KpiContext) -> DataFrame:
    """Run metadata of the period report (the windows are parameters; ``as_of`` replaces wall-clock time)."""
    p = ctx.params
    return _one_row(
        ctx, country=p.country, partner_group=p.partner_group, as_of=p.as_of.isoformat(),
        data_start=p.data_start.isoformat(), data_end=p.data_end.isoformat(),
        weekly_start=p.week_start.isoformat(), weekly_end=p.week_end.isoformat(),
    )


def scorecard_meta(ctx: KpiContext) -> DataFrame:
    """Run metadata of the scorecard: scope, month range, store period and the benchmark note."""
    p = ctx.params
    return _one_row(
        ctx, country=p.country, partner_group=p.partner_group, as_of=p.as_of.isoformat(),
        scorecard_start=p.scorecard_start.isoformat(), scorecard_end=p.scorecard_end.isoformat(),
        store_period_start=p.bench_start.isoformat(), store_period_end=p.bench_end.isoformat(),
        benchmark_note=BENCHMARK_NOTE,
    )


def month_labels(ctx: KpiContext) -> DataFrame:
    """Every month of the scorecard range with its label, and whether it is populated."""
    rows = [F.struct(F.lit(k).alias("month"), F.lit(v).alias("label")) for k, v in ctx.params.scorecard_months()]
    spine = ctx.spark.range(1).select(F.inline(F.array(*rows)))
    months = F.broadcast(scorecard.populated_months(ctx))  # at most one row a month of the range
    return spine.join(months, "month", "left").select("month", "label", "orders", F.col("orders").isNotNull().alias("populated"))


def period_report_sections(ctx: KpiContext) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {"meta": run_meta(ctx)}
    for grain, label in ((MONTH, "monthly"), (WEEK, "weekly")):
        for fam, fn in FAMILIES.items():
            out[f"{label}/{fam}"] = fn(ctx, grain)
    out["acceptance_current"] = period_report.acceptance_current(ctx)
    out["top_stores"] = period_report.top_stores_last_month(ctx)
    return out


def scorecard_sections(ctx: KpiContext) -> dict[str, DataFrame]:
    sc = scorecard.Scorecard(ctx)
    return {
        "meta": scorecard_meta(ctx),
        "buckets": city_bucket(ctx, sc.top),
        "months": month_labels(ctx),
        "metrics": nested_metrics(sc.matrix, sc.metric_def, sc.benchmarks),
        "metric_matrix": sc.matrix,
        "cell_class": scorecard.metric_cell_class(ctx, sc),
        "verdicts": scorecard.metric_verdict(ctx, sc),
        "highlights": highlights.highlights(ctx),
        "stores": stores.store_table(ctx),
        "store_cols": stores.store_columns(ctx),
        "store_medians": stores.store_medians(ctx),
        "worst_stores": stores.worst_stores(ctx),
        "store_ranked": stores.store_ranked(ctx),
        "store_cells": stores.store_cell_class(ctx),
        "bucket_store_counts": stores.bucket_store_counts(ctx),
        "benchmark_business": sc.bench_business,
    }


def _partition(ctx: KpiContext, by_partner: bool) -> dict[str, str] | None:
    return {"country": ctx.params.country, "partner_group": ctx.params.partner_group} if by_partner else None


def _write(sections, ctx: KpiContext, out_dir: str, fmt: str, by_partner: bool, mode: str) -> dict[str, str]:
    """Write the sections of one run; the parts that they share are persisted for the run and dropped at its end."""
    with KpiContext(ctx.spark, ctx.wh, ctx.params, staging=True) as run:
        return write_sections(sections(run), out_dir, fmt, mode, _partition(run, by_partner))


def write_period_report(ctx: KpiContext, out_dir: str, fmt: str = "parquet", by_partner: bool = False, mode: str = "overwrite") -> dict[str, str]:
    """Write all period-report sections; a rerun replaces them. ``by_partner`` partitions by (country, partner_group)."""
    return _write(period_report_sections, ctx, out_dir, fmt, by_partner, mode)


def write_scorecard(ctx: KpiContext, out_dir: str, fmt: str = "parquet", by_partner: bool = False, mode: str = "overwrite") -> dict[str, str]:
    """Write all scorecard sections; a rerun replaces them. ``by_partner`` partitions by (country, partner_group)."""
    return _write(scorecard_sections, ctx, out_dir, fmt, by_partner, mode)


def partners_sections(ctx: KpiContext) -> dict[str, DataFrame]:
    """Every result of both reports for all partners, the partner as a key."""
    found = partners.AllPartners(ctx)
    return {name: found.result(name) for name in (*partners.PERIOD, *partners.PER_PARTNER, *partners.PER_COUNTRY)}


REPORTS = {"period": period_report_sections, "scorecard": scorecard_sections, "partners": partners_sections}


def report_scope(ctx: KpiContext, report: str) -> str:
    """Name of a report's bundles: one sequence of bundles for each report and partner."""
    return report if report == "partners" else f"{report}/{ctx.params.country}/{ctx.params.partner_group}"


def publish(ctx: KpiContext, root: str, report: str, fmt: str = "parquet", observe: bool = False) -> str:
    """Write a report as a bundle that readers see as a whole once its manifest is there; returns the run id.

    The ``partners`` report is partitioned by country and partner group. With ``observe`` the bundle ends with the
    section ``input_quality``: what the run's own reading of the inputs met (the scorecard watches nothing: no rows).
    """
    watch = InputWatch() if observe else None
    with KpiContext(ctx.spark, ctx.wh, ctx.params, staging=True, inputs=watch) as run:
        sections = REPORTS[report](run)
        if watch:
            sections = {**sections, "input_quality": lambda: watch.result(ctx.spark)}
        return write_bundle(ctx.spark, sections, root, report_scope(ctx, report), fmt, partners.KEYS)
