"""A fact in folders by month: every query with a date range reads the folders of its months only, with equal results."""

from __future__ import annotations

import re

import pytest

from partnerkpi.context import KpiContext
from partnerkpi.plans.registry import QUERIES
from partnerkpi.sources.catalog import MONTH_COLUMN, TABLES, Warehouse, write_fact_by_month
from partnerkpi.sources.schema import SchemaMismatch
from partnerkpi.sources.state_store import inside
from test_plans import plan_text, scans

RANGED = (
    "financial_monthly", "operational_weekly", "failed_orders_monthly", "failed_reasons_weekly", "campaigns_weekly", "top_stores_last_month",
    "city_orders_rank", "business_by_bucket_month", "benchmark_business", "partners_financial", "partners_failed_reasons",
    "partners_top_stores_last_month", "partners_benchmark_business",
)


@pytest.fixture(scope="module")
def contexts(small_ctx, tmp_path_factory):
    small_ctx.release()
    flat = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params)
    fact = write_fact_by_month(flat.wh.fact_order, str(tmp_path_factory.mktemp("by-month") / "fact_order"))
    frames = {t: getattr(flat.wh, t) for t in TABLES} | {"fact_order": fact}
    return flat, KpiContext(flat.spark, Warehouse.from_frames(month_column=MONTH_COLUMN, **frames), flat.params)


@pytest.mark.parametrize("name", RANGED)
def test_folders_are_pruned_and_results_equal(contexts, name):
    flat, by_month = contexts
    df = QUERIES[name](by_month)
    for scan in scans(plan_text(df), "fact_order"):
        filters = next(ln for ln in scan.splitlines() if "PartitionFilters" in ln)
        assert f"({MONTH_COLUMN}#" in filters and ">= 1999" in filters and "<= 1999" in filters, name
        assert "order_date" in next(ln for ln in scan.splitlines() if "PushedFilters" in ln)
    cols = df.columns
    assert sorted(map(str, df.collect())) == sorted(map(str, QUERIES[name](flat).select(cols).collect()))


def test_files_read_are_those_of_the_months(contexts):
    spark, wh = contexts[1].spark, contexts[1].wh
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the executed plan is then open to its leaves
    try:
        import datetime as dt

        for where, months in (
            (wh.ordered_between(dt.date(1999, 4, 1), dt.date(1999, 6, 30)), 3),
            (inside([dt.date(1999, 6, 28)], wh), 2),  # a week in two months
            (inside([dt.date(1999, 6, 7), dt.date(1999, 3, 1)], wh), 2),
        ):
            df = wh.fact_order.where(where).select("order_id")
            df.collect()
            leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert leaf.metrics().apply("numPartitions").value() == months
            total = len(wh.fact_order.inputFiles())
            assert 0 < leaf.metrics().apply("numFiles").value() < total / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_missing_month_column_is_an_error(contexts):
    flat = contexts[0].wh
    with pytest.raises(SchemaMismatch, match="month"):
        Warehouse.from_frames(month_column="none", **{t: getattr(flat, t) for t in TABLES})


def test_column_binding_keeps_the_month_column(contexts):
    wh = contexts[1].wh
    frames = {t: getattr(wh, t) for t in TABLES}
    frames["fact_order"] = frames["fact_order"].withColumnRenamed("gross", "price")
    bound = Warehouse.from_frames(columns={"fact_order": {"gross": "price"}}, month_column=MONTH_COLUMN, **frames)
    assert re.search(MONTH_COLUMN, str(bound.fact_order.schema)) and "gross" in bound.fact_order.columns
