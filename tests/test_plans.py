"""Physical-plan checks on the path that the registered queries take (no staging), over written inputs."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from partnerkpi.context import KpiContext
from partnerkpi.operators import buckets, stores
from partnerkpi.plans.registry import QUERIES


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def raw_ctx(small_ctx):
    small_ctx.release()  # Spark answers equal plans from what a staging run has persisted
    return KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params)


def scans(txt: str, table: str) -> list[str]:
    return [b for b in txt.split("\n\n") if "Scan parquet" in b and f"/{table}]" in b]


def test_fact_scan_prunes_columns_and_pushes_the_date_range(raw_ctx):
    wanted = {
        "financial_monthly": {"gross", "gmv", "gmv_eur", "refunded", "is_first", "user_id", "order_state"},
        "operational_weekly": {"is_honey", "is_bad", "is_late", "is_late_pickup", "delivery_minutes", "courier_minutes", "order_state"},
        "failed_orders_monthly": {"order_state"},
        "failed_reasons_weekly": {"order_id", "order_state"},
        "city_orders_rank": {"city_name", "order_state"},
        "benchmark_business": {"gmv_eur", "user_id", "is_first", "order_state"},
    }
    for name, cols in wanted.items():
        for scan in scans(plan_text(QUERIES[name](raw_ctx)), "fact_order"):
            pushed = [ln for ln in scan.splitlines() if "PushedFilters" in ln][0]
            assert "GreaterThanOrEqual(order_date" in pushed and "LessThanOrEqual(order_date" in pushed, name
            read = [ln for ln in scan.splitlines() if "ReadSchema" in ln][0]
            assert set(re.findall(r"(\w+):", read.split("struct<")[1])) == cols | {"order_date", "provider_id"}, name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_registered_plan(raw_ctx, name):
    """No Python, no cross product, and no exchange of raw rows below the first partial aggregate."""
    txt = plan_text(QUERIES[name](raw_ctx))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "REBALANCE", "REPARTITION"):
        assert bad not in txt, f"{name}: {bad}"
    for scan_of in ("fact_order", "provider_monthly", "provider_weekly"):
        for path in paths_up(QUERIES[name](raw_ctx), scan_of):
            below = path[: next((i for i, n in enumerate(path) if "Aggregate" in n or "Join" in n and "Broadcast" not in n), len(path))]
            assert not any(n.startswith("Exchange") for n in below), (name, path)


def paths_up(df, table: str, exchanges: bool = False) -> list[list[str]]:
    """Node names from each scan of a table up to the root; with ``exchanges`` in the plan that AQE starts from."""
    out: list[list[str]] = []

    def walk(node, above):
        name = str(node.nodeName())
        if "Scan parquet" in name and re.search(rf"/{table}\]|\.{table}\b", f"{name}\n{node.verboseStringWithOperatorId()}"):
            out.append(above)
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i), [name, *above])

    plan = df._jdf.queryExecution().sparkPlan()
    if exchanges:
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.initialPlan() if str(plan.nodeName()) == "AdaptiveSparkPlan" else plan
    walk(plan, [])
    return out


def test_building_a_query_runs_no_job(raw_ctx):
    tracker = raw_ctx.spark.sparkContext.statusTracker()
    raw_ctx.spark.sparkContext.setJobGroup("build-only", "plans only")
    for fn in QUERIES.values():
        fn(raw_ctx).schema
    assert not tracker.getJobIdsForGroup("build-only")
    raw_ctx.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_city_map_dedupes_with_a_hash_aggregate_before_the_string_max(raw_ctx):
    txt = plan_text(buckets.provider_city_history(raw_ctx))
    tree = txt.split("\n\n\n")[0]
    assert tree.index("SortAggregate") < tree.index("HashAggregate")  # hash distinct sits below the sort aggregate


def test_store_ranking_never_groups_by_bucket_alone(raw_ctx):
    txt = plan_text(stores.store_ranked(raw_ctx))
    assert not re.search(r"Arguments: \[row_number\(\)[^\n]*windowspecdefinition\(bucket#\d+, place", txt)
    assert re.search(r"row_number\(\) windowspecdefinition\(bucket#\d+, slice#\d+", txt)


def test_families_of_a_staging_run_share_the_mart(small_ctx):
    for name in ("financial_weekly", "operational_weekly", "failed_orders_weekly", "campaigns_weekly"):
        QUERIES[name](small_ctx).collect()  # the persisted mart is materialized by the first use
        assert "InMemoryTableScan" in plan_text(QUERIES[name](small_ctx)).split("\n\n\n")[0]
