"""Invariants of the workload on the sf0.001 fixture, and staged == unstaged."""

from __future__ import annotations

import math

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from partnerkpi.context import KpiContext
from partnerkpi.functions.calendar import MONTH, date_between
from partnerkpi.operators import period_report, scorecard, stores
from partnerkpi.operators.scope import is_delivered, partner_orders
from partnerkpi.plans.registry import QUERIES


def test_bucket_orders_sum_to_total(small_ctx):
    p = small_ctx.params
    biz = scorecard.business_by_bucket_month(small_ctx).groupBy("month").agg(F.sum("orders").alias("o"))
    direct = (
        partner_orders(small_ctx, is_delivered() & date_between("order_date", p.scorecard_start, p.scorecard_end))
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("o"))
    )
    assert sorted(biz.collect()) == sorted(direct.collect())


def test_delivered_plus_failed_is_total_without_null_state(small_ctx):
    for r in period_report.failed_orders(small_ctx, MONTH).collect():
        assert r["delivered"] + r["failed_total"] == r["total_placed"]


def test_mergeable_pairs_roll_up_to_the_direct_rate(small_ctx):
    q = scorecard.Scorecard(small_ctx).quality
    merged = q.agg((F.sum("late_vw") / F.sum("late_w")).alias("r")).first()["r"]
    sc = scorecard.Scorecard(small_ctx)
    rows = sc._metric_rows(small_ctx.wh.provider_monthly)
    direct = rows.agg((F.sum(F.col("late_value") * F.col("late_weight")) / F.sum("late_weight")).alias("r")).first()
    assert math.isclose(merged, direct["r"], rel_tol=1e-9)


def test_flags_within_bounds(small_ctx):
    for r in stores.store_flags(small_ctx).collect():
        assert 0 <= r["flags"] <= len(stores.DIRECTED)


def test_matrix_is_dense(small_ctx):
    sc = scorecard.Scorecard(small_ctx)
    n_b, n_m = sc.buckets.count(), sc.months.count()
    assert n_m > 0 and sc.matrix.count() == 19 * n_b * n_m


@pytest.mark.parametrize("name", ["financial_weekly", "failed_reasons_monthly", "metric_matrix", "highlights",
                                  "store_cell_class", "acceptance_current"])
def test_staged_equals_unstaged(small_ctx, name):
    raw = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params, staging=False)
    a = sorted(map(tuple, QUERIES[name](small_ctx).collect()), key=str)
    b = sorted(map(tuple, QUERIES[name](raw).collect()), key=str)
    assert a == b


@pytest.mark.parametrize("name", ["financial_monthly", "failed_reasons_weekly", "quality_by_bucket_month",
                                  "benchmark_business", "store_quality", "metric_verdict"])
def test_results_do_not_depend_on_the_join_strategy(small_ctx, name):
    """With broadcasting off, the scopes join by shuffle; results are the same."""
    spark = small_ctx.spark
    raw = KpiContext(spark, small_ctx.wh, small_ctx.params)
    a = sorted(map(tuple, QUERIES[name](raw).collect()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(map(tuple, QUERIES[name](raw).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b


def test_lost_cached_parts_are_recomputed_from_lineage(small_ctx):
    """Dropping every persisted part's blocks (as a lost executor would) changes no result: they recompute from
    their lineage, which starts at the input tables."""
    names = ["financial_monthly", "acceptance_weekly", "metric_matrix", "highlights", "store_flags"]
    before = {n: sorted(map(tuple, QUERIES[n](small_ctx).collect()), key=str) for n in names}
    persisted = [df for df in small_ctx._stages.values() if df.is_cached]
    assert persisted
    for df in persisted:
        df.unpersist(blocking=True)
    after = {n: sorted(map(tuple, QUERIES[n](small_ctx).collect()), key=str) for n in names}
    for df in persisted:  # leave the shared context as it was for later tests
        df.persist(StorageLevel.MEMORY_AND_DISK)
    assert before == after


def test_peer_scope_without_the_partner(small_ctx):
    p = small_ctx.params
    incl = KpiContext(small_ctx.spark, small_ctx.wh, p, staging=False)
    excl = KpiContext(small_ctx.spark, small_ctx.wh, p.with_(peers_exclude_partner=True), staging=False)
    n_incl = scorecard.benchmark_business(incl).first()["orders"]
    n_excl = scorecard.benchmark_business(excl).first()["orders"]
    partner_grocery = (
        partner_orders(incl, is_delivered() & date_between("order_date", p.bench_start, p.bench_end))
        .join(small_ctx.wh.dim_provider.where("is_grocery").select("provider_id"), "provider_id", "left_semi")
        .count()
    )
    assert n_incl - n_excl == partner_grocery


def test_opt_in_approximate_distinct_counts(small_ctx):
    """HLL distinct counts: no Expand rewrite in the plan, estimates within a few percent of the exact counts."""
    import contextlib
    import io

    approx = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params.with_(approx_distinct_rsd=0.02),
                        staging=False)
    df = scorecard.business_by_bucket_month(approx)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "Expand" not in buf.getvalue() and "approx_count_distinct" in buf.getvalue()
    exact = {(r["bucket"], r["month"]): r for r in scorecard.business_by_bucket_month(small_ctx).collect()}
    for r in df.collect():
        e = exact[(r["bucket"], r["month"])]
        for c in ("active_users", "new_users", "merchants"):
            assert abs(r[c] - e[c]) <= max(1, 0.06 * e[c]), (c, r[c], e[c])


@pytest.mark.parametrize(("key", "descending"), [("flags", True), ("late", False), ("rating", True), ("orders", False)])
def test_sliced_store_ranking_equals_one_window_per_bucket(small_ctx, key, descending):
    """Any column and direction, NULLs last, nearly all stores in one bucket, more slices than stores and fewer."""
    from pyspark.sql import Window

    ctx = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params.with_(top_cities=1))
    f = stores.store_flags(ctx)
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    w = Window.partitionBy("bucket").orderBy(order, F.desc("orders"), "addr", "city")
    want = {(r[0], r[1], r[2], r[3]) for r in f.select("bucket", F.row_number().over(w), "addr", "city").collect()}
    for slices in (3, 255):
        got = {(r[0], r[1], r[2], r[3]) for r in stores.store_ranked(ctx, key, descending, slices).collect()}
        assert got == want
