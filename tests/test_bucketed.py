"""Fact and resolutions in buckets by order id: no exchange below their join, equal results, a hot order, months as folders."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

import builders as b
from partnerkpi.context import KpiContext
from partnerkpi.functions.calendar import MONTH, WEEK
from partnerkpi.operators import period_report
from partnerkpi.plans.registry import QUERIES
from partnerkpi.sources.catalog import MONTH_COLUMN, write_bucketed
from test_plans import paths_up, plan_text, scans


def names():
    u = uuid.uuid4().hex
    return f"fact_order_{u}", f"resolution_{u}"


@pytest.fixture(params=[False, True], ids=["plain", "by-month"])
def bucketed(request, small_ctx, tmp_path):
    small_ctx.release()
    spark = small_ctx.spark
    tables = names()
    wh = write_bucketed(small_ctx.wh, 6, tables, str(tmp_path), month=request.param)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shape of the plan where no side is small
    yield KpiContext(spark, wh, small_ctx.params), tables, request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for t in tables:
        spark.sql(f"DROP TABLE {t}")


def test_no_exchange_below_the_join(bucketed, small_ctx):
    ctx, tables, by_month = bucketed
    flat = KpiContext(ctx.spark, small_ctx.wh, ctx.params)
    for name in ("failed_reasons_monthly", "failed_reasons_weekly", "partners_failed_reasons"):
        df = QUERIES[name](ctx)
        for t in tables:
            found = paths_up(df, t, exchanges=True)
            assert found, (name, t)
            for path in found:
                assert any("Exchange" in n for n in path), path  # above the join there are some
                join = next(i for i, n in enumerate(path) if n.startswith("SortMergeJoin"))
                assert not any("Exchange" in n for n in path[:join]), (name, t, path)
        if by_month:
            for scan in scans(plan_text(df), tables[0]):
                assert MONTH_COLUMN in next(ln for ln in scan.splitlines() if "PartitionFilters" in ln)
        want = QUERIES[name](flat)
        assert sorted(map(str, df.select(want.columns).collect())) == sorted(map(str, want.collect())) != []


def test_other_queries_read_the_bucketed_fact_as_any(bucketed, small_ctx):
    ctx = bucketed[0]
    flat = KpiContext(ctx.spark, small_ctx.wh, ctx.params)
    for name in ("financial_monthly", "top_stores_last_month", "city_orders_rank"):
        assert sorted(map(str, QUERIES[name](ctx).collect())) == sorted(map(str, QUERIES[name](flat).collect()))


def test_a_hot_order_and_null_ids(spark, tmp_path):
    day = b.d("1999-06-10")
    orders = [b.order(1, 2, day, "rejected"), b.order(2, 2, day, "cancelled"), b.order(3, 2, day), b.order(None, 2, day, "rejected"), b.order(4, 9, day, "rejected")]
    wh = b.warehouse(spark, [b.provider(2), b.provider(9, group="P1")], orders)
    hot = spark.range(200_000).select(F.lit(1).cast("long").alias("order_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("reason"), F.lit("x").alias("actor_type"))
    few = spark.createDataFrame([(2, None, "x"), (2, None, "x"), (3, "a", "x"), (None, "a", "x"), (4, "a", "x")], "order_id long, reason string, actor_type string")
    resolution = hot.unionAll(few)
    tables = names()
    plain = b.ctx(spark, type(wh)(**{**wh.__dict__, "resolution": resolution}))
    bucketed = b.ctx(spark, write_bucketed(plain.wh, 4, tables, str(tmp_path)))
    for grain in (MONTH, WEEK):
        got = [tuple(r) for r in period_report.failed_reasons(bucketed, grain).collect()]
        assert got == [tuple(r) for r in period_report.failed_reasons(plain, grain).collect()]
    assert sorted(r[3] for r in period_report.failed_reasons(bucketed, MONTH).collect()) == [2, 50_000, 150_000]
    for t in tables:
        spark.sql(f"DROP TABLE {t}")
