"""Counts of bad input rows: exact over the whole inputs, and taken along by a report without another scan."""

from __future__ import annotations

import builders as b
from partnerkpi.context import KpiContext
from partnerkpi.functions.calendar import MONTH
from partnerkpi.operators import period_report
from partnerkpi.operators.input_quality import InputWatch, input_quality
from partnerkpi.plans.report import publish
from partnerkpi.sources.bundle import read_bundle
from test_plans import plan_text, scans


def found(df):
    return {(r["input"], r["measure"]): r["n"] for r in df.collect() if r["n"]}


def bad_rows(spark):
    day, old = b.d("1999-06-10"), b.d("1990-01-01")
    orders = [
        b.order(1, 2, day), b.order(1, 2, day), b.order(1, 2, day, state=None), b.order(2, 77, day), b.order(3, None, day, gross=None),
        b.order(None, 2, day), b.order(None, 2, day, gross="-1.00"), b.order(5, 2, old, state=None),
    ]
    weekly = [b.weekly(2, b.ts("1999-06-07"), rating=(4.0, 0)), b.weekly(2, b.ts("1999-06-14"), rating=(4.0, None), active=(None, 0))]
    monthly = [b.monthly(2, b.ts("1999-06-01"), late=(0.1, -1))]
    return b.warehouse(spark, [b.provider(2), b.provider(2), b.provider(3)], orders, monthly, weekly, [(1, "r", "a"), (9, "r", "a"), (9, "r", "a"), (None, "r", "a")])


def test_counts_over_the_whole_inputs(spark):
    ctx = b.ctx(spark, bad_rows(spark))
    assert found(input_quality(ctx)) == {
        ("dim_provider", "repeated_provider"): 1, ("fact_order", "rows"): 8, ("fact_order", "null_state"): 2, ("fact_order", "null_provider"): 1,
        ("fact_order", "null_user"): 2, ("fact_order", "null_gross"): 1, ("fact_order", "negative_gross"): 1, ("fact_order", "repeated_order"): 2,
        ("fact_order", "unknown_provider"): 1, ("provider_weekly", "rows"): 2, ("provider_weekly", "rating_without_weight"): 2,
        ("provider_monthly", "rows"): 1, ("provider_monthly", "late_without_weight"): 1, ("resolution", "unknown_order"): 3,
    }


def test_empty_inputs_count_zero(spark):
    assert not found(input_quality(b.ctx(spark, b.warehouse(spark, []))))


def test_a_period_bundle_holds_what_its_own_reading_met(spark, tmp_path):
    ctx = b.ctx(spark, bad_rows(spark))
    publish(ctx, str(tmp_path), "partners", observe=True)
    seen = found(read_bundle(spark, str(tmp_path), "partners")["input_quality"])
    part = "fact_order/both grains"
    assert {k[1]: n for k, n in seen.items() if k[0] == part} == {"rows": 7, "null_state": 1, "null_provider": 1, "null_user": 2, "null_gross": 1, "negative_gross": 1}
    assert {k[1]: n for k, n in seen.items() if k[0] == "provider_weekly/both grains"} == {"rows": 2, "rating_without_weight": 2}


def test_the_watch_adds_no_scan_and_keeps_the_pushed_dates(small_ctx):
    small_ctx.release()
    plain = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params)
    watch = InputWatch()
    seen = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params, inputs=watch)
    df = period_report.orders_mart_plan(seen, MONTH)
    a, b_ = scans(plan_text(period_report.orders_mart_plan(plain, MONTH)), "fact_order"), scans(plan_text(df), "fact_order")
    assert len(a) == len(b_) == 1
    assert "GreaterThanOrEqual(order_date" in b_[0] and "LessThanOrEqual(order_date" in b_[0]
    schema = [next(x for x in s[0].splitlines() if "ReadSchema" in x) for s in (a, b_)]
    assert schema[0] == schema[1]  # no column more
    df.collect()
    p = small_ctx.params
    rows = small_ctx.wh.fact_order.where(small_ctx.wh.ordered_between(p.data_start, p.data_end)).count()
    assert found(watch.result(small_ctx.spark)) == {("fact_order/month", "rows"): rows}
