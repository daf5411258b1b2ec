"""Maintained day states: a refresh of the changed weeks equals the full recompute, whatever happened in between."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from partnerkpi.context import KpiContext
from partnerkpi.operators import partners, states
from partnerkpi.plans.registry import FROM_STATES, QUERIES
from partnerkpi.sources import state_store
from partnerkpi.sources.state_store import StateStore, inside, monday, weeks_between
from test_plans import plan_text, scans

#: Results compared after each change; they cover sums, both distinct counts, MAX names, top stores, reasons and benchmarks.
COMPARED = ("financial", "operational", "failed_reasons", "provider_city_map", "business_by_bucket_month", "benchmark_business", "highlights")


@pytest.fixture(scope="module")
def raw_ctx(small_ctx):
    small_ctx.release()
    return KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params)


def rows(df) -> list:
    return sorted(str(r.asDict()) for r in df.collect())


def replaced(wh, **tables):
    return type(wh)(**{**wh.__dict__, **tables})


def assert_equal(ctx, store: StateStore, wh) -> None:
    with KpiContext(ctx.spark, wh, ctx.params, staging=True) as a, KpiContext(ctx.spark, wh, ctx.params, staging=True) as b:
        folded, full = states.StatePartners(a, store.frames()), partners.AllPartners(b)
        for name in COMPARED:
            assert rows(folded.result(name)) == rows(full.result(name)), name


def test_refreshes_equal_the_full_recompute(raw_ctx, tmp_path, monkeypatch):
    spark, wh = raw_ctx.spark, raw_ctx.wh
    fact = wh.fact_order
    span = fact.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).first()
    every = weeks_between(span["a"], span["b"])
    last, late = monday(date(1999, 7, 5)), monday(date(1999, 5, 12))
    deleted = monday(date(1999, 6, 16))
    in_late = (F.col("order_date") >= late) & (F.col("order_date") < late + timedelta(days=7))
    before = replaced(wh, fact_order=fact.where((F.col("order_date") < last) & ~(in_late & (F.col("order_id") % 2 == 0))))
    store = StateStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.frames()
    store.refresh(before, every)
    assert_equal(raw_ctx, store, before)

    # a refresh that is lost before its manifest changes nothing, and is repeated without harm
    now = replaced(wh, fact_order=fact.where(F.col("order_date") < last + timedelta(days=7)))
    with monkeypatch.context() as lost:
        lost.setattr(state_store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            store.refresh(now, [last, late])
    assert_equal(raw_ctx, store, before)
    for _ in range(2):  # one new week and the week of late rows; sent twice
        assert store.refresh(now, [last + timedelta(days=3), late]) == [late, last]
    assert_equal(raw_ctx, StateStore(spark, str(tmp_path)), now)

    # a week whose rows all went
    gone = replaced(wh, fact_order=now.fact_order.where((F.col("order_date") < deleted) | (F.col("order_date") >= deleted + timedelta(days=7))))
    store.refresh(gone, [deleted])
    assert deleted not in store.weeks()
    assert_equal(raw_ctx, store, gone)

    # a provider that moves to another partner: the weeks with its orders are derived anew, without being named
    moved = fact.where("order_date >= '1999-06-01'").agg(F.min("provider_id")).first()[0]
    dim = wh.dim_provider.withColumn("group_name", F.when(F.col("provider_id") == moved, "P9").otherwise(F.col("group_name")))
    other = replaced(gone, dim_provider=dim)
    assert store.refresh(other, [])
    assert_equal(raw_ctx, store, other)
    assert store.refresh(other, []) == []


def test_a_refresh_reads_its_week_only(raw_ctx):
    week = date(1999, 6, 14)
    for name, frame in states.state_frames(raw_ctx.wh, inside([week])).items():
        for scan in scans(plan_text(frame), "fact_order"):
            pushed = next(ln for ln in scan.splitlines() if "PushedFilters" in ln)
            assert "GreaterThanOrEqual(order_date,1999-06-14)" in pushed and "LessThanOrEqual(order_date,1999-06-20)" in pushed, name


def test_ranges_of_weeks():
    days = [date(1999, 6, 15), date(1999, 6, 23), date(1999, 3, 1)]
    text = str(inside(monday(d) for d in days))
    assert text.count(">=") == 2  # two stretches
    assert weeks_between(date(1999, 6, 20), date(1999, 6, 21)) == [date(1999, 6, 14), date(1999, 6, 21)]


def test_no_distinct_and_no_expand_in_plans_from_states(raw_ctx):
    for name in FROM_STATES:
        txt = plan_text(QUERIES[name](raw_ctx))
        assert "Expand" not in txt and "distinct" not in txt.lower().replace("distinct=", ""), name


def test_bitmaps_merge_over_buckets_and_days(spark, raw_ctx):
    """Ids on both sides of bucket borders, repeated over days, null ids and new users among them."""
    ids = [0, 1, 32768, 32769, 65536, 65537, 10**9, 10**9, None]
    one = raw_ctx.wh.fact_order.where("order_state = 'delivered'").limit(1).drop("user_id", "order_date", "is_first")
    users = spark.createDataFrame([(i, date(1999, 6, 14 + k % 3), k % 2 == 0) for k, i in enumerate(ids)], "user_id long, order_date date, is_first boolean")
    fact = one.join(users).select(raw_ctx.wh.fact_order.columns)
    rows_ = states.StatePartners._users(states.user_days(replaced(raw_ctx.wh, fact_order=fact)).withColumn("m", F.lit(1)), ["m"]).first()
    want = {i for i in ids if i is not None}, {i for k, i in enumerate(ids) if i is not None and k % 2 == 0}
    assert (rows_["active_users"], rows_["new_users"]) == tuple(map(len, want))
