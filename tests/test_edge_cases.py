"""Edge behaviours of the workload on hand-made rows (inline fixtures, no parquet)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from builders import PARAMS, ctx, d, monthly, order, provider, ts, warehouse, weekly
from partnerkpi.functions.calendar import MONTH
from partnerkpi.operators import buckets, highlights, period_report, scorecard, stores


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_null_state_is_placed_but_neither_delivered_nor_failed(spark):
    wh = warehouse(spark, [provider(2)], [
        order(1, 2, d("1999-03-02")),
        order(2, 2, d("1999-03-03"), state=None),
        order(3, 2, d("1999-03-04"), state="rejected"),
    ])
    out = period_report.failed_orders(ctx(spark, wh), MONTH)
    assert rows(out, "period", "total_placed", "delivered", "failed_total", "failed_rate_pct") == [
        ("1999-03", 3, 1, 1, 33.333333)
    ]


def test_null_flag_counts_as_zero_and_null_minutes_are_skipped(spark):
    wh = warehouse(spark, [provider(2)], [
        order(1, 2, d("1999-03-02"), honey=True, courier=20.0),
        order(2, 2, d("1999-03-03"), honey=None, courier=None),
        order(3, 2, d("1999-03-04"), honey=False, courier=40.0),
    ])
    out = period_report.operational(ctx(spark, wh), MONTH)
    assert rows(out, "honey_order_rate", "avg_courier_delivery_min") == [(33.333333, 30.0)]


def test_price_per_order_counts_rows_with_null_price(spark):
    wh = warehouse(spark, [provider(2)], [
        order(1, 2, d("1999-03-02"), gross="10.00"),
        order(2, 2, d("1999-03-03"), gross=None),
    ])
    out = period_report.financial(ctx(spark, wh), MONTH)
    assert rows(out, "orders", "merchant_price", "merchant_price_per_order") == [(2, 10.0, 5.0)]


def test_weighted_rate_zero_weights_and_null_values(spark):
    wh = warehouse(spark, [provider(2)], weekly_rows=[
        # March: only zero weights -> NULL
        weekly(2, ts("1999-03-01"), adjustment=(0.2, 0), replacement=(None, 0)),
        # April: NULL value keeps its weight in the denominator: 0.5*10 / 20
        weekly(2, ts("1999-04-05"), adjustment=(None, 10), replacement=(0.5, 10)),
        weekly(2, ts("1999-04-12"), adjustment=(0.5, 10), replacement=(0.5, 10)),
    ])
    out = period_report.replacement_adjustment(ctx(spark, wh), MONTH)
    assert rows(out, "period", "adjustment_rate", "replacement_rate") == [
        ("1999-03", None, None),
        ("1999-04", 25.0, 50.0),
    ]


def test_week_rows_go_to_the_month_of_their_stamp_and_orders_split_by_date(spark):
    wh = warehouse(spark, [provider(2)],
                   [order(1, 2, d("1999-05-31")), order(2, 2, d("1999-06-01"))],
                   weekly_rows=[weekly(2, ts("1999-05-31"), adjustment=(0.1, 10))])
    c = ctx(spark, wh)
    assert rows(period_report.replacement_adjustment(c, MONTH), "period", "adjustment_rate") == [("1999-05", 10.0)]
    assert rows(period_report.financial(c, MONTH), "period", "orders") == [("1999-05", 1), ("1999-06", 1)]


def test_two_resolutions_on_one_order_count_twice(spark):
    wh = warehouse(spark, [provider(2)], [order(1, 2, d("1999-03-02"), state="cancelled")],
                   resolutions=[(1, "item_unavailable", "client"), (1, "item_unavailable", "client")])
    out = period_report.failed_reasons(ctx(spark, wh), MONTH)
    assert rows(out, "period", "reason", "actor_type", "cnt") == [("1999-03", "item_unavailable", "client", 2)]


def test_empty_scope_global_aggregates_return_one_row(spark):
    wh = warehouse(spark, [provider(2)], [order(1, 2, d("1999-06-02"))],
                   weekly_rows=[weekly(2, ts("1999-07-12"))])
    c = ctx(spark, wh, PARAMS.with_(partner_group="PX", country="zz"))
    assert rows(period_report.acceptance_current(c), "acceptance_rate", "availability_rate", "avg_rating") == [
        (None, None, None)
    ]
    assert rows(scorecard.benchmark_business(c), "orders", "gmv_eur", "merchants") == [(0, None, 0)]
    assert rows(scorecard.benchmark_quality(c), "minutes", "rating") == [(None, None)]
    assert rows(scorecard.benchmark_adjustment(c), "adjustment") == [(None,)]
    assert period_report.financial(c, MONTH).count() == 0


def _scorecard_wh(spark, cities, month_orders):
    """One provider per city; ``month_orders[month] -> orders per provider`` delivered in that month."""
    provs = [provider(2 * (i + 1), city=c) for i, c in enumerate(cities)]
    orders, oid = [], 1
    for month, n in month_orders.items():
        for p in provs:
            for k in range(n):
                orders.append(order(oid, p["provider_id"], d(f"{month}-1{k % 9}"), city=p["city_name"], user=oid))
                oid += 1
    return warehouse(spark, provs, orders)


def test_null_city_goes_to_other_and_fewer_than_n_cities_leave_other_empty(spark):
    wh = warehouse(spark, [provider(2, city="A"), provider(4, city=None)], [
        order(1, 2, d("1999-04-02"), city="A"),
        order(2, 4, d("1999-04-03"), city=None),
    ])
    c = ctx(spark, wh)
    assert rows(buckets.city_bucket(c).orderBy("bucket_ord"), "bucket", "bucket_ord") == [("A", 1), ("other", 5)]
    biz = rows(scorecard.business_by_bucket_month(c).orderBy("bucket"), "bucket", "orders")
    assert biz == [("A", 1), ("other", 1)]

    wh2 = warehouse(spark, [provider(2, city="A")], [order(1, 2, d("1999-04-02"), city="A")])
    c2 = ctx(spark, wh2)
    assert rows(scorecard.business_by_bucket_month(c2), "bucket") == [("A",)]
    # the other bucket is still a row of the dense matrix, with NULL values
    m = scorecard.metric_matrix(c2).where(F.col("bucket") == "other")
    assert m.count() == 19 and m.where(F.col("value").isNotNull()).count() == 0


def test_populated_month_threshold_is_inclusive(spark):
    wh = _scorecard_wh(spark, ["A"], {"1999-04": 2, "1999-05": 1})
    c = ctx(spark, wh, PARAMS.with_(min_month_orders=2))
    assert rows(scorecard.populated_months(c), "month", "orders") == [("1999-04", 2)]


def test_trend_needs_two_months_and_reports_growth(spark):
    one = ctx(spark, _scorecard_wh(spark, ["A"], {"1999-04": 2}))
    assert highlights.highlight_orders_trend(one).count() == 0
    two = ctx(spark, _scorecard_wh(spark, ["A"], {"1999-04": 2, "1999-06": 3}))
    r = highlights.highlight_orders_trend(two).where(F.col("bucket") == "A").first()
    assert (r["first_value"], r["last_value"], r["level"], r["pct"]) == (2.0, 3.0, "win", 50)
    assert r["text"] == "Orders 2→3 (1999-04→1999-06), growth 50%."


def test_provider_in_two_cities_orders_by_own_city_quality_by_max_city(spark):
    wh = warehouse(spark, [provider(2, city="B")], [
        order(1, 2, d("1999-04-02"), city="A"),
        order(2, 2, d("1999-04-03"), city="B"),
    ], monthly_rows=[monthly(2, ts("1999-04-01"))])
    c = ctx(spark, wh)
    assert sorted(rows(scorecard.business_by_bucket_month(c), "bucket", "orders")) == [("A", 1), ("B", 1)]
    assert rows(scorecard.quality_by_bucket_month(c), "bucket") == [("B",)]


def test_verdict_rules(spark):
    df = spark.createDataFrame(
        [(105.0, 100.0, 1), (106.0, 100.0, -1), (1.0, 0.0, 1), (0.0, 0.0, -1), (None, 1.0, 1), (1.0, None, 1),
         (94.0, 100.0, 1)],
        "a double, b double, d long",
    )
    v, t = scorecard.verdict_columns(F.col("a"), F.col("b"), F.col("d"), 0.05)
    got = rows(df.select(v.alias("v"), t.alias("t")), "v", "t")
    assert got == [("par", "eq"), ("above", "down"), ("above", "up"), ("below", "up"), (None, "eq"), (None, "eq"),
                   ("below", "down")]


def test_cell_class_ties_are_good_and_null_benchmark_has_no_class(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1), (1.0, 1.0, -1), (0.9, 1.0, 1), (None, 1.0, 1), (1.0, None, -1),
                                (1.0, 1.0, 0)], "v double, b double, d long")
    got = rows(df.select(scorecard.good_or_bad(F.col("v"), F.col("b"), F.col("d")).alias("c")), "c")
    assert got == [("good",), ("good",), ("bad",), (None,), (None,), (None,)]


def _stores_df(spark, values):
    cols = ["addr", "city", "bucket"] + stores.STORE_KEYS
    data = []
    for i, v in enumerate(values):
        row = {k: None for k in stores.STORE_KEYS}
        row.update(v)
        data.append((f"s{i}", "A", "A") + tuple(row[k] for k in stores.STORE_KEYS))
    schema = "addr string, city string, bucket string, orders bigint, " + ", ".join(
        f"{k} double" for k in stores.STORE_KEYS[1:]
    )
    return spark.createDataFrame(data, schema).select(*cols)


@pytest.mark.parametrize("n, expected", [(4, 2.5), (5, 3.0)])
def test_median_even_and_odd(spark, n, expected):
    s = _stores_df(spark, [{"orders": i + 1, "dur": float(i + 1)} for i in range(n)])
    c = ctx(spark, warehouse(spark, [provider(2)]))
    m = stores.store_medians(c, s).first()
    assert (m["orders"], m["dur"], m["late"]) == (expected, expected, None)


def test_flags_ties_not_flagged_null_never_counts(spark):
    s = _stores_df(spark, [
        {"orders": 1, "late": 10.0, "compl": 90.0},
        {"orders": 2, "late": 20.0, "compl": 80.0},
        {"orders": 3, "late": 30.0, "compl": None},
    ])
    c = ctx(spark, warehouse(spark, [provider(2)]))
    f = dict(rows(stores.store_flags(c, s), "addr", "flags"))
    # medians: late 20, compl 85 -> s0 none worse; s1 late = median (not worse), compl 80 < 85 -> 1; s2 late > 20
    assert f == {"s0": 0, "s1": 1, "s2": 1}


def test_severity_tiers(spark):
    c = ctx(spark, warehouse(spark, [provider(2)]))
    df = spark.createDataFrame([(3,), (4,), (5,), (6,)], "flags long")
    got = [r[0] for r in df.select(stores.severity(c, F.col("flags"))).collect()]
    assert got == [0, 1, 1, 2]


def _store_wh(spark):
    provs = [provider(2, name="Shop", city="A"), provider(4, name="Shop", city="A"),
             provider(6, name="Solo", city="A"), provider(8, name="Empty", city="A")]
    orders = [order(i, p["provider_id"], d("1999-04-02"), city="A", name=p["provider_name"])
              for i, p in enumerate(provs, start=1)]
    months = [monthly(2, ts("1999-04-01"), delivered=5, late=(0.1, 10)),
              monthly(4, ts("1999-05-01"), delivered=5, late=(None, 10)),
              monthly(6, ts("1999-04-01"), delivered=3, late=(0.3, 10), rating=(None, 0)),
              monthly(8, ts("1999-04-01"), delivered=0)]
    weeks = [weekly(2, ts("1999-04-05"), adjustment=(0.1, 10)), weekly(4, ts("1999-05-03"), adjustment=(0.3, 10))]
    return warehouse(spark, provs, orders, months, weeks)


def test_store_merge_max_replacement_missing_weekly_and_zero_delivered(spark):
    c = ctx(spark, _store_wh(spark))
    got = {r["addr"]: r for r in stores.store_quality(c).collect()}
    assert set(got) == {"Shop", "Solo"}  # 'Empty' has no delivered order
    assert got["Shop"]["orders"] == 10 and got["Shop"]["replacement"] == 30.0
    assert got["Shop"]["late"] == 5.0  # (0.1*10 + NULL) / (10 + 10) * 100
    assert got["Solo"]["replacement"] is None and got["Solo"]["rating"] is None


def test_ranking_puts_nulls_last_both_ways(spark):
    c = ctx(spark, _store_wh(spark))
    for desc in (True, False):
        r = rows(stores.store_ranked(c, "rating", descending=desc), "addr")
        assert r[-1] == ("Solo",)


def test_worst_stores_treat_null_late_as_zero(spark):
    c = ctx(spark, warehouse(spark, [provider(2)]), PARAMS.with_(worst_stores=2))
    flags = spark.createDataFrame(
        [("a", "A", "A", 9, None, 3), ("b", "A", "A", 1, 0.5, 3), ("c", "A", "A", 5, None, 3), ("d", "A", "A", 1, 9.0, 2)],
        "addr string, city string, bucket string, orders bigint, late double, flags bigint",
    )
    # equal flags: b (late 0.5) before a and c (late NULL = 0); a before c by orders
    assert rows(stores.worst_stores(c, flags), "addr") == [("b",), ("a",)]


def test_trend_pct_is_zero_when_the_first_value_is_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0), (8.0, 7.0), (2.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(highlights.trend_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 25, 13, 0]  # 12.5 rounds half-up to 13


def test_gap_order_by_distance_ranks_relative_distance(spark):
    from partnerkpi.operators.scorecard import Scorecard

    means = spark.createDataFrame(
        [("A", 11, "Total Delivery Time", 60.0, 40.0, -1, "min"), ("A", 12, "Late Delivery 10+", 30.0, 10.0, -1, "pct"),
         ("A", 19, "Rating", 1.0, 4.0, 1, "dec")],
        "bucket string, metric_ord bigint, metric_key string, mean_value double, bench double, dir bigint, fmt string",
    ).withColumn("metric_group", F.lit("quality"))

    class Fixed(Scorecard):
        means = None

    for order_by, want in (("mean", ["Total Delivery Time", "Late Delivery 10+", "Rating"]),
                           ("distance", ["Late Delivery 10+", "Rating", "Total Delivery Time"])):
        c = ctx(spark, warehouse(spark, [provider(2)]), PARAMS.with_(gap_order=order_by))
        sc = Fixed(c)
        sc.means = means
        got = [r["metric_key"] for r in highlights.quality_gaps(c, sc).orderBy("gap_rank").collect()]
        assert got == want


def test_a_store_renamed_after_as_of_counts_under_its_latest_largest_name(spark):
    """The city map reads the whole order history: rows after ``as_of`` and without a date too."""
    from partnerkpi.operators.buckets import provider_city_map

    wh = warehouse(
        spark,
        [provider(1)],
        orders=[order(1, 1, d("1999-05-03"), city="A"), order(2, 1, d("2001-01-01"), city="Z"), order(3, 1, None, city="B")],
    )
    assert [tuple(r) for r in provider_city_map(ctx(spark, wh)).collect()] == [(1, "Z")]


def test_the_rolling_snapshot_has_no_upper_bound(spark):
    from partnerkpi.operators.period_report import acceptance_current

    wh = warehouse(
        spark,
        [provider(1)],
        weekly_rows=[weekly(1, ts("1999-07-12"), acceptance=(1.0, 10)), weekly(1, ts("1999-08-02"), acceptance=(0.0, 10))],
    )
    assert acceptance_current(ctx(spark, wh)).first()["acceptance_rate"] == 50.0
