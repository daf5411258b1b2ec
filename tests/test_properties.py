"""Property tests: random hand-made order rows, Spark results against a brute-force Python computation."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from builders import ctx, order, provider, warehouse
from partnerkpi.functions.calendar import MONTH
from partnerkpi.operators import period_report, stores
from partnerkpi.params import FIXTURE_PARAMS

PARAMS = FIXTURE_PARAMS.with_()
START = date(1998, 12, 20)  # a little before the monthly window, so the window edge is exercised

row_st = st.tuples(
    st.integers(0, 230),  # day offset
    st.sampled_from(["delivered", "delivered", "rejected", "cancelled", None]),
    st.integers(1, 12),  # user
    st.one_of(st.none(), st.decimals(min_value=0, max_value=500, places=2, allow_nan=False)),  # gross
    st.one_of(st.none(), st.booleans()),  # first
    st.sampled_from([2, 4, 5]),  # provider (5 is outside the partner group)
)


def _brute(rows):
    by = defaultdict(lambda: {"n": 0, "dl": 0, "failed": 0, "gross": None, "users": set(), "first": set()})
    for off, state, user, gross, first, pid in rows:
        d = START + timedelta(days=off)
        if pid == 5 or not (PARAMS.data_start <= d <= PARAMS.data_end):
            continue
        b = by[d.strftime("%Y-%m")]
        b["n"] += 1
        if state is not None and state != "delivered":
            b["failed"] += 1
        if state == "delivered":
            b["dl"] += 1
            b["users"].add(user)
            if first:
                b["first"].add(user)
            if gross is not None:
                b["gross"] = (b["gross"] or Decimal(0)) + gross
    return by


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_st, min_size=1, max_size=40))
def test_financial_and_failed_match_brute_force(spark, rows):
    provs = [provider(2), provider(4), provider(5, group="P1")]
    orders = [order(i, pid, START + timedelta(days=off), state=state, user=user, gross=gross, first=first)
              for i, (off, state, user, gross, first, pid) in enumerate(rows, start=1)]
    c = ctx(spark, warehouse(spark, provs, orders), PARAMS)
    want = _brute(rows)

    got_failed = {r["period"]: r for r in period_report.failed_orders(c, MONTH).collect()}
    assert set(got_failed) == set(want)
    for p, r in got_failed.items():
        assert (r["total_placed"], r["delivered"], r["failed_total"]) == (want[p]["n"], want[p]["dl"], want[p]["failed"])

    got_fin = {r["period"]: r for r in period_report.financial(c, MONTH).collect()}
    assert set(got_fin) == {p for p, b in want.items() if b["dl"] > 0}
    for p, r in got_fin.items():
        b = want[p]
        assert r["orders"] == b["dl"]
        assert r["active_users"] == len(b["users"]) and r["users_activated"] == len(b["first"])
        assert r["merchant_price"] == (None if b["gross"] is None else float(b["gross"]))
        exp_ppo = None if b["gross"] is None else round(float(b["gross"]) / b["dl"], 6)
        assert (r["merchant_price_per_order"] is None) == (exp_ppo is None)
        if exp_ppo is not None:
            assert abs(r["merchant_price_per_order"] - exp_ppo) <= 1e-6


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 100)), min_size=1, max_size=15), st.randoms())
def test_median_is_order_free_and_exact(spark, values, rnd):
    shuffled = list(values)
    rnd.shuffle(shuffled)
    schema = "addr string, city string, bucket string, orders bigint, " + ", ".join(
        f"{k} double" for k in stores.STORE_KEYS[1:])
    data = [(f"s{i}", "A", "A", 1) + ((None if v is None else float(v)),) + (None,) * 8 for i, v in enumerate(shuffled)]
    df = spark.createDataFrame(data, schema)
    c = ctx(spark, warehouse(spark, [provider(2)]))
    got = stores.store_medians(c, df).first()["dur"]
    vals = sorted(v for v in values if v is not None)
    if not vals:
        assert got is None
    else:
        m = len(vals) // 2
        want = vals[m] if len(vals) % 2 else (vals[m - 1] + vals[m]) / 2
        assert got == want
