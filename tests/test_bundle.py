"""Bundles appear whole or not at all, and all partners come out of one run."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from partnerkpi.context import KpiContext
from partnerkpi.operators import partners
from partnerkpi.plans import report
from partnerkpi.plans.registry import QUERIES
from partnerkpi.sources.bundle import NoBundle, expire, manifests, read_bundle, write_bundle
from test_plans import plan_text, scans


def frames(spark, n: int) -> dict:
    return {name: spark.range(3).select(F.lit(n).alias("run"), "id") for name in ("a", "monthly/b", "c")}


def runs(bundle: dict) -> set:
    return {r["run"] for df in bundle.values() for r in df.collect()}


def test_a_run_that_fails_between_sections_leaves_the_old_bundle(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(NoBundle):
        read_bundle(spark, root, "s")
    write_bundle(spark, frames(spark, 1), root, "s")
    broken = frames(spark, 2)
    broken["c"] = broken["c"].withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_bundle(spark, broken, root, "s")
    old = read_bundle(spark, root, "s")
    assert set(old) == {"a", "monthly/b", "c"} and runs(old) == {1}
    write_bundle(spark, frames(spark, 3), root, "s")
    assert runs(read_bundle(spark, root, "s")) == {3}
    assert runs(old) == {1}  # a reader of the old run goes on undisturbed
    assert manifests(spark, root).count() == 2


def test_a_lost_manifest_write_is_no_bundle(spark, tmp_path):
    """What a driver leaves that dies while it writes the manifest: task output that was never committed."""
    write_bundle(spark, frames(spark, 1), str(tmp_path), "s")
    half = tmp_path / "manifests" / "dead" / "_temporary" / "0"
    half.mkdir(parents=True)
    (half / "part-0.json").write_text(json.dumps({"scope": "s", "seq": 9, "run_id": "dead", "sections": []}))
    assert runs(read_bundle(spark, str(tmp_path), "s")) == {1}


def test_scopes_and_expiry(spark, tmp_path):
    root = str(tmp_path)
    ids = [write_bundle(spark, frames(spark, n), root, "s") for n in range(4)]
    other = write_bundle(spark, frames(spark, 9), root, "t")
    (tmp_path / "runs" / "unnamed").mkdir()
    assert sorted(expire(spark, root, keep=2)) == sorted(ids[:2])
    assert {p.name for p in (tmp_path / "runs").iterdir()} == {*ids[2:], other, "unnamed"}
    assert expire(spark, root, keep=2, unnamed=True) == ["unnamed"]
    assert runs(read_bundle(spark, root, "s")) == {3} and runs(read_bundle(spark, root, "t")) == {9}


def rows(df) -> list:
    return sorted((str(r.asDict()) for r in df.collect()))


@pytest.fixture(scope="module")
def raw_ctx(small_ctx):
    small_ctx.release()
    return KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params)


def test_published_partners_hold_what_each_single_run_gives(small_ctx, tmp_path):
    report.publish(small_ctx, str(tmp_path), "partners")
    every = read_bundle(small_ctx.spark, str(tmp_path), "partners")
    assert set(every) == {*partners.PERIOD, *partners.PER_PARTNER, *partners.PER_COUNTRY}
    for country, group in (("xa", "P0"), ("xb", "P1")):
        ctx = KpiContext(small_ctx.spark, small_ctx.wh, small_ctx.params.with_(country=country, partner_group=group), staging=True)
        mine = (F.col("country_code") == country) & (F.col("partner_group") == group)
        for name in ("financial_monthly", "failed_reasons_weekly", "metric_verdict", "highlights", "store_ranked", "worst_stores"):
            family, _, last = name.rpartition("_")
            grain = {"monthly": "month", "weekly": "week"}.get(last)
            got = every[family if grain else name].where(mine & (F.col("grain") == grain) if grain else mine)
            single = QUERIES[name](ctx)
            assert rows(got.select(*single.columns)) == rows(single), (name, country, group)
        ctx.release()


def test_a_single_report_as_a_bundle(small_ctx, tmp_path):
    report.publish(small_ctx, str(tmp_path), "period")
    got = read_bundle(small_ctx.spark, str(tmp_path), "period/xa/P0")
    assert len(got) == 17 and got["meta"].first()["partner_group"] == "P0"


def test_both_grains_of_all_partners_take_one_scan_of_the_fact(raw_ctx):
    for name in ("financial", "operational", "failed_orders", "campaigns", "failed_reasons"):
        found = scans(plan_text(QUERIES[f"partners_{name}"](raw_ctx)), "fact_order")
        assert len(found) == 1, name
        assert "GreaterThanOrEqual(order_date" in found[0] and "LessThanOrEqual(order_date" in found[0]


def test_grouped_limits_cut_before_the_shuffle(raw_ctx):
    for name in ("top_stores_last_month", "city_bucket", "worst_stores"):
        assert "WindowGroupLimit" in plan_text(QUERIES[f"partners_{name}"](raw_ctx)), name


def test_a_partner_without_rows(spark, raw_ctx):
    """Providers of a partner that has no orders: its 'other' bucket and a row of NULL rates, nothing else."""
    new = spark.createDataFrame([(10**9, "new", "nowhere", "xz", "P7", True), (10**9 + 1, "none", "x", None, None, True)], raw_ctx.wh.dim_provider.schema)
    wh = type(raw_ctx.wh)(**{**raw_ctx.wh.__dict__, "dim_provider": raw_ctx.wh.dim_provider.unionByName(new)})
    found = partners.AllPartners(KpiContext(spark, wh, raw_ctx.params))
    mine = F.col("country_code") == "xz"
    assert [tuple(r) for r in found.result("city_bucket").where(mine).collect()] == [("xz", "P7", "other", 5)]
    assert [tuple(r)[2:] for r in found.result("acceptance_current").where(mine).collect()] == [(None, None, None)]
    assert found.result("financial").where(mine).count() == 0 and found.result("metric_matrix").where(mine).count() == 0
    bench = found.result("benchmark_business").where(mine).first()
    assert (bench["orders"], bench["gmv_eur"], bench["merchants"]) == (0, None, 0)
