"""Bundles are written section by section and read back unchanged."""

from __future__ import annotations

import tempfile

from pyspark.sql import types as T

from partnerkpi.operators import stores
from partnerkpi.plans import report
from partnerkpi.sources.sinks import read_sections, to_mart


def test_mart_edge_normalisation(spark):
    df = spark.createDataFrame([(1, "2.50", "1999-01-02")], "a int, m string, d string").selectExpr(
        "a", "cast(m as decimal(10,2)) m", "to_date(d) d"
    )
    out = to_mart(df)
    assert [f.dataType for f in out.schema] == [T.IntegerType(), T.DoubleType(), T.StringType()]
    assert out.first()["d"] == "1999-01-02"


def test_period_report_round_trip(small_ctx):
    out = tempfile.mkdtemp(prefix="partnerkpi-test-bundle-")
    paths = report.write_period_report(small_ctx, out)
    assert len(paths) == 17
    back = read_sections(small_ctx.spark, paths)
    assert back["monthly/financial"].count() == report.period_report_sections(small_ctx)["monthly/financial"].count()
    assert back["acceptance_current"].count() == 1


def test_scorecard_round_trip_and_nested_metrics(small_ctx):
    out = tempfile.mkdtemp(prefix="partnerkpi-test-bundle-")
    paths = report.write_scorecard(small_ctx, out, fmt="json")
    back = read_sections(small_ctx.spark, paths, fmt="json")
    metrics = back["metrics"]
    assert metrics.count() == 19
    months = back["months"].where("populated").count()
    row = metrics.where("metric_key = 'Orders'").first()
    assert all(len(v) == months for v in row["brands"].asDict().values())
    assert [r["label"] for r in back["months"].orderBy("month").collect()][0] == "Jan 1999"
    assert set(back["stores"].columns) == {"addr", "city", "bucket", "orders", "dur", "late", "lateprep", "failed", "bad",
                                           "replacement", "cs", "compl", "rating", "flags", "severity"}
    assert back["stores"].count() == stores.store_flags(small_ctx).count()
    assert back["store_cols"].count() == 10
    meta = back["meta"].first()
    assert meta["store_period_start"] == "1999-04-01" and meta["benchmark_note"]
    n = back["stores"].count()
    report.write_scorecard(small_ctx, out, fmt="json")  # a second run replaces the first
    assert read_sections(small_ctx.spark, paths, fmt="json")["stores"].count() == n


def test_command_line_period_report(spark, capsys):
    import json
    import os

    from partnerkpi.__main__ import main

    out = tempfile.mkdtemp(prefix="partnerkpi-test-cli-")
    main(["period", "--fixture", "/root/testdata/sf0.001", "--out", f"{out}/period", "--format", "json",
          "--min-month-orders", "1"])
    paths = json.loads(capsys.readouterr().out)
    assert set(paths) >= {"meta", "monthly/financial", "weekly/failed_reasons", "acceptance_current", "top_stores"}
    assert all(os.path.exists(os.path.join(p, "_SUCCESS")) for p in paths.values())
    meta = spark.read.json(paths["meta"]).first()
    assert (meta["as_of"], meta["weekly_start"], meta["weekly_end"]) == ("1999-07-14", "1999-06-14", "1999-07-11")


def test_sections_partitioned_by_partner_share_one_root(small_ctx):
    out = tempfile.mkdtemp(prefix="partnerkpi-test-bundle-")
    other = small_ctx.with_params(partner_group="P1")
    report.write_period_report(small_ctx, out, by_partner=True)
    paths = report.write_period_report(other, out, by_partner=True)
    report.write_period_report(other, out, by_partner=True)  # a rerun replaces only its own partition
    fin = small_ctx.spark.read.parquet(paths["monthly/financial"])
    got = {r["partner_group"]: r["n"] for r in fin.groupBy("partner_group").count().withColumnRenamed("count", "n").collect()}
    want = {g: report.period_report_sections(c)["monthly/financial"].count()
            for g, c in (("P0", small_ctx), ("P1", other))}
    assert got == want


def test_warehouse_from_catalog_tables_gives_the_same_results(small_ctx):
    from partnerkpi.context import KpiContext
    from partnerkpi.plans.registry import QUERIES
    from partnerkpi.sources.catalog import TABLES, Warehouse

    names = {}
    for t in TABLES:
        getattr(small_ctx.wh, t).createOrReplaceTempView(f"pk_test_{t}")
        names[t] = f"pk_test_{t}"
    wh = Warehouse.from_tables(small_ctx.spark, names)
    ctx = KpiContext(small_ctx.spark, wh, small_ctx.params)
    for q in ("financial_weekly", "metric_verdict"):
        a = sorted(map(tuple, QUERIES[q](small_ctx).collect()), key=str)
        b = sorted(map(tuple, QUERIES[q](ctx).collect()), key=str)
        assert a == b, q


def test_command_line_without_dates_is_an_error(capsys):
    import pytest

    from partnerkpi.__main__ import main

    with pytest.raises(SystemExit):
        main(["period", "--tables", "/nowhere", "--out", "/nowhere/out", "--country", "xa", "--partner", "P0"])
    assert "--as-of" in capsys.readouterr().err
