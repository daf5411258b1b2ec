"""Command line: run the period report or the scorecard and write every section as a dataset.

    python -m partnerkpi scorecard --catalog binding.json --out /shared/out --country xa --partner P0 --as-of 1999-07-14 \\
        --data-start 1999-01-01 --scorecard-start 1999-01-01 --scorecard-end 1999-06-30 \\
        --bench-start 1999-04-01 --bench-end 1999-06-30
    python -m partnerkpi period --fixture /root/testdata/sf0.1 --out /shared/out/period --format json
    python -m partnerkpi partners --catalog binding.json --out /shared/out ...   (all partners, as a bundle)

Inputs: ``--catalog FILE`` (JSON: ``tables`` {input: catalog table}, optional ``columns`` {input: {column: table's
column}}), ``--tables DIR`` (parquet folders named like the inputs; ``--columns FILE`` binds other column names) or
``--fixture DIR`` (the inputs derived from the test tables; missing parameters then take the test values). Partner,
country and dates are required otherwise.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
from datetime import date

from pyspark.sql import SparkSession

from .context import KpiContext
from .params import FIXTURE_PARAMS, ReportParams
from .plans.report import publish, report_scope, write_period_report, write_scorecard
from .sources.catalog import TABLES, Warehouse, fixture_warehouse

_TYPES = {"int": int, "float": float, "str": str, "date": date.fromisoformat, "float | None": float}
_NAMES = {"partner_group": "partner"}


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="partnerkpi")
    ap.add_argument("report", choices=["period", "scorecard", "partners"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="directory with the five input tables as parquet")
    src.add_argument("--catalog", help="JSON file that binds the five inputs to catalog tables")
    src.add_argument("--fixture", help="directory with the TPC-H-style test tables")
    ap.add_argument("--columns", help="JSON file with column names of the tables in --tables")
    ap.add_argument("--month-column", help="partition column of the fact with the order's month as yyyyMM")
    ap.add_argument("--out", required=True, help="output directory (on shared storage for a cluster)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json"])
    ap.add_argument("--mode", default="overwrite", choices=["overwrite", "errorifexists"])
    ap.add_argument("--master", help="Spark master, e.g. local[8], yarn or spark://host:port; omit under spark-submit")
    ap.add_argument("--bundle", action="store_true",
                    help="write a run folder and commit its manifest last, so that readers never see a mixed result")
    ap.add_argument("--observe", action="store_true", help="bundles: add a section with the bad input rows that the run met")
    ap.add_argument("--by-partner", action="store_true",
                    help="partition every section by country and partner group (several partners, one output root)")
    for f in dataclasses.fields(ReportParams):  # every parameter of the run is an option
        flag = f"--{_NAMES.get(f.name, f.name).replace('_', '-')}"
        if f.type == "bool":
            ap.add_argument(flag, dest=f.name, action="store_true", default=None)
        else:
            ap.add_argument(flag, dest=f.name, type=_TYPES[f.type])
    return ap


def _params(ap: argparse.ArgumentParser, a: argparse.Namespace) -> ReportParams:
    given = {f.name: getattr(a, f.name) for f in dataclasses.fields(ReportParams) if getattr(a, f.name) is not None}
    if a.fixture:
        return FIXTURE_PARAMS.with_(**given)
    missing = [f.name for f in dataclasses.fields(ReportParams) if f.default is dataclasses.MISSING and f.name not in given]
    if missing:
        ap.error("missing: " + ", ".join(f"--{_NAMES.get(m, m).replace('_', '-')}" for m in missing))
    return ReportParams(**given)


def _json(path: str | None) -> dict:
    if not path:
        return {}
    with open(path) as f:
        return json.load(f)


def main(argv: list[str] | None = None) -> None:
    ap = _parser()
    a = ap.parse_args(argv)
    params = _params(ap, a)
    builder = SparkSession.builder.appName("partnerkpi")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    if a.fixture:
        wh = fixture_warehouse(spark, a.fixture)
    elif a.catalog:
        binding = _json(a.catalog)
        wh = Warehouse.from_tables(spark, binding["tables"], binding.get("columns"), a.month_column)
    else:
        wh = Warehouse.from_paths(spark, {t: f"{a.tables.rstrip('/')}/{t}" for t in TABLES}, columns=_json(a.columns), month_column=a.month_column)
    ctx = KpiContext(spark, wh, params)
    if a.bundle or a.report == "partners":
        print(json.dumps({"run_id": publish(ctx, a.out, a.report, a.format, a.observe), "scope": report_scope(ctx, a.report)}))
        return
    write = write_period_report if a.report == "period" else write_scorecard
    print(json.dumps(write(ctx, a.out, a.format, by_partner=a.by_partner, mode=a.mode), indent=1))


if __name__ == "__main__":
    main()
