"""Every registered query against its independent DuckDB statement on the raw test tables (sf0.01, as the driver)."""

from __future__ import annotations


import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE

QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n not in entry.LLM_QUERIES}
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 43 + 33 + 11 + 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_ORACLE)
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]).upper() for d in cur.description}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    assert stypes == otypes
    cols = sorted(ocols)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    idx = {c: i for i, c in enumerate(ocols)}
    orows = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=_key)
    assert srows == orows


def test_all_queries_match_the_oracle_under_other_parameters(spark, duck, tmp_path):
    """Another partner group and country, a Sunday as_of, a leap-year February, top-3 cities, peers without the
    partner: Spark and the oracle generated for the same parameters agree on every query."""
    from datetime import date

    from partnerkpi.oracle import build, build_all_partners
    from partnerkpi.context import KpiContext
    from partnerkpi.params import FIXTURE_PARAMS
    from partnerkpi.plans.registry import QUERIES as FNS
    from partnerkpi.sources.catalog import materialize_fixture

    p = FIXTURE_PARAMS.with_(
        partner_group="P1", country="xb", as_of=date(2000, 3, 12), data_start=date(1999, 9, 1),
        scorecard_start=date(1999, 9, 1), scorecard_end=date(2000, 2, 29), bench_start=date(1999, 12, 1),
        bench_end=date(2000, 2, 29), min_month_orders=10, top_cities=3, peers_exclude_partner=True,
    )
    ctx = KpiContext(spark, materialize_fixture(spark, SF_ORACLE, str(tmp_path / "inputs")), p, staging=True)
    with pytest.raises(ValueError, match="one by one"):
        FNS["partners_financial"](ctx)  # other peers for each partner
    shared = p.with_(peers_exclude_partner=False)
    sql = build(p) | build_all_partners(shared) | {"input_quality": ORACLE["input_quality"]}
    every = KpiContext(spark, ctx.wh, shared, staging=True)
    for name, fn in FNS.items():
        sdf = fn(every if name.startswith(("partners_", "states_")) else ctx)
        cols = sorted(sdf.columns)
        srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
        cur = duck.execute(sql[name])
        idx = {d[0]: i for i, d in enumerate(cur.description)}
        orows = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=_key)
        assert srows == orows, name
    ctx.release()
    every.release()


def test_the_oracle_sees_a_wrong_metric_direction(spark, duck, monkeypatch):
    from partnerkpi.operators import scorecard
    from partnerkpi.plans.registry import spark_query

    flipped = [(o, k, g, -d if k == "Rating" else d, f) for o, k, g, d, f in scorecard.METRICS]
    monkeypatch.setattr(scorecard, "METRICS", flipped)
    got = {tuple(r) for r in spark_query("metric_cell_class")(spark, SF_ORACLE).select("metric_key", "bucket", "month", "cell_class").collect()}
    cur = duck.execute(f"SELECT metric_key, bucket, month, cell_class FROM ({ORACLE['metric_cell_class']})")
    assert got != set(cur.fetchall())
