"""Load-time schema checks of the five inputs."""

from __future__ import annotations

import pytest

from partnerkpi.sources.schema import DIM_PROVIDER, SchemaMismatch, assert_schema


def _dim(spark, ddl):
    return spark.createDataFrame([], ddl)


def test_declared_schema_passes(spark):
    assert_schema(spark.createDataFrame([], DIM_PROVIDER), DIM_PROVIDER, "dim_provider")


def test_missing_column_is_reported(spark):
    df = _dim(spark, "provider_id bigint, provider_name string, city_name string, country_code string, group_name string")
    with pytest.raises(SchemaMismatch, match="missing is_grocery"):
        assert_schema(df, DIM_PROVIDER, "dim_provider")


def test_wrong_type_is_reported(spark):
    df = _dim(spark, "provider_id string, provider_name string, city_name string, country_code string, "
                     "group_name string, is_grocery boolean")
    with pytest.raises(SchemaMismatch, match="provider_id"):
        assert_schema(df, DIM_PROVIDER, "dim_provider")


def test_money_as_double_and_ids_as_int_are_accepted(spark):
    from partnerkpi.sources.schema import FACT_ORDER

    cols = []
    for f in FACT_ORDER.fields:
        t = f.dataType.simpleString()
        if t.startswith("decimal"):
            t = "double"
        elif f.name in ("order_id", "user_id"):
            t = "int"
        cols.append(f"{f.name} {t}")
    assert_schema(spark.createDataFrame([], ", ".join(cols)), FACT_ORDER, "fact_order")


def test_other_names_and_numeric_types_give_the_same_results(small_ctx):
    """Tables with prefixed columns, decimal rates and weights, int keys, bound by a column mapping."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from partnerkpi.context import KpiContext
    from partnerkpi.plans.registry import QUERIES
    from partnerkpi.sources.catalog import TABLES, Warehouse
    from partnerkpi.sources.schema import SCHEMAS

    names, columns = {}, {}
    for t in TABLES:
        out = []
        for f in SCHEMAS[t].fields:
            c = F.col(f.name)
            if f.name.endswith("_value"):
                c = c.cast("decimal(38,30)")
            elif f.name.endswith("_weight"):
                c = c.cast("decimal(20,0)")
            elif isinstance(f.dataType, T.LongType):
                c = c.cast("int")
            out.append(c.alias(f"src_{f.name}"))
        getattr(small_ctx.wh, t).select(*out, F.lit(1).alias("gross")).createOrReplaceTempView(f"pk_other_{t}")
        names[t] = f"pk_other_{t}"
        columns[t] = {f.name: f"src_{f.name}" for f in SCHEMAS[t].fields}
    ctx = KpiContext(small_ctx.spark, Warehouse.from_tables(small_ctx.spark, names, columns), small_ctx.params)
    for q in ("financial_monthly", "acceptance_monthly", "metric_verdict", "store_severity"):
        a = sorted(map(tuple, QUERIES[q](small_ctx).collect()), key=str)
        b = sorted(map(tuple, QUERIES[q](ctx).collect()), key=str)
        assert a == b, q


def test_a_replaced_input_file_gives_new_numbers_in_the_same_session(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    import __spark_entry__ as entry
    from conftest import SF_SMALL

    sf = tmp_path / "sf"
    sf.mkdir()
    for t in ("orders", "lineitem", "supplier", "nation"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", sf / f"{t}.parquet")  # not the read-only mode
    query = entry.queries()["financial_monthly"]
    before = sum(r["orders"] for r in query(spark, str(sf)).collect())
    orders = pq.read_table(f"{SF_SMALL}/orders.parquet")
    pq.write_table(orders.slice(0, orders.num_rows // 2), sf / "orders.parquet", coerce_timestamps="us")
    after = sum(r["orders"] for r in query(spark, str(sf)).collect())
    assert 0 < after < before
