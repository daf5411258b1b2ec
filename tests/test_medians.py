"""Distributed exact medians against Spark's own: ties, hot values, null keys, many distinct values, and the plan."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partnerkpi.operators.medians import exact_medians
from test_plans import plan_text


def both(rows, columns, keys=(), slices=256):
    ours = exact_medians(rows, columns, keys, slices).select(*keys, *columns).collect()
    aggs = [F.median(F.col(c).cast("double")).alias(c) for c in columns]
    spark_own = (rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)).collect()
    return sorted(map(str, ours)), sorted(map(str, spark_own))


def test_many_distinct_values_and_a_hot_value(spark):
    """Ten million values of their own; Spark's own median would keep them all in one buffer."""
    n = 10_000_000
    rows = spark.range(n, numPartitions=16).select(
        ((F.col("id") * 7919) % n).alias("own"),
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("hot"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("even"),
    )
    assert exact_medians(rows, ["own", "hot", "even"]).collect() == [((n - 1) / 2, 5.0, (n - 2) / 2)]


def test_keys_nulls_and_columns_without_values(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1.0, None), ("a", 1, 4.0, None), ("a", None, 3.0, 2.0), (None, 1, 7.0, 2.0), (None, 1, 7.0, 3.0), ("b", 1, None, None)]
        + [("c", 2, float(i % 5), float("nan") if i % 2 else 0.0) for i in range(99)],
        "k string, j int, x double, y double",
    )
    for slices in (3, 256):
        got, want = both(rows, ["x", "y"], ("k", "j"), slices)
        assert got == want
        got, want = both(rows, ["x", "y"], (), slices)
        assert got == want


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, x double")
    assert exact_medians(none, ["x"]).collect() == [(None,)]
    assert exact_medians(none, ["x"], ("k",)).collect() == []


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-4, 4), st.floats(-1e300, 1e300)), max_size=40), st.integers(3, 9))
def test_any_values(spark, values, slices):
    rows = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    found = exact_medians(rows, ["x"], slices=slices).head()[0]
    kept = sorted(float(v) for v in values if v is not None)
    if not kept:
        assert found is None
    else:
        low, high = kept[(len(kept) - 1) // 2], kept[len(kept) // 2]
        assert math.isclose(found, low * 0.5 + high * 0.5, rel_tol=1e-15, abs_tol=0.0) or found == low * 0.5 + high * 0.5


def test_only_counted_values_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select((F.col("id") % 10).alias("x"), F.col("id").alias("y")).write.parquet(path)
    txt = plan_text(exact_medians(spark.read.parquet(path), ["x", "y"]))
    assert "percentile(" not in txt and "CartesianProduct" not in txt and "Python" not in txt


@pytest.mark.parametrize("slices", [3, 1000])
def test_few_slices_change_nothing(spark, slices):
    rows = spark.range(1001).select(F.col("id").cast("double").alias("x"), (F.col("id") * F.col("id")).alias("y"))
    got, want = both(rows, ["x", "y"], slices=slices)
    assert got == want
