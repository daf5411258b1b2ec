"""Sinks: the period-report and scorecard bundles, one dataset per section, plus the mart-edge normalisation.

Each section is written by the executors that computed it (no driver round trip). The nested per-metric form of the
matrix (``bucket -> [value per month]``) is built with ``collect_list`` + ``map_from_entries`` over groups bounded
by buckets x months, so no group is large.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_mart(df: DataFrame) -> DataFrame:
    """Mart-edge value normalisation: decimals to double, dates and timestamps to ISO text, other types unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def write_sections(sections: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet",
                   mode: str = "overwrite", partition: Mapping[str, str] | None = None) -> dict[str, str]:
    """Write every section as its own dataset under ``out_dir``; returns section -> path.

    With ``partition`` (e.g. ``{"country": "xa", "partner_group": "P0"}``) each section gets those columns and is
    written partitioned by them with dynamic partition overwrite: runs for several partners share one output root and
    a rerun replaces only its own partition.
    """
    paths = {}
    for name, df in sections.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        out = to_mart(df)
        if partition:
            out = out.select(*out.columns, *[F.lit(v).alias(k) for k, v in partition.items() if k not in out.columns])
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition).format(fmt).save(path))
        else:
            out.write.mode(mode).format(fmt).save(path)
        paths[name] = path
    return paths


def read_sections(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: spark.read.format(fmt).load(p) for name, p in paths.items()}


def nested_metrics(matrix: DataFrame, metric_def: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """One row per metric: catalogue fields, benchmark and ``brands: map<bucket, array<double>>`` in month order."""
    per_bucket = matrix.groupBy("metric_key", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("month", "value"))).alias("series")  # <= months per group
    )
    per_metric = per_bucket.groupBy("metric_key").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("bucket"), F.col("series.value")))  # <= buckets per group
        ).alias("brands")
    )
    return (
        per_metric.join(F.broadcast(metric_def), "metric_key")
        .join(F.broadcast(benchmarks.select("metric_key", "bench")), "metric_key")
        .select("metric_ord", "metric_key", "metric_group", "dir", "fmt", "bench", "brands")
    )
