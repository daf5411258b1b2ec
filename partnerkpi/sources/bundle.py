"""Bundles of result sections that appear as a whole: a folder per run, and a manifest that is committed last.

A run writes its sections below ``<root>/runs/<run id>`` and then one manifest file below ``<root>/manifests``. Spark moves a
finished file to its name in one step, so a manifest is there or not; readers take the sections of the newest manifest of
their scope. A driver lost at any point leaves the folder of an unnamed run behind and the last bundle as it was;
``expire`` deletes such folders and old runs. Bundles of several scopes (a partner, a report) share a root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from .sinks import to_mart

_MANIFEST = "scope string, seq long, run_id string, committed_at string, sections array<struct<name:string,path:string,format:string,schema:string>>"


class NoBundle(LookupError):
    pass


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed run: scope, place in the scope's order, run id, time and sections."""
    try:
        return spark.read.schema(_MANIFEST).json(f"{root.rstrip('/')}/manifests/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def _newest(spark: SparkSession, root: str, scope: str):
    return manifests(spark, root).where(F.col("scope") == scope).orderBy(F.desc("seq"), F.desc("run_id")).limit(1).collect()


def write_bundle(
    spark: SparkSession, sections: Mapping[str, DataFrame | Callable[[], DataFrame]], root: str, scope: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()
) -> str:
    """Write all sections of a run, then its manifest; returns the run id. Sections that have the columns of
    ``partition_by`` are partitioned by them; a callable is called when its turn comes. Two runs of one scope at a time are both kept; the later commit is read."""
    run_id, root = uuid.uuid4().hex, root.rstrip("/")
    written = []
    for name, df in sections.items():
        path = f"runs/{run_id}/{name}"
        df = df() if callable(df) else df
        df = to_mart(df)
        out = df.write.mode("errorifexists").format(fmt)
        keys = [k for k in partition_by if k in df.columns]
        (out.partitionBy(*keys) if keys else out).save(f"{root}/{path}")
        written.append((name, path, fmt, df.schema.json()))  # a partitioned section without rows has no file that tells
    commit(spark, root, scope, run_id, written)
    return run_id


def commit(spark: SparkSession, root: str, scope: str, run_id: str, sections: list[tuple]) -> None:
    """Make (name, path, format), with or without a schema as JSON, the scope's newest sections, in one step."""
    last = _newest(spark, root, scope)
    row = [(scope, (last[0]["seq"] if last else 0) + 1, run_id, [(*s, None)[:4] for s in sections])]
    manifest = spark.createDataFrame(row, "scope string, seq long, run_id string, sections array<struct<name:string,path:string,format:string,schema:string>>")
    manifest.withColumn("committed_at", F.current_timestamp().cast("string")).coalesce(1).write.mode("errorifexists").json(f"{root.rstrip('/')}/manifests/{run_id}")


def committed(spark: SparkSession, root: str, scope: str) -> list[tuple[str, str, str]]:
    """(name, path, format) of the newest sections of a scope; none before its first commit."""
    last = _newest(spark, root, scope)
    return [tuple(s)[:3] for s in last[0]["sections"]] if last else []


def read_bundle(spark: SparkSession, root: str, scope: str) -> dict[str, DataFrame]:
    """The sections of the newest committed run of a scope, all of one run."""
    last = _newest(spark, root, scope)
    if not last:
        raise NoBundle(f"no bundle of {scope!r} below {root}")

    def read(s) -> DataFrame:
        reader = spark.read.format(s["format"])
        reader = reader.schema(StructType.fromJson(json.loads(s["schema"]))) if s["schema"] else reader
        return reader.load(f"{root.rstrip('/')}/{s['path']}")

    return {s["name"]: read(s) for s in last[0]["sections"]}


def expire(spark: SparkSession, root: str, keep: int = 2, unnamed: bool = False) -> list[str]:
    """Delete all but the newest ``keep`` runs of every scope, manifest first; returns the run ids that went.

    ``unnamed``: also folders without a manifest - only when no run is being written.
    """
    root = root.rstrip("/")
    newest = Window.partitionBy("scope").orderBy(F.desc("seq"), F.desc("run_id"))
    rows = manifests(spark, root).select("run_id", F.row_number().over(newest).alias("age")).collect()
    held = {r["run_id"] for r in rows if r["age"] <= keep}
    gone = [r["run_id"] for r in rows if r["age"] > keep]
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if unnamed:
        runs = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
        there = {s.getPath().getName() for s in fs.listStatus(runs)} if fs.exists(runs) else set()
        gone += sorted(there - held - set(gone))
    for run_id in gone:
        for part in ("manifests", "runs"):
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{part}/{run_id}"), True)
    return gone
