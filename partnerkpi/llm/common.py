"""Shared helpers: table access, shared scratch folder, written cuts of the lineage."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word pattern that several contracts name: runs of anything but space and \x09-\x0D.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    Where the setting is absent, a local master (tests) gets a temporary folder; on a cluster that is an error, since
    executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="partnerkpi-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "cut", small: bool = False) -> DataFrame:
    """Write a frame as Parquet to the shared scratch folder and read it back: cuts the lineage, survives executor loss.

    ``small``: far fewer rows than documents; the table is written by at most one task per core, not in many tiny files.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    (df.coalesce(max(1, spark.sparkContext.defaultParallelism)) if small else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_bucket(mod: int, col: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id, modulo ``mod``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for drivers that did not start with it on their path."""
    context = spark.sparkContext
    if getattr(context, "_partnerkpi_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="partnerkpi-code-"), f"partnerkpi-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("partnerkpi", os.path.relpath(full, root)))
    context.addPyFile(path)  # served from the driver from now on
    context._partnerkpi_shipped = True


def with_code(query: Callable) -> Callable:
    """A query that ships the code before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship_code(spark)
        return query(spark, *args)

    return run
