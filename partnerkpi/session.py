"""SparkSession defaults for local runs and tests (a cluster brings its own configuration)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "8", app: str = "partnerkpi", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def testdata_dir(sf: str = "0.01") -> str:
    return os.environ.get("PARTNERKPI_SF_DIR", f"/root/testdata/sf{sf}")
