"""The five warehouse inputs as DataFrames: bound to given tables, or derived from the test tables.

A binding names, per input, the table's own columns and is cast to the types that the workload needs, so real tables with
other names and numeric types fit. The derived inputs are a plan over the raw test tables; ``materialize_fixture`` writes
them for a caller that reads them many times, to a folder the caller owns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_between
from . import fixtures
from .schema import SCHEMAS, SchemaMismatch, assert_schema, conform

TABLES = ("fact_order", "dim_provider", "provider_monthly", "provider_weekly", "resolution")

#: {input: {column of this library: column of the given table}}; columns left out keep their name.
Columns = Mapping[str, Mapping[str, str]]


@dataclass(frozen=True)
class Warehouse:
    fact_order: DataFrame
    dim_provider: DataFrame
    provider_monthly: DataFrame
    provider_weekly: DataFrame
    resolution: DataFrame
    #: Partition column of the fact: the order's month as the number yyyyMM; None where the fact has none.
    month_column: str | None = None
    #: Fact and resolutions are tables in the same number of buckets by order id (``write_bucketed``).
    bucketed: bool = False

    def ordered_between(self, start: date, end: date) -> Column:
        """Closed range of order dates, as a filter that the scan gets; with a month column its months too, which prune folders."""
        days = date_between("order_date", start, end)
        if self.month_column is None:
            return days
        month = F.col(self.month_column)
        return (month >= start.year * 100 + start.month) & (month <= end.year * 100 + end.month) & days

    @classmethod
    def from_frames(cls, *, columns: Columns | None = None, month_column: str | None = None, **frames: DataFrame) -> "Warehouse":
        bound = {}
        for name in TABLES:
            df = frames[name]
            names = (columns or {}).get(name, {})
            if names:
                own = {f.name: names.get(f.name, f.name) for f in SCHEMAS[name].fields}
                extra = [month_column] if month_column and name == "fact_order" else []
                df = df.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in own.items() if theirs in df.columns], *extra)
            bound[name] = conform(assert_schema(df, SCHEMAS[name], name), SCHEMAS[name])
        if month_column and month_column not in bound["fact_order"].columns:
            raise SchemaMismatch(f"fact_order: missing month column {month_column}")
        return cls(**bound, month_column=month_column)

    def with_bucketed(self, fact_order: DataFrame, resolution: DataFrame) -> "Warehouse":
        """The same inputs with the fact and the resolutions read from the tables of ``write_bucketed``."""
        frames = {name: getattr(self, name) for name in TABLES} | {"fact_order": fact_order, "resolution": resolution}
        return replace(self.from_frames(month_column=self.month_column, **frames), bucketed=True)

    @classmethod
    def from_paths(
        cls, spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", columns: Columns | None = None, month_column: str | None = None
    ) -> "Warehouse":
        """Read the five inputs from storage."""
        return cls.from_frames(columns=columns, month_column=month_column, **{n: spark.read.format(fmt).load(paths[n]) for n in TABLES})

    @classmethod
    def from_tables(
        cls, spark: SparkSession, names: Mapping[str, str], columns: Columns | None = None, month_column: str | None = None
    ) -> "Warehouse":
        """Read the five inputs from catalog tables, e.g. ``{'fact_order': 'reporting.orders', ...}``."""
        return cls.from_frames(columns=columns, month_column=month_column, **{n: spark.table(names[n]) for n in TABLES})


def fixture_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The five inputs as a plan over the raw test tables under ``sf_dir``: always what the files hold now."""
    raw = fixtures.read_raw(spark, sf_dir)
    dim = fixtures.dim_provider(raw)
    enriched = fixtures.enriched_orders(raw, dim)
    return Warehouse(
        fact_order=enriched,
        dim_provider=dim,
        provider_monthly=fixtures.provider_monthly(enriched),
        provider_weekly=fixtures.provider_weekly(enriched),
        resolution=fixtures.resolution(raw),
    )


#: Name of the partition column that ``write_fact_by_month`` adds.
MONTH_COLUMN = "order_month"


def write_fact_by_month(fact: DataFrame, path: str) -> DataFrame:
    """Write an order fact in a folder per month, rows sorted by date within files; a hot month is split by AQE."""
    month = F.year("order_date") * 100 + F.month("order_date")
    rows = fact.withColumn(MONTH_COLUMN, month).hint("rebalance", MONTH_COLUMN).sortWithinPartitions(MONTH_COLUMN, "order_date")
    rows.write.mode("errorifexists").partitionBy(MONTH_COLUMN).parquet(path)
    return fact.sparkSession.read.parquet(path)


def write_bucketed(wh: Warehouse, buckets: int, names: tuple[str, str], path: str | None = None, month: bool = False) -> Warehouse:
    """Write the fact and the resolutions as catalog tables in ``buckets`` buckets by order id, and read them from there.

    Rows are exchanged once, here, into the tasks that write the buckets, one file each (one for each month with
    ``month``, which keeps the folders by month); joins on the order id then need no exchange on either side. ``buckets``
    should make a bucket of the fact some hundred megabytes. ``path``: a folder for the tables' files, else the warehouse.
    """
    spark = wh.fact_order.sparkSession
    for df, name in ((wh.fact_order, names[0]), (wh.resolution, names[1])):
        by_month = month and name == names[0]
        if by_month:
            df = df.withColumn(MONTH_COLUMN, F.year("order_date") * 100 + F.month("order_date"))
        out = df.repartition(buckets, "order_id").write.mode("errorifexists").format("parquet").bucketBy(buckets, "order_id").sortBy("order_id")
        if by_month:
            out = out.partitionBy(MONTH_COLUMN)
        if path:
            out = out.option("path", f"{path.rstrip('/')}/{name}")
        out.saveAsTable(name)
    bound = replace(wh, month_column=MONTH_COLUMN) if month else wh
    return bound.with_bucketed(spark.table(names[0]), spark.table(names[1]))


def materialize_fixture(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Write the derived inputs under ``root`` (shared storage, a folder of the caller's) and read them from there.

    The mapping is evaluated once, into the order fact; the metric tables are aggregated from that. AQE sizes the files
    (a hot month is split), and rows are date-sorted inside them for min/max skipping.
    """
    raw = fixtures.read_raw(spark, sf_dir)

    def write(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        if by:
            df = df.hint("rebalance", by).sortWithinPartitions(by)
        df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{name}")
        return spark.read.parquet(f"{root.rstrip('/')}/{name}")

    dim = write(fixtures.dim_provider(raw), "dim_provider")
    fact = write(fixtures.enriched_orders(raw, dim), "fact_order", "order_date")
    return Warehouse.from_frames(
        fact_order=fact,
        dim_provider=dim,
        provider_monthly=write(fixtures.provider_monthly(fact), "provider_monthly", "ts"),
        provider_weekly=write(fixtures.provider_weekly(fact), "provider_weekly", "ts"),
        resolution=write(fixtures.resolution(raw), "resolution"),
    )
