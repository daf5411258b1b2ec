"""What the inputs hold that a report silently leaves out or counts twice.

``input_quality`` is a query of its own: exact counts over the whole inputs, those across rows and tables included
(repeated order ids, rows without a provider, resolutions without an order). ``InputWatch`` gives the counts that need one
row at a time from the reading that a report does anyway: the observed rows are those after the date filter, which still
reaches the scan, and only columns that the report reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.schema import MONTHLY_RATES, WEEKLY_RATES

SCHEMA = "input string, measure string, n long"


def order_checks() -> dict[str, Column]:
    return {
        "rows": F.count(F.lit(1)),
        "null_state": F.count_if(F.col("order_state").isNull()),
        "null_provider": F.count_if(F.col("provider_id").isNull()),
        "null_user": F.count_if(F.col("user_id").isNull()),
        "null_gross": F.count_if(F.col("gross").isNull()),
        "negative_gross": F.count_if(F.col("gross") < 0),
    }


def rate_checks(rates: list[str]) -> dict[str, Column]:
    """Rows, and for each rate those that its weighted mean leaves out: a value whose weight is missing or not positive."""
    out = {"rows": F.count(F.lit(1))}
    for r in rates:
        w = F.col(f"{r}_weight")
        out[f"{r}_without_weight"] = F.count_if(F.col(f"{r}_value").isNotNull() & (w.isNull() | (w <= 0)))
    return out


CHECKS = {"fact_order": order_checks, "provider_weekly": lambda: rate_checks(WEEKLY_RATES), "provider_monthly": lambda: rate_checks(MONTHLY_RATES)}


def _long(name: str, row: DataFrame) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("n")) for c in row.columns])
    return row.select(F.lit(name).alias("input"), F.inline(cells))


def _total(name: str, check: str, counted: DataFrame) -> DataFrame:
    return _long(name, counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(check)))


def input_quality(ctx) -> DataFrame:
    """(input, measure, n) over the whole inputs. Ids are counted map-side before they are compared, so hot ones are few rows."""
    wh = ctx.wh
    parts = [_long(name, getattr(wh, name).agg(*[c.alias(k) for k, c in checks().items()])) for name, checks in CHECKS.items()]
    n = F.count(F.lit(1)).alias("n")
    orders = wh.fact_order.where("order_id IS NOT NULL").groupBy("order_id").agg(n)
    parts.append(_total("fact_order", "repeated_order", orders.select((F.col("n") - 1).alias("n"))))
    by_provider = wh.fact_order.where("provider_id IS NOT NULL").groupBy("provider_id").agg(n)
    parts.append(_total("fact_order", "unknown_provider", by_provider.join(wh.dim_provider.select("provider_id"), "provider_id", "left_anti")))
    parts.append(_total("dim_provider", "repeated_provider", wh.dim_provider.where("provider_id IS NOT NULL").groupBy("provider_id").agg(n).select((F.col("n") - 1).alias("n"))))
    solved = wh.resolution.groupBy("order_id").agg(n)
    parts.append(_total("resolution", "unknown_order", solved.join(orders.select("order_id"), "order_id", "left_anti")))
    return reduce(DataFrame.unionAll, parts).orderBy("input", "measure")


class InputWatch:
    """Counts taken by ``DataFrame.observe`` while a report's own sections run; each part is watched once."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, part: str, rows: DataFrame) -> DataFrame:
        """``rows`` observed; ``part`` is an input's name and what is read of it, as ``fact_order/month``."""
        if part in self._seen:
            return rows
        self._seen[part] = Observation(part)
        return rows.observe(self._seen[part], *[c.alias(k) for k, c in CHECKS[part.split("/")[0]]().items()])

    def result(self, spark: SparkSession) -> DataFrame:
        """The counts, once the sections that read the parts are written (a few numbers a part)."""
        rows = [(part, check, n) for part, seen in self._seen.items() for check, n in seen.get.items()]
        return spark.createDataFrame(rows, SCHEMA)
