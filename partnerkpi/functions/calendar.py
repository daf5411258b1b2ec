"""Period keys and date-range predicates as Spark Columns.

Range predicates are written on the raw date/timestamp column (never on a formatted key) so Catalyst pushes them
into the parquet scan and partition pruning applies.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH = "month"
WEEK = "week"


def month_key(c: str | Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")


def week_key(c: str | Column) -> Column:
    """ISO week key: the Monday of the week as ``yyyy-MM-dd``."""
    return F.date_format(F.date_trunc("week", c), "yyyy-MM-dd")


def stamp_key(c: str | Column) -> Column:
    """Raw stamp date ``yyyy-MM-dd`` (no truncation)."""
    return F.date_format(c, "yyyy-MM-dd")


def period_key(c: str | Column, grain: str) -> Column:
    if grain == MONTH:
        return month_key(c)
    if grain == WEEK:
        return week_key(c)
    raise ValueError(f"unknown grain {grain!r}")


def date_lit(d: date) -> Column:
    return F.lit(d)


def ts_lit(d: date) -> Column:
    """Midnight of ``d`` as a TIMESTAMP_NTZ literal (metric stamps are local wall-clock timestamps)."""
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def date_between(c: str | Column, start: date, end: date) -> Column:
    """Closed range ``start <= c <= end`` on a DATE column."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= date_lit(start)) & (col <= date_lit(end))


def date_half_open(c: str | Column, start: date, end_excl: date) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return (col >= date_lit(start)) & (col < date_lit(end_excl))


def ts_between(c: str | Column, start: date, end: date) -> Column:
    """Closed range on a timestamp compared with midnight of both ends (stamps later on ``end`` fall outside)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= ts_lit(start)) & (col <= ts_lit(end))


def ts_from(c: str | Column, start: date) -> Column:
    """Lower bound only, at midnight of ``start``."""
    return (F.col(c) if isinstance(c, str) else c) >= ts_lit(start)


def ts_half_open(c: str | Column, start: date, end_excl: date) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return (col >= ts_lit(start)) & (col < ts_lit(end_excl))
