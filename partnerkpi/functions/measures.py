"""Column-level measures: safe ratios, half-up rounding, flag shares and mergeable weighted rates.

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` in double arithmetic (Spark ANSI mode would raise on a zero divisor)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def round_half_up(c: ColumnOrName, scale: int) -> Column:
    """Half-up rounding of a double, done on a decimal so ties round the same way in every engine.

    Doubles are cast to DECIMAL(28,10) first (exact for the magnitudes used here), rounded HALF_UP, and cast back.
    """
    return F.round(_c(c).cast("decimal(28,10)"), scale).cast("double")


def mart(c: ColumnOrName) -> Column:
    """Mart-edge normalisation of a computed double: removes last-bit noise of order-dependent float sums."""
    return round_half_up(c, 6)


def weighted_pair(value: ColumnOrName, weight: ColumnOrName, name: str) -> list[Column]:
    """Mergeable weighted rate: the two sums ``(sum v*w, sum w)`` kept apart so they roll up to any grain."""
    v, w = _c(value), _c(weight)
    return [F.sum(v * w).alias(f"{name}_vw"), F.sum(w).alias(f"{name}_w")]


def finish_pair(vw: ColumnOrName, w: ColumnOrName, pct: bool = False) -> Column:
    """Finished weighted rate from summed parts. A NULL value drops out of the numerator but its weight stays."""
    r = safe_div(vw, w)
    return r * 100 if pct else r


def weighted_rate(value: ColumnOrName, weight: ColumnOrName, pct: bool = False) -> Column:
    """``sum(v*w) / NULLIF(sum(w), 0)`` [* 100] as one aggregate expression."""
    v, w = _c(value), _c(weight)
    return finish_pair(F.sum(v * w), F.sum(w), pct)


def coalesce_sum(cols: list[str]) -> Column:
    """Row-level sum of several nullable columns, NULL read as 0."""
    out = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        out = term if out is None else out + term
    return out


def distinct_count(c: ColumnOrName, rsd: float | None = None) -> Column:
    """Exact ``COUNT(DISTINCT c)``, or, when ``rsd`` is given, a HyperLogLog++ estimate with that relative standard
    deviation: a fixed-size buffer and one map-side-combined shuffle instead of the exact rewrite's ``Expand``."""
    return F.countDistinct(_c(c)) if rsd is None else F.approx_count_distinct(_c(c), rsd)
