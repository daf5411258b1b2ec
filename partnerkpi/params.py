"""Run parameters and the calendar windows derived from them.

Every clock read of the original workload is replaced by one ``as_of`` date, so a run is reproducible. The windows
are pure parameter arithmetic done on the driver (no data involved); the data-dependent parts (populated months,
top cities) stay DataFrames.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from datetime import date, timedelta


def _month_start(d: date) -> date:
    return d.replace(day=1)


def _add_months(d: date, n: int) -> date:
    y, m = divmod(d.year * 12 + (d.month - 1) + n, 12)
    return date(y, m + 1, 1)


@dataclass(frozen=True)
class ReportParams:
    """Partner, scope and threshold parameters of one report run. Partner, country and dates have no default."""

    country: str
    partner_group: str
    as_of: date
    # first day of monthly data in the period report (partner go-live)
    data_start: date
    # scorecard month range (both ends inclusive, whole months)
    scorecard_start: date
    scorecard_end: date
    # benchmark quarter (whole months, both ends inclusive)
    bench_start: date
    bench_end: date
    min_month_orders: int = 50
    top_cities: int = 4
    other_bucket: str = "other"
    top_stores: int = 15
    worst_stores: int = 6
    max_gaps: int = 4
    # gap ranking: 'mean' (raw mean, descending - the original's order) or 'distance' (|mean - bench| / |bench|)
    gap_order: str = "mean"
    par_band: float = 0.05
    severity_high: float = 0.6
    severity_mid: float = 0.35
    # peer scope: the partner's own providers are part of it unless this is set
    peers_exclude_partner: bool = False
    # opt-in HyperLogLog distinct counts (relative standard deviation); None = exact, as the original
    approx_distinct_rsd: float | None = None
    # exact medians by distributed selection: for store counts whose distinct values do not fit one task
    distributed_medians: bool = False

    def with_(self, **kw) -> "ReportParams":
        return replace(self, **kw)

    # ---- period report windows -------------------------------------------------------------------------------
    @property
    def data_end(self) -> date:
        """Last day of the last complete month before ``as_of``."""
        return _month_start(self.as_of) - timedelta(days=1)

    @property
    def week_end(self) -> date:
        """Last complete Sunday; on a Sunday the running week is excluded (isoweekday is 7)."""
        return self.as_of - timedelta(days=self.as_of.isoweekday())

    @property
    def week_start(self) -> date:
        """Monday four full weeks before ``week_end``."""
        return self.week_end - timedelta(days=27)

    @property
    def prev_month_start(self) -> date:
        return _add_months(_month_start(self.as_of), -1)

    @property
    def prev_month_end_excl(self) -> date:
        return _month_start(self.as_of)

    @property
    def rolling_start(self) -> date:
        return self.as_of - timedelta(days=7)

    # ---- scorecard windows -----------------------------------------------------------------------------------
    @property
    def scorecard_end_excl(self) -> date:
        return _add_months(_month_start(self.scorecard_end), 1)

    @property
    def bench_end_excl(self) -> date:
        return _add_months(_month_start(self.bench_end), 1)

    @property
    def bench_months(self) -> int:
        """Number of months in the benchmark window (divisor of the per-merchant per-month benchmarks)."""
        s, e = _month_start(self.bench_start), _month_start(self.bench_end)
        return (e.year - s.year) * 12 + e.month - s.month + 1

    def scorecard_months(self) -> list[tuple[str, str]]:
        """(key, label) of every month of the scorecard range, e.g. ('1999-01', 'Jan 1999')."""
        out, m = [], _month_start(self.scorecard_start)
        while m <= self.scorecard_end:
            out.append((m.strftime("%Y-%m"), m.strftime("%b %Y")))
            m = _add_months(m, 1)
        return out

    def severity_cuts(self, n_directed: int) -> tuple[int, int]:
        return math.ceil(n_directed * self.severity_high), math.ceil(n_directed * self.severity_mid)


#: Parameters of the registered queries over the test tables; the month threshold fits their size.
FIXTURE_PARAMS = ReportParams(
    country="xa",
    partner_group="P0",
    as_of=date(1999, 7, 14),
    data_start=date(1999, 1, 1),
    scorecard_start=date(1999, 1, 1),
    scorecard_end=date(1999, 6, 30),
    bench_start=date(1999, 4, 1),
    bench_end=date(1999, 6, 30),
    min_month_orders=25,
)
