"""partnerkpi: partner KPI reporting (period report, scorecard, store scoring) as PySpark DataFrame operators."""

from .context import KpiContext
from .params import FIXTURE_PARAMS, ReportParams

__all__ = ["KpiContext", "ReportParams", "FIXTURE_PARAMS"]
