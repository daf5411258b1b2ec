"""Run context: session, the five input tables and parameters; optional reuse of parts within one report run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .operators.input_quality import InputWatch
from .params import ReportParams
from .sources.catalog import Warehouse


@dataclass
class KpiContext:
    """Everything one report run needs; it belongs to its caller.

    Building a query runs no job and writes nothing. With ``staging`` (a report run that writes many sections) the
    parts that several sections share - a few rows per period, bucket or store - are persisted when a section first
    computes them; their lineage is kept, so a lost executor recomputes what it held. ``release`` drops them.
    """

    spark: SparkSession
    wh: Warehouse
    params: ReportParams
    staging: bool = False
    #: Counts bad rows in the run's own reading (``operators.input_quality.InputWatch``), None: not counted.
    inputs: InputWatch | None = None
    _stages: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def with_params(self, **kw) -> "KpiContext":
        return KpiContext(self.spark, self.wh, self.params.with_(**kw), self.staging, self.inputs)

    def watched(self, part: str, rows: DataFrame) -> DataFrame:
        return self.inputs.watch(part, rows) if self.inputs else rows

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()``, or in a staging run one persisted copy of it for all uses."""
        if not self.staging:
            return build()
        if name not in self._stages:
            self._stages[name] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self._stages[name]

    def release(self) -> None:
        """Drop all persisted parts of the run."""
        for df in self._stages.values():
            df.unpersist()
        self._stages.clear()

    def __enter__(self) -> "KpiContext":
        return self

    def __exit__(self, *_) -> None:
        self.release()
