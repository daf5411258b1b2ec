"""The states of ``operators.states`` kept in storage, by week: a refresh reads the weeks that changed and no others.

A refresh derives the given weeks anew from the inputs, writes them to a folder of its own and then commits a manifest that
takes these weeks from the new folder and every other week from where it was. So a refresh can be repeated or lost at any
point without a week being counted twice or half, late and deleted rows are taken in by naming their week, and readers see one
committed set of weeks. Users are counted under the partner of their provider: a provider that has changed its country,
partner or peer flag since the last refresh makes the weeks with its orders part of the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_between
from ..operators.states import STATES, _attributes, state_frames
from .bundle import commit, committed
from .catalog import Warehouse

SCOPE = "states"


def monday(d: date) -> date:
    return d - timedelta(days=d.weekday())


def weeks_between(first: date, last: date) -> list[date]:
    start = monday(first)
    return [start + timedelta(days=7 * k) for k in range((monday(last) - start).days // 7 + 1)]


def inside(weeks: Iterable[date], wh: Warehouse | None = None) -> Column:
    """Condition on ``order_date``: one closed range for each stretch of weeks, which reach the scan as pushed filters."""
    stretches: list[list[date]] = []
    for w in sorted(set(weeks)):
        if stretches and (w - stretches[-1][1]).days == 1:
            stretches[-1][1] = w + timedelta(days=6)
        else:
            stretches.append([w, w + timedelta(days=6)])
    ranges = [wh.ordered_between(s, e) if wh else date_between("order_date", s, e) for s, e in stretches]
    return reduce(or_, ranges) if ranges else F.lit(False)


class StateStore:
    """States below ``root``. One refresh at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _sections(self) -> dict[str, tuple[str, str, str]]:
        return {s[0]: s for s in committed(self.spark, self.root, SCOPE)}

    def _moved_weeks(self, wh: Warehouse, sections: dict) -> set[date]:
        """Weeks with orders of providers whose attributes are not those of the last refresh."""
        if "providers" not in sections:
            return set()
        old = self.spark.read.parquet(f"{self.root}/{sections['providers'][1]}")
        moved = old.exceptAll(_attributes(wh)).select("provider_id").distinct()
        names = self.frames(("provider_names",), sections)["provider_names"]
        return {r["week"] for r in names.join(moved, "provider_id").select("week").distinct().collect()}

    def refresh(self, wh: Warehouse, weeks: Iterable[date]) -> list[date]:
        """Derive these weeks (any day of each) anew; returns the weeks that were derived."""
        sections = self._sections()
        todo = sorted({monday(w) for w in weeks} | self._moved_weeks(wh, sections))
        if not todo:
            return []
        run_id = uuid.uuid4().hex
        kept = {n: s for n, s in sections.items() if n == "providers" or date.fromisoformat(n.split("/")[1]) not in todo}
        for state, frame in state_frames(wh, inside(todo, wh)).items():
            path = f"runs/{run_id}/{state}"
            # the rows of a week are few for its orders; AQE sizes the files
            frame.withColumn("w", F.col("week").cast("string")).hint("rebalance", "w").write.partitionBy("w").parquet(f"{self.root}/{path}")
            found = self.spark.read.schema("w string").parquet(f"{self.root}/{path}").select("w").distinct().collect()
            kept |= {f"{state}/{r['w']}": (f"{state}/{r['w']}", f"{path}/w={r['w']}", "parquet") for r in found}
        path = f"runs/{run_id}/providers"
        _attributes(wh).write.parquet(f"{self.root}/{path}")
        kept["providers"] = ("providers", path, "parquet")
        commit(self.spark, self.root, SCOPE, run_id, list(kept.values()))
        return todo

    def weeks(self) -> list[date]:
        return sorted({date.fromisoformat(n.split("/")[1]) for n in self._sections() if n != "providers"})

    def frames(self, names: Iterable[str] = tuple(STATES), sections: dict | None = None) -> dict[str, DataFrame]:
        """The committed states; folders of single weeks are read, so a fold over few weeks lists few files."""
        sections = self._sections() if sections is None else sections
        out = {}
        for name in names:
            paths = [f"{self.root}/{p}" for n, p, _ in sections.values() if n.split("/")[0] == name]
            if not paths:
                raise LookupError(f"no state {name!r} below {self.root}: refresh first")
            out[name] = self.spark.read.option("recursiveFileLookup", True).parquet(*paths)
        return out
