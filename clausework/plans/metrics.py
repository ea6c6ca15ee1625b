"""Counts, rates and time left of a run, as it goes: printed line by line, and kept as a table of the run."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RunMetrics:
    """Phases of a run with their seconds, rows and other counts.

    Rows are counted by ``DataFrame.observe`` inside the jobs that compute them anyway; ``step`` is told of parts of a phase
    that is done piece by piece, and says how long the rest will take.
    """

    def __init__(self, say: Callable[[str], None] | None = print, clock: Callable[[], float] = time.time):
        self.say, self.clock = say or (lambda line: None), clock
        self.values: dict[tuple[str, str], float] = {}
        self._observed: list[tuple[str, Observation]] = []
        self._began: dict[str, float] = {}
        self._totals: dict[str, int] = {}

    def begin(self, phase: str, total: int | None = None) -> None:
        self._began[phase] = self.clock()
        if total is not None:
            self._totals[phase] = total
        self.say(f"{phase}: begins" + (f", {total} to do" if total is not None else ""))

    def step(self, phase: str, rows: int) -> None:
        """More rows of a phase are done."""
        done = self.values.get((phase, "rows"), 0) + rows
        seconds = self.clock() - self._began[phase]
        self.values[phase, "rows"], self.values[phase, "seconds"] = done, seconds
        rate = done / seconds if seconds > 0 else 0.0
        total = self._totals.get(phase)
        left = f" of {total}, {(total - done) / rate:.0f} s left" if total is not None and rate else ""
        self.say(f"{phase}: {done:.0f}{left}, {rate:.2f} a second")

    def end(self, phase: str) -> None:
        self.values[phase, "seconds"] = self.clock() - self._began[phase]
        mine = [o for p, o in self._observed if p == phase]
        for o in mine:
            for measure, value in o.get.items():
                self.values[phase, measure] = float(value or 0)
        self._observed = [x for x in self._observed if x[0] != phase]
        rows = "".join(f", {v:.0f} {m}" for (p, m), v in self.values.items() if p == phase and m != "seconds")
        self.say(f"{phase}: {self.values[phase, 'seconds']:.1f} s{rows}")

    def watched(self, phase: str, df: DataFrame, **measures: Column) -> DataFrame:
        """df whose rows (and other aggregates) are known once an action has read it; ``end`` of the phase waits for that."""
        o = Observation()
        self._observed.append((phase, o))
        return df.observe(o, *(m.alias(k) for k, m in (measures or {"rows": F.count(F.lit(1))}).items()))

    def table(self, spark: SparkSession) -> DataFrame:
        """(phase, measure, value)."""
        return spark.createDataFrame([(p, m, float(v)) for (p, m), v in self.values.items()], "phase string, measure string, value double")
