"""Counters of a run, gathered while its steps run and not by counting again.

A step hangs aggregates onto rows that pass by anyway; they are there once the action that
reads those rows has ended. Rows that are sorted by range pass twice, because the sort
samples them first, so a watched step is staged, or read by one action, before a sort.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowtally.functions.clock import window_number


class RunCounters:
    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, step: str, frame: DataFrame, **metrics: Column) -> DataFrame:
        """``frame`` with its metrics watched; a repeated name gets a number."""
        name, number = step, 1
        while name in self._seen:
            number += 1
            name = f"{step}{number}"
        seen = Observation(f"{name}-{uuid4().hex}")
        self._seen[name] = seen, list(metrics)
        return frame.observe(seen, *[metric.alias(one) for one, metric in metrics.items()])

    def get(self) -> dict[str, dict[str, int]]:
        """Metrics by step. Waits for steps whose rows have not been read, so ask after the run."""
        return {step: _values(seen, names) for step, (seen, names) in self._seen.items()}


def _values(seen: Observation, names: list[str]) -> dict[str, int]:
    try:
        found = seen.get
    except Py4JJavaError:
        # Spark drops a step that nothing reaches from the plan; such a step leaves an empty
        # row, which has no Python form.
        found = {}
    return {name: found.get(name, 0) for name in names}


def window_counters(now: datetime, start: int, end: int, unit: str, column: str = "timestamp") -> dict[str, Column]:
    """Rows, and rows in each one-unit window of ``[start, end)`` by its number, 0 the newest.

    One aggregate for each window; rows whose time cannot be read count as rows only."""
    number = window_number(F.col(column).try_cast("timestamp"), now, unit)
    return {"rows": F.count(F.lit(1)), **{f"window{k}": F.count_if(number == k) for k in range(end, start)}}


def threshold_counters(min_count: int) -> dict[str, Column]:
    """Groups kept and dropped by a threshold, and the rows they stand for."""
    kept = F.col("count") >= min_count
    return {
        "groups_kept": F.count_if(kept),
        "groups_dropped": F.count_if(~kept),
        "rows_kept": F.coalesce(F.sum(F.when(kept, F.col("count"))), F.lit(0)),
        "rows_dropped": F.coalesce(F.sum(F.when(~kept, F.col("count"))), F.lit(0)),
    }
