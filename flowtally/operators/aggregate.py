"""Count identical connections.

Spark counts map-side first, so a hot connection leaves each task as one row and no
reducer sees its copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.functions.text import filled
from flowtally.operators.counters import threshold_counters
from flowtally.schema import GROUP_COLUMNS, ORDER_COLUMNS, present


def group_columns(columns: list[str]) -> list[str]:
    found = present(columns, GROUP_COLUMNS)
    if not found:
        raise ValueError("No columns to group by: need one of " + ", ".join(GROUP_COLUMNS))
    return found


def aggregate(frame: DataFrame, min_count: int = 1) -> DataFrame:
    """Rows per combination of the group columns present. Missing counts as empty; a
    ``count`` column of the input is ignored, because rows are counted."""
    keys = group_columns(frame.columns)
    counted = frame.groupBy([filled(F.col(name)).alias(name) for name in keys]).agg(
        F.count(F.lit(1)).alias("count")
    )
    return at_least(counted, min_count)


def merge_counts(counted: DataFrame, min_count: int = 1) -> DataFrame:
    """Add up stored counts of the same connection (hours to days, batches to a whole)."""
    keys = group_columns(counted.columns)
    merged = counted.groupBy([filled(F.col(name)).alias(name) for name in keys]).agg(
        F.sum(F.col("count").cast("bigint")).alias("count")
    )
    return at_least(merged, min_count)


def at_least(counted: DataFrame, min_count: int) -> DataFrame:
    """Drop rare groups; only sensible on final counts."""
    return counted.where(F.col("count") >= min_count) if min_count > 1 else counted


def ordered(counted: DataFrame) -> DataFrame:
    """Most frequent first, then by text. Total over aggregated rows, so that the same
    input always gives the same file."""
    tail = present(counted.columns, ORDER_COLUMNS)
    return counted.orderBy(F.desc("count"), *tail)


def threshold_report(counted: DataFrame, min_count: int) -> DataFrame:
    """Groups kept and dropped by a threshold, and the rows they stand for."""
    return counted.agg(*[metric.alias(name) for name, metric in threshold_counters(min_count).items()])
