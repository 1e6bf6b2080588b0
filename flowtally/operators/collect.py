"""Select public-destination IPv4 connections of a time range from raw log rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.functions.clock import window_number
from flowtally.functions.networks import Network, parse_networks
from flowtally.functions.text import filled
from flowtally.operators import filters
from flowtally.schema import COLLECT_COLUMNS


@dataclass(frozen=True)
class CollectRules:
    """What to select; ``now`` is fixed once for the whole run."""

    now: datetime
    start: int = 1
    end: int = 0
    unit: str = "h"
    stream_id: str | None = None
    allowlist: Sequence[str] = ()
    cidrs: Sequence[str] = ()
    match_mode: str = "or"
    networks: list[Network] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "networks", parse_networks(self.cidrs))


def select_rows(logs: DataFrame, rules: CollectRules) -> DataFrame:
    """The filters, cheap and pushable ones first. All columns are kept."""
    rows = logs.where(filters.in_time_range(logs, rules.now, rules.start, rules.end, rules.unit))
    if rules.stream_id is not None:
        rows = rows.where(filters.in_stream(logs, rules.stream_id))
    rows = rows.where(filters.exists("SrcIP", "DstIP"))
    source = (rules.allowlist, rules.networks, rules.match_mode)
    hint, match = filters.source_hint(*source), filters.source_match(*source)
    if match is not None:
        rows = rows.where(hint).where(match)
    return rows.where(filters.both_ipv4()).where(filters.public_destination())


def project(rows: DataFrame) -> DataFrame:
    """Exactly the collected columns, in order, as text; absent ones are empty."""
    have = set(rows.columns)
    return rows.select(
        [filled(F.col(name) if name in have else F.lit(None)).alias(name) for name in COLLECT_COLUMNS]
    )


def collect(logs: DataFrame, rules: CollectRules) -> DataFrame:
    return project(select_rows(logs, rules))


def collect_sorted(logs: DataFrame, rules: CollectRules) -> DataFrame:
    """Newest window first, ascending in time within a window.

    The other columns and the input partition only break ties: without them all rows
    of one instant would be sorted by a single task.
    """
    rows = select_rows(logs, rules)
    numbered = rows.select(
        window_number(F.col("timestamp"), rules.now, rules.unit).alias("_window"),
        F.col("timestamp").alias("_at"),
        F.spark_partition_id().alias("_part"),
        *[F.col(name) for name in rows.columns],
    )
    rest = [name for name in COLLECT_COLUMNS[1:] if name in rows.columns]
    return project(numbered.orderBy("_window", "_at", *rest, "_part"))
