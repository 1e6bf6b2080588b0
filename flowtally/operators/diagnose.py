"""Why does a collection come back empty? Three reports over the raw log rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.operators import filters
from flowtally.operators.collect import CollectRules

EXPECTED_FIELDS = ["timestamp", "SrcIP", "DstIP", "streams"]


def filter_ladder(logs: DataFrame, rules: CollectRules) -> DataFrame:
    """Rows left as the clauses of the query are taken away one by one, in one pass.
    The first layer with rows tells which clause removed everything. The layers hold
    what the scan checks; the exact address tests come after them."""
    in_range = filters.in_time_range(logs, rules.now, rules.start, rules.end, rules.unit)
    present = F.col("SrcIP").isNotNull() & F.col("DstIP").isNotNull()
    stream = F.lit(True) if rules.stream_id is None else filters.in_stream(logs, rules.stream_id)
    source = filters.source_prefilter(rules.allowlist, rules.networks, rules.match_mode)
    layers: list[tuple[int, str, Column]] = [
        (0, "all", F.lit(True)),
        (1, "full", in_range & present & stream & (F.lit(True) if source is None else source)),
        (2, "without source filter", in_range & present & stream),
        (3, "without stream filter", in_range & present),
        (4, "time range only", in_range),
        (5, "stream only", stream),
    ]
    counts = logs.agg(*[F.count_if(test).alias(f"layer{number}") for number, _, test in layers])
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("layer"),
                F.lit(name).alias("clauses"),
                F.col(f"layer{number}").alias("rows"),
            )
            for number, name, _ in layers
        ]
    )
    return counts.select(F.inline(rows))


def field_presence(logs: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Whether each expected field exists, and in how many rows it has a value."""
    names = expected or EXPECTED_FIELDS
    have = set(logs.columns)
    counts = logs.agg(
        *[(F.count(F.col(name)) if name in have else F.lit(0).cast("bigint")).alias(name) for name in names]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"), F.lit(name in have).alias("present"), F.col(name).alias("rows")
            )
            for name in names
        ]
    )
    return counts.select(F.inline(rows))


def newest(logs: DataFrame, column: str = "timestamp") -> DataFrame:
    return logs.agg(F.max(column).alias("newest"))


def sample_document(logs: DataFrame) -> DataFrame:
    """One document, to look at its field names."""
    return logs.limit(1)
