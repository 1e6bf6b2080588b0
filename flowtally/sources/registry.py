"""Sources by name. A source gives the collected rows of a time range as one DataFrame,
so that the range is a predicate and not a loop over windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowtally.operators.collect import CollectRules

Source = Callable[[SparkSession, CollectRules], DataFrame]
SOURCES: dict[str, Source] = {}


def register_source(name: str) -> Callable[[Source], Source]:
    def register(source: Source) -> Source:
        SOURCES[name] = source
        return source

    return register


def get_source(name: str) -> Source:
    if name not in SOURCES:
        known = ", ".join(sorted(SOURCES)) or "<none registered>"
        raise ValueError(f"Unknown source '{name}'. Available sources: {known}")
    return SOURCES[name]
