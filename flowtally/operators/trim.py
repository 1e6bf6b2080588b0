"""Drop the service columns. The same call works on a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowtally.schema import DROP_COLUMNS


def kept_columns(columns: list[str]) -> list[str]:
    return [name for name in columns if name not in DROP_COLUMNS]


def trim(frame: DataFrame) -> DataFrame:
    return frame.drop(*DROP_COLUMNS)
