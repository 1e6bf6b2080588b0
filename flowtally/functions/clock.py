"""Relative time. ``now`` is always an argument, so one run has one clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The units a range may be given in.
UNIT_SECONDS = {"d": 86_400, "h": 3_600}


def unit_seconds(unit: str) -> int:
    if unit not in UNIT_SECONDS:
        raise ValueError(f"Unsupported unit: {unit}")
    return UNIT_SECONDS[unit]


def shift_now(now: datetime, value: int, unit: str) -> datetime:
    return now - timedelta(seconds=value * unit_seconds(unit))


def check_range(start: int, end: int) -> None:
    if start <= end:
        raise ValueError("start must be greater than end, e.g. start=5, end=0")


def instant(moment: datetime, data_type: str = "timestamp") -> Column:
    """A foldable literal of the column's own type, so that a comparison is pushed down."""
    aware = moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment
    text = aware.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
    if data_type == "timestamp_ntz":
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def time_expression(value: Column, unit: str) -> Column:
    """``now`` for 0, else ``now-5h``."""
    unit_seconds(unit)
    return F.when(value == 0, F.lit("now")).otherwise(F.concat(F.lit("now-"), value.cast("string"), F.lit(unit)))


def shifted(now: Column, value: Column, unit: str) -> Column:
    unit_seconds(unit)
    zero = F.lit(0)
    if unit == "d":
        return now - F.make_interval(days=value.cast("int"), hours=zero)
    return now - F.make_interval(days=zero, hours=value.cast("int"))


def time_windows(start: Column, end: Column, unit: str) -> Column:
    """One-unit windows of ``[start, end)`` before now, newest first, as an array."""
    unit_seconds(unit)
    return F.transform(
        F.when(start > end, F.sequence(end, start - 1)),
        lambda upto: F.struct(
            time_expression(upto + 1, unit).alias("gte_expr"),
            time_expression(upto, unit).alias("lt_expr"),
            (upto + 1).alias("from_value"),
            upto.alias("to_value"),
        ),
    )


def window_number(at: Column, now: datetime, unit: str) -> Column:
    """0 for the newest window: ``now-(k+1)u <= at < now-k·u`` gives ``k``."""
    size = unit_seconds(unit) * 1_000_000
    age = F.unix_micros(instant(now)) - F.unix_micros(at.cast("timestamp")) - 1
    return ((age - F.pmod(age, F.lit(size))) / size).cast("bigint")


def slice_name(prefix: str, label: Column, now: datetime, start: int, end: int, unit: str) -> Column:
    """``prefix_label__from__to__time-HH-MM.csv``, the name of one split part."""
    return F.concat(
        F.lit(f"{prefix}_"),
        label,
        F.lit(
            f"__{shift_now(now, start, unit):%Y-%m-%d}"
            f"__{shift_now(now, end, unit):%Y-%m-%d}"
            f"__time-{now:%H-%M}.csv"
        ),
    )
