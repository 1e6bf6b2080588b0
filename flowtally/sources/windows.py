"""Sources that fetch one time window after another, as Spark data sources.

A fetch function gives the log documents of one window. Spark reads the windows of a range
as partitions, side by side. Bounds on the time column are taken over by the source: windows
outside them are never fetched, and those they cut are fetched in part. Other simple
conditions are handed to the fetch function, which may use them to fetch less; Spark checks
them again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from flowtally.functions.clock import UNIT_SECONDS, check_range, shift_now
from flowtally.operators.collect import CollectRules, collect
from flowtally.schema import COLLECT_COLUMNS, LOG_EXTRA_FIELDS, STREAM_FIELD
from flowtally.sources.registry import register_source

Fetch = Callable[[datetime, datetime, Sequence[Filter]], Iterable[Mapping[str, Any] | pa.RecordBatch]]

TIME = "timestamp"
DOCUMENT = f"{TIME} timestamp_ntz, " + ", ".join(
    f"{name} string" for name in [*COLLECT_COLUMNS[1:], *LOG_EXTRA_FIELDS, STREAM_FIELD]
)
#: The smallest step between two instants.
INSTANT = timedelta(microseconds=1)


@dataclass
class Window(InputPartition):
    """``[gte, lt)``, in UTC without a zone."""

    gte: datetime
    lt: datetime


def windows(now: datetime, start: int, end: int, unit: str) -> list[Window]:
    """One-unit windows of ``[now - start, now - end)``, the newest first."""
    check_range(start, end)
    return [Window(shift_now(now, k + 1, unit), shift_now(now, k, unit)) for k in range(end, start)]


def _plain(moment: datetime) -> datetime:
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


class WindowReader(DataSourceReader):
    def __init__(self, fetch: Fetch, every: list[Window], columns: list[str]) -> None:
        self.fetch, self.every, self.columns = fetch, every, columns
        self.low, self.high = datetime.min, datetime.max
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over the bounds on time; hand back all others for Spark to check as well."""
        for one in filters:
            column, value = getattr(one, "attribute", None), getattr(one, "value", None)
            if column == (TIME,) and isinstance(value, datetime) and self._bound(one, _plain(value)):
                continue
            self.conditions.append(one)
            yield one

    def _bound(self, one: Filter, at: datetime) -> bool:
        low, high = self.low, self.high
        match one:
            case GreaterThanOrEqual():
                low = max(low, at)
            case GreaterThan():
                low = max(low, at + INSTANT)
            case LessThan():
                high = min(high, at)
            case LessThanOrEqual():
                high = min(high, at + INSTANT)
            case EqualTo():
                low, high = max(low, at), min(high, at + INSTANT)
            case _:
                return False
        self.low, self.high = low, high
        return True

    def partitions(self) -> list[Window]:
        cut = [Window(max(one.gte, self.low), min(one.lt, self.high)) for one in self.every]
        # Spark reads a source without partitions as one partition of its own making.
        return [one for one in cut if one.gte < one.lt] or [Window(datetime.min, datetime.min)]

    def read(self, partition: Window) -> Iterator[tuple | pa.RecordBatch]:
        if partition.gte >= partition.lt:
            return
        for found in self.fetch(partition.gte, partition.lt, self.conditions):
            yield found if isinstance(found, pa.RecordBatch) else tuple(found.get(name) for name in self.columns)


def data_source(source_name: str, fetch: Fetch, document: str = DOCUMENT) -> type[DataSource]:
    """The data source of a fetch function; its options are ``now``, ``start``, ``end`` and
    ``unit``. A document is a mapping of column names, absent ones are NULL, or a record batch of
    exactly the columns of ``document``."""

    class Windowed(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> str:
            return document

        def reader(self, schema: StructType) -> WindowReader:
            given = self.options
            missing = [option for option in ("now", "start", "unit") if option not in given]
            if missing:
                raise ValueError(f"{source_name}: options {', '.join(missing)} are needed")
            now, unit = _plain(datetime.fromisoformat(given["now"])), given["unit"]
            if unit not in UNIT_SECONDS:
                raise ValueError(f"{source_name}: unit {unit!r} is none of {', '.join(UNIT_SECONDS)}")
            return WindowReader(fetch, windows(now, int(given["start"]), int(given.get("end", 0)), unit), schema.names)

    return Windowed


def read_windows(spark: SparkSession, source: type[DataSource], rules: CollectRules) -> DataFrame:
    """All documents of the range of ``rules``, a partition for each window."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    options = {"now": rules.now.isoformat(), "start": rules.start, "end": rules.end, "unit": rules.unit}
    return spark.read.format(source.name()).options(**options).load()


def register_windows(name: str, document: str = DOCUMENT) -> Callable[[Fetch], Fetch]:
    """Register a fetch function as the source ``name`` of declared pipelines."""

    def register(fetch: Fetch) -> Fetch:
        source = data_source(f"flowtally_{name}", fetch, document)
        register_source(name)(lambda spark, rules: collect(read_windows(spark, source, rules), rules))
        return fetch

    return register


# -- documents that lie in Parquet files by day ------------------------------------------


def landed_days(path: str, columns: Sequence[str], day_column: str = "day") -> Fetch:
    """Fetch from Parquet files in folders ``day=YYYY-MM-DD`` that executors can open.

    Only the days of a window are listed, only its row groups are read, and conditions that
    the file format can test go with them."""
    columns = list(columns)

    def fetch(gte: datetime, lt: datetime, conditions: Sequence[Filter]) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        wanted = (ds.field(TIME) >= pa.scalar(gte)) & (ds.field(TIME) < pa.scalar(lt))
        for one in conditions:
            if (test := _as_expression(one, columns)) is not None:
                wanted = wanted & test
        day = gte.date()
        while day <= (lt - INSTANT).date():
            folder = f"{root}/{day_column}={day.isoformat()}"
            if store.get_file_info(folder).type == fs.FileType.Directory:
                for batch in ds.dataset(folder, filesystem=store, format="parquet").to_batches(columns=columns, filter=wanted):
                    if batch.num_rows:
                        yield batch
            day += timedelta(days=1)

    return fetch


def _as_expression(one: Filter, columns: Sequence[str]):
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    if isinstance(one, Not):
        inner = _as_expression(one.child, columns)
        return None if inner is None else ~inner
    attribute = getattr(one, "attribute", ())
    if len(attribute) != 1 or attribute[0] not in columns:
        return None
    field = ds.field(attribute[0])
    match one:
        case IsNotNull():
            return field.is_valid()
        case EqualTo(value=str(value)):
            return field == value
        case In(value=values) if all(isinstance(value, str) for value in values):
            return field.isin(list(values))
        case StringStartsWith(value=value):
            return pc.starts_with(field, value)
    return None
