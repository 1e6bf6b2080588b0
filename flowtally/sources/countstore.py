"""Counts of connections by period, stored so that a period landed again replaces itself.

A store is a Parquet table with one folder for each hour or day, holding the counts of that
period. Landing a range replaces the periods in it and no others, so that a load can be
repeated, and late logs can be counted by landing their period once more. Reading adds the
periods up; only those asked for are opened.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.functions.clock import instant, unit_seconds
from flowtally.functions.text import filled
from flowtally.operators.aggregate import group_columns, merge_counts
from flowtally.session import stage, stage_scope

PERIOD = "period"
FORMATS = {"h": "yyyy-MM-dd-HH", "d": "yyyy-MM-dd"}


def period_of(moment: datetime, unit: str) -> str:
    return moment.strftime("%Y-%m-%d-%H" if unit == "h" else "%Y-%m-%d")


def period_counts(rows: DataFrame, unit: str = "h", time: str = "timestamp") -> DataFrame:
    """:func:`aggregate` for each period; counted map-side first like there."""
    unit_seconds(unit)
    keys = [filled(F.col(name)).alias(name) for name in group_columns(rows.columns)]
    period = F.date_format(F.col(time).cast("timestamp_ntz"), FORMATS[unit]).alias(PERIOD)
    return rows.groupBy(period, *keys).agg(F.count(F.lit(1)).alias("count"))


class CountStore:
    """``unit`` is ``h`` or ``d``; all landings of a store use the same."""

    def __init__(self, spark: SparkSession, path: str, unit: str = "h"):
        unit_seconds(unit)
        self.spark, self.path, self.unit = spark, path.rstrip("/"), unit
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _check(self, *moments: datetime) -> None:
        size = unit_seconds(self.unit)
        for one in moments:
            if (one - datetime(1970, 1, 1)).total_seconds() % size:
                raise ValueError(f"{one} is no beginning of a period of {size} seconds")

    def land(self, rows: DataFrame, since: datetime, until: datetime, time: str = "timestamp") -> None:
        """Replace the periods of ``[since, until)`` by the counts of the rows in them.

        Rows outside the range, or without a time, are not counted. A period of the range
        that has no rows any more is emptied. All files of a period are put in place after
        every task has ended; a load that fails before leaves the store as it was, one that
        fails after is repeated. One writer of a range at a time is assumed."""
        self._check(since, until)
        kind = dict(rows.dtypes)[time]
        inside = (F.col(time) >= instant(since, kind)) & (F.col(time) < instant(until, kind))
        with stage_scope(self.spark):
            # Read twice: to write the periods, and to tell which of them there are.
            counts = stage(period_counts(rows.where(inside), self.unit, time), "period-counts")
            # A period goes to few files however many tasks counted it; a large one is split.
            writer = counts.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PERIOD).parquet(self.path)
            landed = {row[0] for row in counts.select(PERIOD).distinct().collect()}
        for name in self.periods():
            if period_of(since, self.unit) <= name < period_of(until, self.unit) and name not in landed:
                self._files.delete(self._path(f"{self.path}/{PERIOD}={name}"), True)

    def periods(self) -> list[str]:
        """The periods that hold counts, in order."""
        root = self._path(self.path)
        if not self._files.exists(root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(root)]
        return sorted(name.removeprefix(f"{PERIOD}=") for name in names if name.startswith(f"{PERIOD}="))

    def read_periods(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The stored counts with their ``period``, of ``[since, until)`` only where given."""
        held = self.spark.read.schema(self._schema()).parquet(self.path)
        for moment, test in ((since, F.col(PERIOD).__ge__), (until, F.col(PERIOD).__lt__)):
            if moment is not None:
                self._check(moment)
                held = held.where(test(period_of(moment, self.unit)))
        return held

    def _schema(self) -> str:
        if not self.periods():
            raise ValueError(f"Nothing has been landed in {self.path}")
        # Periods look like dates and numbers; as text they keep their order and form.
        columns = [f for f in self.spark.read.parquet(f"{self.path}/{PERIOD}={self.periods()[-1]}").columns if f != PERIOD]
        return ", ".join([*(f"{name} {'bigint' if name == 'count' else 'string'}" for name in columns), f"{PERIOD} string"])

    def read(self, since: datetime | None = None, until: datetime | None = None, min_count: int = 1) -> DataFrame:
        """Counts of the whole range, as :func:`aggregate` over its rows would give them."""
        return merge_counts(self.read_periods(since, until).drop(PERIOD), min_count)

