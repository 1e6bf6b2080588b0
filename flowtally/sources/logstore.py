"""Log documents landed as files (JSON lines, Parquet or ORC)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.functions.clock import shift_now
from flowtally.operators.collect import CollectRules, collect
from flowtally.schema import COLLECT_COLUMNS, LOG_EXTRA_FIELDS, STREAM_FIELD

LOG_SCHEMA = ", ".join(f"{name} string" for name in [*COLLECT_COLUMNS, *LOG_EXTRA_FIELDS, STREAM_FIELD])


@dataclass(frozen=True)
class LogStore:
    """Where the documents lie. ``date_column`` names a ``date`` partition column; the
    days of the range are then pruned before any file is opened."""

    path: str | list[str]
    format: str = "parquet"
    date_column: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.format != "json":
            return spark.read.format(self.format).load(self.path)
        schema = LOG_SCHEMA + (f", {self.date_column} date" if self.date_column else "")
        documents = spark.read.schema(schema).json(self.path)
        # One stream id or a list of them: both become a list.
        streams = F.when(
            F.col(STREAM_FIELD).startswith("["), F.from_json(STREAM_FIELD, "array<string>")
        ).otherwise(F.array(STREAM_FIELD))
        return documents.withColumn(STREAM_FIELD, streams)

    def collect(self, spark: SparkSession, rules: CollectRules) -> DataFrame:
        documents = self.read(spark)
        if self.date_column:
            first = shift_now(rules.now, rules.start, rules.unit).date()
            last = shift_now(rules.now, rules.end, rules.unit).date()
            documents = documents.where(F.col(self.date_column).between(F.lit(first), F.lit(last)))
        return collect(documents, rules)

    __call__ = collect
