"""Counting and trimming with Structured Streaming.

Two ways to count, equal to the batch result once all input is in:
``running_counts`` keeps the counts as state of the query; ``partial_counts`` writes
one small table of counts per micro-batch and adds them up when read, so the query
itself keeps no state however many connections there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowtally.operators.aggregate import aggregate, merge_counts
from flowtally.operators.trim import trim


def running_counts(stream: DataFrame) -> DataFrame:
    """Use with output mode ``complete`` or ``update``; apply a threshold and an order to
    the result, not here."""
    return aggregate(stream)


def partial_counts(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Count all available input, a table per micro-batch. A repeated batch replaces its
    own table, so nothing is counted twice."""

    def write(batch: DataFrame, number: int) -> None:
        aggregate(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_counts(spark: SparkSession, path: str, min_count: int = 1) -> DataFrame:
    return merge_counts(spark.read.parquet(path).drop("batch"), min_count)


def landed(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All available rows of a stream into Parquet files, each exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def trimmed(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drop the service columns of all available input into Parquet files."""
    return landed(trim(stream), path, checkpoint)
