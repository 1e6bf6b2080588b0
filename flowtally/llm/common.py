"""Helpers several of these operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose remainder is this one are held out of training.
FOLDS, HELD_OUT_FOLD = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id as text leaves remainder 2; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def spread_key(doc_id: Column) -> Column:
    """32 hex digits that order documents as if at random, alike on every engine."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))


def start_positions(
    frame: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str], to: str, size: str | None = None
) -> DataFrame:
    """Add ``to``: how much of a group lies before the row, in rows or in ``size``.

    Equals a running sum over each group in the order of ``bucket``, then ``order``, but no
    task ever holds a group: sizes are summed per bucket first, and only a bucket is sorted.
    ``groups`` and ``bucket`` must not be NULL, and ``bucket`` must be fine enough for a
    bucket to fit one task.
    """
    measure = F.lit(1) if size is None else F.col(size)
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frame.groupBy(*keys)
        .agg(F.sum(measure).cast("bigint").alias("_in_bucket"))
        .select(*keys, F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        frame.join(offsets, keys)
        .withColumn(to, F.col("_offset") + F.coalesce(F.sum(measure).over(inside), F.lit(0)).cast("bigint"))
        .drop("_offset")
    )
