"""Join a lookup with one row per key onto rows where some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows without a key match nothing, so they may go anywhere.
KEYLESS_SPREAD = 1 << 16


def key_counts(rows: DataFrame, key: Column, where: Column | None = None) -> DataFrame:
    """``(key, key_rows)`` of the non-blank keys, counted map-side first."""
    keyed = rows.select(key.alias("key")) if where is None else rows.where(where).select(key.alias("key"))
    return keyed.where((F.col("key").isNotNull()) & (F.col("key") != "")).groupBy("key").agg(
        F.count(F.lit(1)).alias("key_rows")
    )


def attach(rows: DataFrame, lookup: DataFrame, key: Column) -> DataFrame:
    """Left join ``lookup`` (unique ``key``, its row count ``key_rows``, further columns).

    ``key`` may be NULL for rows that need no lookup; they are spread over all tasks. A
    frequent key is split by the adaptive skew join, which may repeat the lookup's single
    row: the number of output rows is that of ``rows``.
    """
    # Fixed for a task's input, so a retried task sends every row to the same place.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in rows.columns]), F.lit(KEYLESS_SPREAD))
    keyed = rows.withColumn("_key", key).withColumn(
        "_keyless", F.when(F.col("_key").isNull(), spread + 1).otherwise(F.lit(0).cast("bigint"))
    )
    found = lookup.drop("key_rows").withColumnRenamed("key", "_key").withColumn("_keyless", F.lit(0).cast("bigint"))
    return keyed.fillna("", ["_key"]).join(found, ["_key", "_keyless"], "left").drop("_key", "_keyless")
