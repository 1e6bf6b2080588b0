"""Add country, network number, network description and contacts to rows.

Only distinct keys are looked up. The keys and their answers are written to a stage
table each; the join back, the cache update and the counters read the answers there.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.text import clean, filled
from flowtally.operators import cache as caching
from flowtally.operators.attach import attach, key_counts
from flowtally.operators.counters import RunCounters
from flowtally.operators.resolvers import ERROR, Resolver
from flowtally.schema import ANSWER_FIELDS, DEFAULT_KEY_COLUMN, RESOLVE_COLUMNS
from flowtally.session import stage


@dataclass(frozen=True)
class Resolution:
    """``rows`` are the enriched rows, ``answers`` one row per looked-up key with its row
    count, whether it was cached and why it failed, ``fresh`` the rows to add to the cache."""

    rows: DataFrame
    answers: DataFrame
    fresh: DataFrame | None


def with_resolve_columns(rows: DataFrame, key_column: str = DEFAULT_KEY_COLUMN) -> DataFrame:
    if key_column not in rows.columns:
        raise ValueError(f"The rows have no column '{key_column}'")
    missing = [name for name in RESOLVE_COLUMNS if name not in rows.columns]
    return rows.withColumns({name: F.lit("") for name in missing}) if missing else rows


def is_pending(skip_already_enriched: bool = True) -> Column:
    """Not yet filled in all four columns."""
    if not skip_already_enriched:
        return F.lit(True)
    enriched = F.lit(True)
    for name in RESOLVE_COLUMNS:
        enriched = enriched & (clean(F.col(name)) != "")
    return ~enriched


def resolve_keys(
    rows: DataFrame, key_column: str = DEFAULT_KEY_COLUMN, skip_already_enriched: bool = True
) -> DataFrame:
    """``(key, key_rows)``: the stripped, non-blank keys of the pending rows."""
    rows = with_resolve_columns(rows, key_column)
    return key_counts(rows, clean(F.col(key_column)), is_pending(skip_already_enriched))


def look_up(keys: DataFrame, resolver: Resolver, cache: DataFrame | None, now: datetime | None) -> DataFrame:
    """Answers of all keys; only those without a live cache entry are asked for, and
    ``cached`` tells which had one. A key whose lookup failed has empty fields and the
    reason in ``error``. The keys go through as one chain of joins."""
    if cache is None:
        known = keys.withColumn("cached", F.lit(None).cast(caching.CACHED_TYPE))
    else:
        known = keys.join(caching.live_entries(cache, resolver.name, now), "key", "left")
    asked = resolver.step(known.withColumn("wanted", F.col("cached").isNull()))
    return asked.selectExpr(
        *keys.columns,
        *[f"coalesce(cached.{name}, answer.{name}, '') AS {name}" for name in RESOLVE_COLUMNS],
        "coalesce(answer.expires, '') AS expires",
        "cached IS NOT NULL AS cached",
        f"{ERROR} AS {ERROR}" if ERROR in asked.columns else f"CAST(NULL AS STRING) AS {ERROR}",
    )


def join_back(
    rows: DataFrame,
    answers: DataFrame,
    key_column: str = DEFAULT_KEY_COLUMN,
    skip_already_enriched: bool = True,
) -> DataFrame:
    """Overwrite all four columns of every pending row with a key, also with empty
    text; enriched rows and rows without a key stay as they are."""
    rows = with_resolve_columns(rows, key_column)
    key = F.when(is_pending(skip_already_enriched), F.nullif(clean(F.col(key_column)), F.lit("")))
    found = answers.select(
        "key", "key_rows", F.lit(True).alias("_found"), *[F.col(name).alias(f"_new_{name}") for name in RESOLVE_COLUMNS]
    )
    joined = attach(rows, found, key)
    return joined.select(
        [
            F.when(F.col("_found"), filled(F.col(f"_new_{name}"))).otherwise(F.col(name)).alias(name)
            if name in RESOLVE_COLUMNS
            else F.col(name)
            for name in rows.columns
        ]
    )


def resolve(
    rows: DataFrame,
    resolver: Resolver,
    key_column: str = DEFAULT_KEY_COLUMN,
    cache: DataFrame | None = None,
    now: datetime | None = None,
    skip_already_enriched: bool = True,
    counters: RunCounters | None = None,
    tasks: int | None = None,
) -> Resolution:
    """Enrich ``rows``; their number does not change. ``rows`` is read twice, so stage
    it first when it is the result of a shuffle. With a cache, ``now`` is needed.
    ``counters`` gets keys, the rows they stand for, hits, misses and failures. ``tasks`` look
    the keys up; for a cache in buckets take as many, so that it is joined where it lies."""
    if cache is not None and now is None:
        raise ValueError("A cache needs the time of the run: now")
    keys = stage(resolve_keys(rows, key_column, skip_already_enriched), "keys")
    # Extraction costs far more per key than its bytes suggest, so the number of tasks must
    # not follow from the size of the stage table; the joins on key reuse the partitioning.
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = look_up(keys.repartition(tasks, "key"), resolver.among(keys), cache, now)
    if counters is not None:
        asked = counters.watch("resolve", asked, **lookup_counters())
    answers = stage(asked, f"answers-{resolver.name}")
    fresh = None if cache is None else caching.new_entries(answers.where(~F.col("cached")), resolver.name, now)
    back = join_back(rows, answers, key_column, skip_already_enriched)
    return Resolution(back, answers.select("key", "key_rows", *ANSWER_FIELDS, "cached", ERROR), fresh)


def lookup_counters() -> dict[str, Column]:
    """What :func:`look_up` found, as aggregates over its rows with ``key_rows``."""
    return {
        "keys": F.count(F.lit(1)),
        "key_rows": F.coalesce(F.sum("key_rows"), F.lit(0)),
        "hits": F.count_if("cached"),
        "misses": F.count_if(~F.col("cached")),
        "failed": F.count(ERROR),
    }


def resolve_counters(
    rows: DataFrame, cache: DataFrame, resolver: Resolver, now: datetime, key_column: str = DEFAULT_KEY_COLUMN
) -> DataFrame:
    """Rows, pending rows with a key, distinct keys, cache hits and misses, in one row."""
    rows = with_resolve_columns(rows, key_column)
    live = caching.live_entries(cache, resolver.name, now).withColumn("hit", F.lit(True)).drop("cached")
    key = clean(F.col(key_column))
    groups = rows.groupBy(key.alias("key"), is_pending().alias("pending")).agg(F.count(F.lit(1)).alias("rows"))
    asked = F.col("pending") & (F.col("key") != "")
    return groups.join(live, "key", "left").agg(
        F.sum("rows").alias("total_rows"),
        F.coalesce(F.sum(F.when(asked, F.col("rows"))), F.lit(0)).alias("pending_rows"),
        F.count_if(asked).alias("unique_keys"),
        F.count_if(asked & F.col("hit").isNotNull()).alias("cache_hits"),
        F.count_if(asked & F.col("hit").isNull()).alias("cache_misses"),
    )
