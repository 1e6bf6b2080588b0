"""The cache of answers: a table keyed by resolver, schema version and lookup key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.clock import instant
from flowtally.functions.dates import cache_expiry
from flowtally.functions.text import filled
from flowtally.schema import RESOLVE_COLUMNS, RESOLVE_VERSION

#: Column of a cache that is laid out by the plain lookup key.
LOOKUP = "lookup"
CACHED_TYPE = "struct<" + ",".join(f"{name}:string" for name in RESOLVE_COLUMNS) + ">"


def namespace(resolver: str) -> str:
    """Resolvers and schema versions never serve each other's answers."""
    return f"{resolver}:{RESOLVE_VERSION}:"


def live_entries(cache: DataFrame, resolver: str, now: datetime) -> DataFrame:
    """Unexpired entries of one resolver, by plain lookup key and unique in it. Both
    conditions reach the scan. Of a cache laid out by lookup key nothing is shuffled."""
    prefix = namespace(resolver)
    # A name with a colon in it is not told from the key by the layout.
    by_lookup = LOOKUP in cache.columns and ":" not in resolver
    return (
        cache.where(F.col("key").startswith(prefix) & (F.col("expires_at") > instant(now)))
        .select(
            (F.col(LOOKUP) if by_lookup else F.expr(f"substring(key, {len(prefix) + 1})")).alias("key"),
            F.struct(*RESOLVE_COLUMNS).alias("cached"),
            "expires_at",
        )
        .groupBy("key")
        .agg(F.max(F.struct("expires_at", "cached")).alias("newest"))
        .select("key", F.col("newest.cached").alias("cached"))
    )


def cache_hits(keys: DataFrame, cache: DataFrame, resolver: str, now: datetime) -> DataFrame:
    live = live_entries(cache, resolver, now)
    answers = [filled(F.col(f"cached.{name}")).alias(name) for name in RESOLVE_COLUMNS]
    return keys.join(live, "key").select(*keys.columns, *answers)


def cache_misses(keys: DataFrame, cache: DataFrame, resolver: str, now: datetime) -> DataFrame:
    return keys.join(live_entries(cache, resolver, now), "key", "left_anti")


def new_entries(answers: DataFrame, resolver: str, now: datetime) -> DataFrame:
    """Cache rows of fresh answers. Empty ones are left out, so that an outage is asked
    again; the ``expires`` hint becomes the expiry and is not stored itself."""
    something: Column = F.concat(*[filled(F.col(name)) for name in RESOLVE_COLUMNS]) != ""
    return answers.where(something).select(
        F.concat(F.lit(namespace(resolver)), F.col("key")).alias("key"),
        *[filled(F.col(name)).alias(name) for name in RESOLVE_COLUMNS],
        cache_expiry(F.col("expires"), now).alias("expires_at"),
    )


def upsert(cache: DataFrame, fresh: DataFrame, now: datetime) -> DataFrame:
    """Fresh entries replace stored ones of the same key; expired ones are dropped."""
    columns = ["key", *RESOLVE_COLUMNS, "expires_at"]
    entry = F.struct(*columns[1:])
    ranked = cache.select("key", F.struct(F.lit(0).alias("fresh"), entry.alias("entry")).alias("version")).unionByName(
        fresh.select("key", F.struct(F.lit(1).alias("fresh"), entry.alias("entry")).alias("version"))
    )
    return (
        ranked.groupBy("key")
        .agg(F.max_by("version", F.struct("version.fresh", "version.entry.expires_at")).alias("version"))
        .select("key", "version.entry.*")
        .where(F.col("expires_at") > instant(now))
    )
