"""The answer cache laid out by lookup key.

Like :class:`CacheStore` it grows by versions, but every version is written in buckets of the
plain lookup key. Spark reads the same bucket of all versions in one task and knows that a
key is nowhere else: a lookup shuffles the keys asked for and never the stored history, and
the entry of a single key opens one bucket.

Buckets are known to Spark through an external table in the session's catalogue, made for
each reading from the versions complete by then, so that a frame keeps what it was made of.
``forget`` drops these tables; the files stay.
"""

from __future__ import annotations

import logging
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtally.operators.cache import LOOKUP, live_entries, namespace, upsert
from flowtally.schema import CACHE_SCHEMA
from flowtally.sources.cachestore import CacheStore, empty_cache

log = logging.getLogger(__name__)

LAYOUT = "_buckets="
#: Of ``<resolver>:<schema version>:<lookup key>``, which may hold colons itself, the last part.
LOOKUP_PART = r"(?s)\A[^:]*:[^:]*:(.*)\z"


def with_lookup(entries: DataFrame) -> DataFrame:
    """Cache rows with the plain lookup key they are laid out by."""
    return entries.withColumn(LOOKUP, F.regexp_extract("key", LOOKUP_PART, 1))


def _quoted(place: str) -> str:
    return place.replace("\\", "\\\\").replace("'", "\\'")


class BucketCacheStore(CacheStore):
    """``buckets`` holds for a new store; an existing one keeps its own number. Take so many
    that a bucket of all entries fits a task."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        super().__init__(spark, path)
        if buckets < 1:
            raise ValueError(f"A cache needs at least one bucket, not {buckets}")
        self.buckets = self._layout() or buckets
        self._tables: list[str] = []

    def _layout(self) -> int | None:
        try:
            found = self._files.listStatus(self._path(self.path))
        except Exception:  # nothing there yet, or nothing that can be read
            return None
        names = [one.getPath().getName() for one in found]
        return next((int(name.removeprefix(LAYOUT)) for name in names if name.startswith(LAYOUT)), None)

    def _create(self, place: str, partitioned: str = "") -> str:
        """An external table of buckets over a folder; the name is not used again."""
        name = f"flowtally_cache_{uuid4().hex}"
        more = f", {partitioned} int" if partitioned else ""
        self.spark.sql(
            f"CREATE TABLE {name} ({CACHE_SCHEMA}, {LOOKUP} string{more}) USING parquet "
            + (f"PARTITIONED BY ({partitioned}) " if partitioned else "")
            + f"CLUSTERED BY ({LOOKUP}) INTO {self.buckets} BUCKETS LOCATION '{_quoted(place)}'"
        )
        return name

    def _declare(self, versions: list[int]) -> str:
        name = self._create(self.path, "v")
        self._tables.append(name)
        for version in versions:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (v={version}) LOCATION '{_quoted(self.path)}/v={version}'")
        return name

    def forget(self) -> None:
        """Drop the tables of all readings so far; frames made by them cannot be used any more."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")

    def read(self) -> DataFrame:
        """All complete versions, by bucket; a cache that cannot be read is an empty one."""
        try:
            versions = self._versions()
            if not versions:
                return with_lookup(empty_cache(self.spark))
            return self.spark.table(self._declare(versions)).where(F.col("v").isin(versions)).drop("v")
        except Exception as error:
            log.warning("Answer cache disabled: %s", error)
            return with_lookup(empty_cache(self.spark))

    def append(self, fresh: DataFrame) -> None:
        """Add entries as a version of their own; the run goes on when that fails."""
        try:
            versions = self._versions()
            self._write(fresh, versions[-1] + 1 if versions else 1)
        except Exception as error:
            log.warning("Answer cache not written: %s", error)

    def _write(self, entries: DataFrame, version: int) -> None:
        """What a lost writer left of the version is replaced; the marker of its folder comes
        with the commit."""
        # A task per bucket, so that a version has one file for each.
        dealt = with_lookup(entries.drop(LOOKUP)).repartition(self.buckets, LOOKUP).sortWithinPartitions(LOOKUP)
        table = self._create(f"{self.path}/v={version}")
        dealt.createOrReplaceTempView(f"{table}_new")
        columns = ", ".join([*(part.split()[0] for part in CACHE_SCHEMA.split(", ")), LOOKUP])
        try:
            self.spark.sql(f"INSERT OVERWRITE {table} SELECT {columns} FROM {table}_new")
        finally:
            self.spark.catalog.dropTempView(f"{table}_new")
            self.spark.sql(f"DROP TABLE {table}")
        self._files.create(self._path(f"{self.path}/{LAYOUT}{self.buckets}"), True).close()

    def compact(self, now: datetime) -> None:
        """One version with the newest live entry of each key, without a shuffle of the others
        than by bucket; the older ones go once it is complete."""
        versions = self._versions()
        if not versions:
            return
        self._write(upsert(empty_cache(self.spark), self.read(), now), versions[-1] + 1)
        for old in versions:
            self._files.delete(self._path(f"{self.path}/v={old}"), True)

    def entry(self, resolver: str, key: str, now: datetime) -> DataFrame:
        """The live entry of one key, from its bucket alone."""
        wanted = self.read().where((F.col(LOOKUP) == key) & (F.col("key") == namespace(resolver) + key))
        return live_entries(wanted, resolver, now)
