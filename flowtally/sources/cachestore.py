"""The answer cache as a Parquet table that grows by versions.

Each run appends its fresh answers as a directory of its own, which counts once its commit
marker is there; nothing stored is written again, and a lost writer leaves the others in
place. Readers take the newest entry of a key. ``compact`` makes one version of all on
request. One writer at a time is assumed.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flowtally.operators.cache import upsert
from flowtally.schema import CACHE_SCHEMA

log = logging.getLogger(__name__)

MARKER = "_SUCCESS"


def empty_cache(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CACHE_SCHEMA)


class CacheStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        root = self._path(self.path)
        if not self._files.exists(root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(root)]
        numbers = [int(name[2:]) for name in names if name.startswith("v=")]
        return sorted(n for n in numbers if self._files.exists(self._path(f"{self.path}/v={n}/{MARKER}")))

    def read(self) -> DataFrame:
        """All complete versions; a cache that cannot be read is an empty one."""
        try:
            folders = [f"{self.path}/v={n}" for n in self._versions()]
            if not folders:
                return empty_cache(self.spark)
            return self.spark.read.schema(CACHE_SCHEMA).parquet(*folders)
        except Exception as error:
            log.warning("Answer cache disabled: %s", error)
            return empty_cache(self.spark)

    def append(self, fresh: DataFrame) -> None:
        """Add entries; the run goes on when that fails."""
        try:
            versions = self._versions()
            fresh.write.mode("overwrite").parquet(f"{self.path}/v={versions[-1] + 1 if versions else 1}")
        except Exception as error:
            log.warning("Answer cache not written: %s", error)

    def compact(self, now: datetime) -> None:
        """One version with the newest live entry of each key; the older ones go once it is
        complete. Readers that began before may fail, so compact between runs."""
        versions = self._versions()
        if not versions:
            return
        upsert(empty_cache(self.spark), self.read(), now).write.mode("overwrite").parquet(f"{self.path}/v={versions[-1] + 1}")
        for old in versions:
            self._files.delete(self._path(f"{self.path}/v={old}"), True)
