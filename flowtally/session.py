"""Session settings the semantics rest on, and stage tables that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can be applied to a session somebody else built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join on several keys may use rows that are already dealt by some of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", app: str = "flowtally", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    # Recording the Python line of every expression takes longer than making it.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="flowtally-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


# Paths of the stage tables made in each open scope.
_scopes: list[list[str]] = []


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to a new table in the shared folder and return it re-read.

    The table outlives lost executors, is read column by column, and has known
    statistics, so that Catalyst may broadcast it when it is small.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/flowtally-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the stage tables made inside when leaving; results must be written by then."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, made):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
