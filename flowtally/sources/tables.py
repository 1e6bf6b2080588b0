"""CSV files in and out, with every column a string."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowtally.operators.merge import MERGE_WAYS, aligned
from flowtally.schema import ORDER_COLUMNS, present

# ``NA`` and the like are data; only an empty field is missing.
READ_OPTIONS = {"header": "true", "inferSchema": "false", "escape": '"', "enforceSchema": "true"}
READ_MODES = ("PERMISSIVE", "FAILFAST")
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


#: Bytes of an input read at first to find its header and whether it has rows.
PEEK = 1 << 16
#: Inputs looked at side by side.
PEEKS = 16


@dataclass(frozen=True)
class Head:
    """Column names of an input, none for an empty one, and whether it has rows."""

    names: tuple[str, ...]
    has_rows: bool


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of one input, none for an empty one; reads its first bytes only."""
    return list(heads(spark, [path])[0].names)


def heads(spark: SparkSession, paths: Sequence[str]) -> list[Head]:
    """The head of each input, a file, a folder or a pattern, without a Spark job.

    Of each only the beginning is read, until there is a row or its end, a few inputs at a
    time. A folder has the header of its first file that is not empty, and rows if any file
    has."""
    with ThreadPoolExecutor(PEEKS) as pool:
        return list(pool.map(lambda path: _head(spark, path), paths))


def _files(spark: SparkSession, path: str) -> Iterator[Any]:
    """The files below a path in order of their names, without hidden ones."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(place)
    if not found:
        raise FileNotFoundError(f"There is no input {path}")
    waiting = sorted(found, key=lambda one: one.getPath().toString(), reverse=True)
    while waiting:
        one = waiting.pop()
        if not one.isDirectory():
            yield one
            continue
        inside = [x for x in store.listStatus(one.getPath()) if not x.getPath().getName().startswith(("_", "."))]
        waiting += sorted(inside, key=lambda x: x.getPath().toString(), reverse=True)


def _head(spark: SparkSession, path: str) -> Head:
    names: tuple[str, ...] = ()
    for one in _files(spark, path):
        if one.getLen() == 0:
            continue
        found = _file_head(spark, one.getPath())
        names = names or found.names
        if found.has_rows:
            return Head(names, True)
    return Head(names, False)


def _file_head(spark: SparkSession, place: Any) -> Head:
    """The first two records that are not blank; more is read while they are not complete."""
    size = PEEK
    while True:
        text, ended = _beginning(spark, place, size)
        if not ended:
            # The last line may be cut, even inside a letter.
            text = text[: text.rfind("\n") + 1]
        records = []
        try:
            for record in csv.reader(io.StringIO(text, newline=""), strict=True):
                if any(record):
                    records.append(record)
                if len(records) == 2:
                    break
        except csv.Error:
            if ended:  # a quote that is never closed, or a very long field: Spark decides
                reader = spark.read.options(**READ_OPTIONS)
                names = reader.csv(place.toString()).columns
                return Head(tuple(names), bool(names) and not reader.schema(text_schema(names)).csv(place.toString()).isEmpty())
        if len(records) == 2 or ended:
            return Head(_column_names(records[0]) if records else (), len(records) == 2)
        size *= 8


def _beginning(spark: SparkSession, place: Any, size: int) -> tuple[str, bool]:
    """The first ``size`` bytes of a file as text, and whether that is all."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    plain = stream if codec is None else codec.createInputStream(stream)
    try:
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(plain, size + 1)))
    finally:
        plain.close()
    return data[:size].decode("utf-8", "replace").removeprefix("\ufeff"), len(data) <= size


def _column_names(record: Sequence[str]) -> tuple[str, ...]:
    """Names as Spark gives them: unnamed columns by place, repeated names with their place."""
    return tuple(f"_c{i}" if not name else f"{name}{i}" if record.count(name) > 1 else name for i, name in enumerate(record))


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """One scan of all paths; columns are bound by position to ``columns`` or to the
    header of the first path.

    ``multiline=False`` lets Spark split large files; use it where no quoted field
    holds a line break. A row shorter than the header is filled with empty text; one that
    holds more fails the read. ``mode="FAILFAST"`` refuses short rows as well.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = list(columns) if columns is not None else header(spark, paths[0])
    if not names:
        raise ValueError("The CSV input is empty")
    reader = spark.read.options(**READ_OPTIONS, multiLine=str(multiline).lower(), mode=mode)
    if mode == "FAILFAST":
        return reader.schema(text_schema(names)).csv(paths).fillna("")
    # What lies beyond the header is read as one more column, which must stay empty.
    beyond = "beyond the header"
    rows = reader.schema(text_schema([*names, beyond])).csv(paths)
    message = F.lit(f"A CSV row has more than {len(names)} fields")
    # A condition, because it holds whichever columns are asked for.
    fits = F.when(F.col(f"`{beyond}`").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(fits).drop(beyond).fillna("")


def merge_files(
    spark: SparkSession,
    paths: Sequence[str],
    how: str = "name",
    multiline: bool = True,
    mode: str = "PERMISSIVE",
    before: DataFrame | None = None,
) -> DataFrame:
    """Concatenate ``before``, if any, and CSV files. ``position`` takes the columns of the
    first of them that has any and ignores other headers; ``name`` aligns to the columns of
    the first that has rows. Files with equal headers are read in one scan, and looking at
    the headers takes no job, however many files there are."""
    if how not in MERGE_WAYS:
        raise ValueError(f"Unknown merge '{how}'. Available: {', '.join(MERGE_WAYS)}")
    seen = {path: head for path, head in zip(paths, heads(spark, paths)) if head.names}
    headers = [(path, list(seen[path].names)) for path in paths if path in seen]
    if how == "position":
        columns = before.columns if before is not None else headers[0][1] if headers else None
        groups = {(): [path for path, _ in headers]} if headers else {}
    else:
        before = None if before is None or before.isEmpty() else before
        columns = None if before is None else before.columns
        groups = {}
        for path, names in headers:
            if columns is None and not seen[path].has_rows:
                continue
            columns = names if columns is None else columns
            groups.setdefault(tuple(names), []).append(path)
        before = None if before is not None and columns is not before.columns and not groups else before
    if columns is None:
        raise ValueError("No non-empty input to merge")
    parts = [] if before is None else [aligned(before, columns) if how == "name" else before]
    for names, group in groups.items():
        read = read_csv(spark, group, list(names) or columns, multiline, mode)
        parts.append(read if how == "position" else aligned(read, columns))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    return merged


def _as_text(frame: DataFrame) -> DataFrame:
    return frame.select([F.col(name).cast("string").alias(name) for name in frame.columns]).fillna("")


def _write(frame: DataFrame, path: str, mode: str, seen: Observation | None, parts: list[str]) -> None:
    """Counting comes after any sort: the sort's own sampling pass would count twice."""
    if seen is not None:
        frame = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = _as_text(frame).write.mode(mode).options(**WRITE_OPTIONS)
    (writer.partitionBy(*parts) if parts else writer).csv(path)


def write_csv(frame: DataFrame, path: str, mode: str = "errorifexists", seen: Observation | None = None) -> None:
    """A directory of CSV parts, each with a header, in the frame's order. ``seen`` gets
    the number of rows."""
    _write(frame, path, mode, seen, [])


def write_split(
    labelled: DataFrame,
    path: str,
    mode: str = "errorifexists",
    seen: Observation | None = None,
    by_count: bool = True,
) -> None:
    """One directory ``slice=<name>`` per subnet. Rows are range-partitioned by slice and
    result order, so a large subnet is written by many tasks, in order; the input
    partition breaks ties between equal rows."""
    order = [F.desc("count")] if by_count and "count" in labelled.columns else []
    order += [F.col(name) for name in present(labelled.columns, ORDER_COLUMNS)]
    numbered = labelled.withColumn("_part", F.spark_partition_id())
    placed = numbered.orderBy("slice", *order, "_part").drop("_part", "subnet")
    _write(placed, path, mode, seen, ["slice"])
