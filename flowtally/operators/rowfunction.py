"""Lookups by a plain Python function, one key at a time.

The function is called where the keys are: a task hands its keys to a few threads and joins
nothing. A key whose call fails has no answer and an error text; the others are not affected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from flowtally.operators.resolvers import ERROR, RESOLVERS, Step
from flowtally.schema import ANSWER_FIELDS

ResolveOne = Callable[[str], Mapping[str, Any] | None]
DEFAULT_WORKERS = 3
LONGEST_ERROR = 500

_ANSWER = pa.struct([(name, pa.string()) for name in ANSWER_FIELDS])


def from_function(resolve_one: ResolveOne, workers: int = DEFAULT_WORKERS) -> Step:
    """Step of a function from a key to a mapping with any of the answer fields.

    ``None`` and missing or ``None`` fields are empty; other values become text. Up to
    ``workers`` calls run at once in each task. A call that raises, or gives something else,
    leaves its key without an answer, so that nothing of it is cached, and its error in the
    column ``error``. Keys that are not wanted are not asked. A task that is run again asks
    its keys again. The function travels with the job unless it belongs to a module that
    executors can import.
    """
    if workers < 1:
        raise ValueError(f"A lookup needs at least one worker, not {workers}")

    def ask(key: str) -> tuple[dict[str, str] | None, str | None]:
        try:
            found = resolve_one(key)
            if found is None:
                return None, None
            return {name: "" if found.get(name) is None else str(found.get(name)) for name in ANSWER_FIELDS}, None
        except Exception as error:  # whatever the function raises
            return None, f"{type(error).__name__}: {error}"[:LONGEST_ERROR]

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                wanted = batch.column("wanted").to_pylist()
                asked = pool.map(ask, [key for key, one in zip(batch.column("key").to_pylist(), wanted) if one])
                found = [next(asked) if one else (None, None) for one in wanted]
                before = batch.column(ERROR).to_pylist() if ERROR in batch.schema.names else [None] * batch.num_rows
                errors = [new if old is None else old for old, (_, new) in zip(before, found)]
                names = [name for name in batch.schema.names if name != ERROR]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name) for name in names), pa.array(errors, pa.string()), pa.array([a for a, _ in found], _ANSWER)],
                    [*names, ERROR, "answer"],
                )

    def step(frame: DataFrame) -> DataFrame:
        schema = StructType([one for one in frame.schema.fields if one.name != ERROR]).add(ERROR, StringType())
        return frame.mapInArrow(call, schema.add("answer", _answer_type()))

    return step


def _answer_type() -> StructType:
    fields = StructType()
    for name in ANSWER_FIELDS:
        fields = fields.add(name, StringType())
    return fields


def register_function(name: str, workers: int = DEFAULT_WORKERS) -> Callable[[ResolveOne], ResolveOne]:
    """Register a row function as a resolver; the ``workers`` option of a run overrides."""

    def register(resolve_one: ResolveOne) -> ResolveOne:
        RESOLVERS[name] = lambda tables, workers=workers, **_options: from_function(resolve_one, workers)
        return resolve_one

    return register
