"""Concatenate frames; duplicates are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERGE_WAYS = ("name", "position")


def aligned(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``: absent ones are empty text, others are dropped."""
    have = set(frame.columns)
    return frame.select([(F.col(name) if name in have else F.lit("")).alias(name) for name in columns])


def merge_frames(frames: Sequence[DataFrame | None], how: str = "name") -> DataFrame:
    """Align frames to the first one.

    ``name``: the first frame with rows gives the columns, and the frames after it are not
    asked whether they have any; columns a frame lacks are empty text, and further ones are
    dropped. ``position``: columns are taken in order under the first frame's names.
    """
    given = [frame for frame in frames if frame is not None]
    if how not in MERGE_WAYS:
        raise ValueError(f"Unknown merge '{how}'. Available: {', '.join(MERGE_WAYS)}")
    if how == "name":
        first = next((i for i, frame in enumerate(given) if not frame.isEmpty()), len(given))
        given = given[first:]
    if not given:
        raise ValueError("No non-empty input to merge")
    merged, columns = given[0], given[0].columns
    for frame in given[1:]:
        merged = merged.union(frame.toDF(*columns) if how == "position" else aligned(frame, columns))
    return merged
