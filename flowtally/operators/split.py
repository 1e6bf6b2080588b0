"""Label connections by source subnet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.functions.addresses import OTHER_LABEL, subnet_label
from flowtally.functions.clock import slice_name
from flowtally.functions.networks import Network
from flowtally.functions.text import clean
from flowtally.operators.attach import attach, key_counts
from flowtally.operators.prefixes import parse_prefixes, with_best_prefix


def with_label(frame: DataFrame, networks: Sequence[Network], source: str = "SrcIP") -> DataFrame:
    """Add ``subnet``: the label of the first listed network holding the source.

    Every row looks through the whole list, however long it is; use :func:`with_label_from`
    where a long list is worth matching each distinct source once."""
    if source not in frame.columns:
        raise ValueError(f"Splitting by subnet needs a '{source}' column")
    return frame.withColumn("subnet", subnet_label(F.col(source), networks))


def with_label_from(frame: DataFrame, networks: DataFrame, source: str = "SrcIP") -> DataFrame:
    """The same for a table ``(position, network, label)`` of any size: each distinct
    source is matched once, then joined back. ``frame`` is read twice, so stage it first
    when it is expensive; for a stream there is :func:`with_label_on_stream`."""
    key = clean(F.col(source))
    counts = key_counts(frame, key)
    labels = with_best_prefix(counts, parse_prefixes(networks), F.col("position"), F.col("label"), "subnet")
    labelled = attach(frame, labels, F.nullif(key, F.lit("")))
    return labelled.fillna(OTHER_LABEL, ["subnet"])


#: Tasks that share the rows of one block of addresses in a micro-batch.
STREAM_SPREAD = 16


def with_label_on_stream(stream: DataFrame, networks: DataFrame, source: str = "SrcIP", spread: int = STREAM_SPREAD) -> DataFrame:
    """The same for a stream: each row is joined to the gathered networks of its block.

    The networks are a table of their own, read anew in every micro-batch, so a list that is
    written again holds from the next one on. No state is kept; rows come out in the
    micro-batch they came in with, so every output mode and sink that takes rows will do. A
    frequent source is dealt to ``spread`` tasks; the networks are copied that often."""
    if source not in stream.columns:
        raise ValueError(f"Splitting by subnet needs a '{source}' column")
    if "key" in stream.columns:
        raise ValueError("A stream to be labelled cannot have a column 'key'")
    keyed = stream.withColumn("key", clean(F.col(source)))
    labelled = with_best_prefix(keyed, parse_prefixes(networks), F.col("position"), F.col("label"), "subnet", spread)
    return labelled.drop("key").fillna(OTHER_LABEL, ["subnet"])


def split_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("subnet").agg(F.count(F.lit(1)).alias("rows"))


def with_slice(
    labelled: DataFrame, now: datetime, start: int, end: int, unit: str, prefix: str = "aggregation"
) -> DataFrame:
    """Add ``slice``, the file name of the part a row belongs to."""
    return labelled.withColumn("slice", slice_name(prefix, F.col("subnet"), now, start, end, unit))
