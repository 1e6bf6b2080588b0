"""Predicates over raw log rows, each one a Catalyst expression.

Those on bare columns (time range, stream, existence, allowlist, octet prefix) reach
the scan; the address arithmetic runs on what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from flowtally.functions.addresses import (
    in_networks,
    is_ipv4,
    is_private,
    starts_between,
    starts_in_networks,
)
from flowtally.functions.clock import check_range, instant, shift_now
from flowtally.functions.networks import Network, ipv4_only
from flowtally.operators.prefixes import parse_prefixes, with_best_prefix
from flowtally.schema import STREAM_FIELD

MATCH_MODES = ("or", "and")


def in_time_range(
    frame: DataFrame, now: datetime, start: int, end: int, unit: str, column: str = "timestamp"
) -> Column:
    """``now-start <= column < now-end``."""
    check_range(start, end)
    kind = frame.schema[column].dataType.simpleString()
    at = F.col(column) if kind in ("timestamp", "timestamp_ntz") else F.col(column).try_cast("timestamp")
    return (at >= instant(shift_now(now, start, unit), kind)) & (at < instant(shift_now(now, end, unit), kind))


def in_stream(frame: DataFrame, stream_id: str, column: str = STREAM_FIELD) -> Column:
    """The stream id is the field's value, or one of its values."""
    if isinstance(frame.schema[column].dataType, ArrayType):
        return F.array_contains(column, stream_id)
    return F.col(column) == stream_id


def exists(*columns: str) -> Column:
    """Present and not the empty string."""
    return reduce(lambda left, right: left & right, [F.col(c).isNotNull() & (F.col(c) != "") for c in columns])


def both_ipv4(source: str = "SrcIP", destination: str = "DstIP") -> Column:
    return is_ipv4(F.col(source)) & is_ipv4(F.col(destination))


def public_destination(destination: str = "DstIP") -> Column:
    return ~is_private(F.col(destination))


def source_prefilter(
    allowlist: Sequence[str], networks: Sequence[Network], mode: str = "or", source: str = "SrcIP"
) -> Column | None:
    """The source filter as a log store answers it: the list exactly, each network only
    by its octets. It never rejects a match."""
    return _combine(
        F.col(source).isin(list(allowlist)) if allowlist else None,
        starts_in_networks(F.col(source), networks) if networks else None,
        mode,
    )


def source_hint(
    allowlist: Sequence[str], networks: Sequence[Network], mode: str = "or", source: str = "SrcIP"
) -> Column | None:
    """Implied by ``source_match`` and made of ranges of text alone, so that it reaches the
    scan and is as small for a long list as for a short one."""
    prefixes = [net.octets for net in ipv4_only(networks)]
    if networks and not prefixes:
        inside = F.lit(False)
    else:
        inside = starts_between(F.col(source), prefixes) if prefixes else None
    listed = starts_between(F.col(source), list(allowlist)) if allowlist else None
    if mode == "or" and listed is not None and prefixes:
        return starts_between(F.col(source), [*allowlist, *prefixes])
    return _combine(listed, inside, mode)


def source_match(
    allowlist: Sequence[str], networks: Sequence[Network], mode: str = "or", source: str = "SrcIP"
) -> Column | None:
    """Source in the list, in a network, in either (``or``) or in both (``and``).
    With one of the two given only that one counts; with none there is no filter."""
    return _combine(
        F.col(source).isin(list(allowlist)) if allowlist else None,
        in_networks(F.col(source), networks) if networks else None,
        mode,
    )


def in_source_tables(
    rows: DataFrame,
    addresses: DataFrame | None = None,
    networks: DataFrame | None = None,
    mode: str = "or",
    source: str = "SrcIP",
) -> DataFrame:
    """Rows whose source matches as in ``source_match``, for lists of any length given as
    tables: ``(address)`` and ``(network)``. All columns are kept.

    Each distinct source is matched once: by a join with the addresses, and by the prefix
    join with the networks. ``rows`` is read twice.
    """
    if mode not in MATCH_MODES:
        raise ValueError(f"Unknown match mode '{mode}'. Available: {', '.join(MATCH_MODES)}")
    if addresses is None and networks is None:
        return rows
    found = rows.where(F.col(source).isNotNull()).select(F.col(source).alias("key")).distinct()
    tests = []
    if addresses is not None:
        listed = addresses.select(F.col("address").alias("key"), F.lit(True).alias("_listed")).distinct()
        found = found.join(listed, "key", "left")
        tests.append(F.col("_listed").isNotNull())
    if networks is not None:
        prefixes = parse_prefixes(networks)
        found = with_best_prefix(found, prefixes, -F.col("length"), F.lit(True), "_inside")
        tests.append(F.col("_inside").isNotNull() & is_ipv4(F.col("key")))
    wanted = tests[0] if len(tests) == 1 else tests[0] & tests[1] if mode == "and" else tests[0] | tests[1]
    return rows.join(found.where(wanted).select(F.col("key").alias(source)), source, "left_semi").select(*rows.columns)


def _combine(listed: Column | None, inside: Column | None, mode: str) -> Column | None:
    if mode not in MATCH_MODES:
        raise ValueError(f"Unknown match mode '{mode}'. Available: {', '.join(MATCH_MODES)}")
    if listed is None or inside is None:
        return inside if listed is None else listed
    return listed & inside if mode == "and" else listed | inside
