"""Match addresses against many network prefixes without comparing pairs.

Prefixes are gathered per /16 (lengths 16 to 23) and per /24 (lengths 24 to 32), and
an address is joined to the one gathering of each kind that can hold it. Shorter
prefixes are opened into their /16 parts first. A gathering then has at most 511
prefixes and a join key at most 65,536 distinct addresses, however wide or dense the
prefixes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.functions.addresses import OCTET, ipv4_number
from flowtally.functions.text import clean

WIDE, NARROW = 16, 24
PREFIX = rf"\A{OCTET}(?:\.{OCTET}){{3}}(?:/(?:3[0-2]|[12]?[0-9]))?\z"


def parse_prefixes(frame: DataFrame, network: str = "network") -> DataFrame:
    """Add ``low``, ``length`` and ``size`` of IPv4 networks; other rows are dropped."""
    text = clean(F.col(network))
    length = F.coalesce(F.split_part(text, F.lit("/"), F.lit(2)).try_cast("int"), F.lit(32))
    size = prefix_size(F.col("length"))
    number = ipv4_number(F.split_part(text, F.lit("/"), F.lit(1)))
    return (
        frame.where(text.rlike(PREFIX))
        .withColumns({"length": length, "_ip": number})
        .withColumns({"size": size, "low": F.col("_ip") - F.col("_ip") % size})
        .drop("_ip")
    )


def prefix_size(length: Column) -> Column:
    """Number of addresses under a prefix."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - length)


def with_best_prefix(
    keys: DataFrame, prefixes: DataFrame, rank: Column, value: Column, output: str = "value", spread: int = 1
) -> DataFrame:
    """Add the value of the lowest-ranked prefix holding each ``key``, NULL where there
    is none. All rows and columns are kept; the work is bounded as described above when
    the keys are distinct. ``prefixes`` comes from ``parse_prefixes``.

    Where keys repeat, ``spread`` deals the rows of a block to so many tasks, and each of
    them gets the gathering of the block."""
    part = 1 << (32 - WIDE)
    parts = F.sequence(F.col("low"), F.col("low") + F.col("size") - part, F.lit(part).cast("bigint"))
    table = (
        prefixes.select(
            F.greatest(F.col("length"), F.lit(WIDE)).alias("length"),
            F.explode(F.when(F.col("length") < WIDE, parts).otherwise(F.array("low"))).alias("low"),
            F.struct(rank.alias("rank"), value.alias("value")).alias("best"),
        )
        .groupBy("length", "low")
        .agg(F.min("best").alias("best"))
    )
    # Keys that are no address get a block of their own below zero, which holds nothing.
    nowhere = -1 - F.abs(F.hash("key")).cast("bigint")
    found = keys.withColumn("_ip", ipv4_number(clean(F.col("key")))).withColumns(
        {
            "_wide": F.coalesce(F.shiftright("_ip", 32 - WIDE), nowhere),
            "_narrow": F.coalesce(F.shiftright("_ip", 32 - NARROW), nowhere),
        }
    )
    # The /16 leads both joins, so that one shuffle of the keys serves both.
    wide = _gather(table.where(F.col("length") < NARROW), {"_wide": WIDE}).withColumnRenamed("held", "_held_wide")
    narrow = _gather(table.where(F.col("length") >= NARROW), {"_wide": WIDE, "_narrow": NARROW}).withColumnRenamed("held", "_held_narrow")
    block = ["_wide"]
    if spread > 1:
        block = ["_wide", "_spread"]
        found = found.withColumn("_spread", F.pmod(F.xxhash64(*keys.columns), F.lit(spread)).cast("int"))
        copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_spread")
        wide, narrow = wide.select("*", copies), narrow.select("*", copies)
    found = found.join(wide, block, "left").join(narrow, [*block, "_narrow"], "left")
    best = F.least(_first_holding("_held_wide"), _first_holding("_held_narrow"))
    return found.withColumn(output, best["value"]).drop("_ip", *block, "_narrow", "_held_wide", "_held_narrow")


def _gather(table: DataFrame, blocks: dict[str, int]) -> DataFrame:
    """The prefixes inside each block, best ones first; ``blocks`` names the bits of its keys."""
    high = F.col("low") + prefix_size(F.col("length")) - 1
    return table.groupBy(*[F.shiftright("low", 32 - bits).alias(name) for name, bits in blocks.items()]).agg(
        F.sort_array(F.collect_list(F.struct("best", "low", high.alias("high")))).alias("held")
    )


def _first_holding(name: str) -> Column:
    held = F.filter(name, lambda one: (F.col("_ip") >= one["low"]) & (F.col("_ip") <= one["high"]))
    return F.get(held, F.lit(0))["best"]
