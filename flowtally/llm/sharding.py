"""Shards by a hierarchical weighted hash tree.

A document descends from the root to a region, a rack and a shard. At each level every
child draws ``-ln(u) / weight``, where ``u`` comes from a hash of the document's key and the
child's name, and the smallest draw wins. A child's weight is the sum below it. When a
weight grows, other children's draws stay, so documents move only into the subtree that
grew; when it shrinks, only out of it.

Law ``key``: the id and the tree decide, nothing else. A shard added by :func:`grown` is a
region of its own, so rows move only into the new shard.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import spread_key, start_positions

SHARDS = 40
RACKS_OF_REGION = 2
SHARDS_OF_RACK = 4
#: Added to a text's bytes for what is stored beside it.
OVERHEAD = 16

#: (region, rack, shard, weight)
Leaf = tuple[str, str, int, float]


def tree(shards: int = SHARDS) -> list[Leaf]:
    """Equal shards in racks of four and regions of two racks, the last ones perhaps smaller."""
    leaves = []
    for shard in range(shards):
        rack = shard // SHARDS_OF_RACK
        leaves.append((f"region{rack // RACKS_OF_REGION}", f"rack{rack}", shard, 1.0))
    return leaves


def grown(leaves: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own."""
    new = max(leaf[2] for leaf in leaves) + 1
    return [*leaves, (f"added{new}", f"added{new}", new, weight)]


def _draw(key: Column, name: Column, weight: Column) -> Column:
    hexes = F.substring(F.md5(F.concat_ws("/", key, name)), 1, 13)
    u = (F.conv(hexes, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _winner(key: Column, children: Column) -> Column:
    """Name of the child with the smallest draw; equal draws go by name."""
    return F.array_min(F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("d"), c["name"].alias("name"))))["name"]


def _children(weights: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(w)).alias("weight")) for name, w in sorted(weights.items())])


def shard_of(key: Column, leaves: Sequence[Leaf]) -> Column:
    """The shard of a key. Names of racks must differ between regions."""
    regions: dict[str, float] = defaultdict(float)
    racks: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[str, dict[str, float]] = defaultdict(dict)
    for region, rack, shard, weight in leaves:
        if weight <= 0:
            continue
        regions[region] += weight
        racks[region][rack] += weight
        shards[rack][f"shard{shard}"] = weight
    if not regions:
        raise ValueError("A tree needs a shard with a positive weight")

    def below(choices: dict[str, dict[str, float]]) -> Column:
        return F.create_map(*[x for name, kids in sorted(choices.items()) for x in (F.lit(name), _children(kids))])

    # Bound step by step: a name used twice is worked out once.
    region = _winner(key, _children(regions))
    rack = F.transform(F.array(region), lambda r: _winner(key, F.element_at(below(racks), r)))
    shard = F.transform(rack, lambda r: _winner(key, F.element_at(below(shards), r)))
    return F.substring(shard[0], 6, 10).cast("int")


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD


def sharded(docs: DataFrame, leaves: Sequence[Leaf] | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for each row of ``docs``.

    ``slot`` counts a shard's rows from 0 without gaps, in order of the hashed id, then text
    checksum and size; rows equal in all of these may take each other's slots. NULL text has
    no bytes and checksum 0; a NULL id is a key of its own. Rows that repeat an id share a
    shard and take a slot each. An empty table gives no rows. Other columns are not read.
    """
    leaves = tree() if leaves is None else leaves
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_size(F.col("text")).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, leaves).alias("shard"),
        shard_of(key, grown(leaves)).alias("grown_shard"),
        spread_key(F.col("doc_id")).alias("spread"),
    ).withColumn("bucket", F.substring("spread", 1, 3))
    placed = start_positions(rows, ["shard"], "bucket", ["spread", "text_crc32", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
