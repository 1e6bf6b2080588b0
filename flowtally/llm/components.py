"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import stage


def _smallest_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node with a link; ``root`` is the smallest node of its group.

    ``links`` has columns ``u`` and ``v``; repeated links, loops and both directions are
    fine. Each round hangs every node on the smallest one its neighbours know (large star,
    then small star), so long chains shrink by powers, and each round is a table in the
    shared folder. Smallest neighbours are found by a map-side minimum and joined back, so
    a node with very many links is never gathered in one task.
    """
    edges = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v"), F.col("v"))
            ).distinct()
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = _smallest_neighbour(both).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stage(large.where("u <> v").distinct(), "links")
        least = _smallest_neighbour(down)
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(
            small.where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct(), "links"
        )
