"""Interleave sources at target weights by Pfair scheduling.

A source with ``parts`` of every ``slots`` slots owes its block number ``j`` (from 0) in the
window from its release ``floor(j * slots / parts)`` to its deadline
``ceil((j + 1) * slots / parts)``. In each slot the released block with the earliest deadline
goes (of equal ones the first source), so that at any time each source is less than one block
off its target share.

The schedule is worked out in segments, each a row of its own, that need nothing of each other.
At a slot ``T`` every block with a deadline up to ``T`` has gone, so what is open is which
sources have had the block whose window holds ``T``. Those blocks go only in slots that no
earlier deadline asks for, and all of them were released in the ``slots / parts`` of the smallest
source before ``T``. A segment therefore starts that much earlier with the *number* of blocks
still owed from before (released ones less slots gone by), lets those go first, and has at ``T`` the state that a run
from slot 0 has.

The mixture ends with the slot in which every document has occurred: a source that runs out
before starts again (its next epoch). Nothing is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import spread_key, start_positions
from flowtally.session import stage

#: Documents of a block.
BLOCK = 16
#: Parts of the whole that weights are held in. A billion slots are then 0.01 blocks off the weights.
PARTS = 1 << 36
#: Slots of a segment at most, and those gathered at once within it.
SEGMENT_SLOTS, STRETCH = 1 << 17, 256
#: Weights default to document counts to this power, which lifts small sources.
TEMPERATURE = 0.8

# One segment of the schedule: earliest deadline first over ``length`` slots from ``base``, of which
# those from ``warm`` on are kept. Work owed from before ``base`` goes first.
SEGMENT = f"""
flatten(aggregate(
  sequence(0L, (length - 1) div {STRETCH}),
  named_struct(
    'given', transform(sources, s -> 0L),
    'owed', owed,
    'done', cast(array() AS array<array<struct<i: int, j: bigint, slot: bigint>>>)),
  (whole, c) -> transform(
    array(aggregate(
      sequence(c * {STRETCH}, least(length, (c + 1) * {STRETCH}) - 1),
      named_struct(
        'given', whole.given,
        'owed', whole.owed,
        'order', cast(array() AS array<struct<i: int, j: bigint, slot: bigint>>)),
      (state, t) -> transform(
        array(if(state.owed > 0, -1, array_min(filter(
          transform(sources, (s, i) -> named_struct(
            'deadline', ((state.given[i] + 1) * slots + s.phase + s.parts - 1) div s.parts,
            'i', i,
            'release', (state.given[i] * slots + s.phase) div s.parts)),
          x -> x.release <= t)).i)),
        next -> named_struct(
          'given', if(next < 0, state.given, transform(state.given, (g, i) -> if(i = next, g + 1, g))),
          'owed', greatest(state.owed - 1, 0L),
          'order', if(next < 0 OR t < warm, state.order,
            array_append(state.order, named_struct('i', next, 'j', sources[next].first + state.given[next], 'slot', base + t)))))[0])),
    part -> named_struct('given', part.given, 'owed', part.owed, 'done', array_append(whole.done, part.order)))[0]
).done)
"""


def source_key(column: str = "source"):
    """Text that tells a missing source from every named one."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("missing"))


def schedule(counts: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, slots: int = PARTS, segment: int = SEGMENT_SLOTS) -> DataFrame:
    """``(src, turn, slot, blocks, length)``: the slots of all turns of each source of ``(src, total)``.

    Weights are held in parts of about ``slots``. ``segment`` bounds the slots of one row's work.
    """
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("total").cast("double"), F.lit(TEMPERATURE)))
    else:
        given = [{"src": "missing" if name is None else f"={name}", "weight": float(w)} for name, w in weights.items() if w > 0]
        listed = F.from_json(F.lit(json.dumps(given)), "array<struct<src: string, weight: double>>")
        weighed = counts.join(counts.sparkSession.range(1).select(F.inline(listed)), "src")
    one = weighed.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("weight").alias("sum"),
        F.array_sort(F.collect_list(F.struct("src", "total", "weight"))).alias("all"),
    ).where("n > 0")
    parts = one.selectExpr(
        f"""transform(all, s -> named_struct('src', s.src, 'blocks', (s.total + {block - 1}) div {block},
            'parts', greatest(cast(round(s.weight / sum * {slots}) AS bigint), 1L))) AS sources"""
    ).selectExpr("sources", "aggregate(sources, 0L, (a, s) -> a + s.parts) AS slots")
    sized = parts.selectExpr(
        "*",
        "(slots + array_min(sources.parts) - 1) div array_min(sources.parts) + 1 AS window",
        "array_max(transform(sources, s -> (cast(s.blocks AS decimal(19)) * slots + s.parts - 1) div s.parts)) AS latest",
    ).selectExpr("*", f"greatest(least(window, {segment}L), {min(segment, STRETCH)}L) AS step")
    # One row for each segment; its number is fixed, so that segments are dealt out and not put together.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = (
        sized.selectExpr("*", "explode(sequence(0L, (latest - 1) div step)) AS k")
        .repartition(tasks, "k")
        .selectExpr("sources", "slots", "k * step AS begin", "least(latest, (k + 1) * step) AS end", "greatest(0L, k * step - window) AS base")
        .selectExpr(
            """transform(transform(sources, s -> named_struct('s', s,
                'first', (cast(base AS decimal(19)) * s.parts + slots - 1) div slots)), x -> named_struct(
                'src', x.s.src, 'blocks', x.s.blocks, 'parts', x.s.parts, 'first', x.first,
                'phase', cast(cast(x.first AS decimal(19)) * slots - cast(base AS decimal(19)) * x.s.parts AS bigint))) AS sources""",
            "slots", "base", "begin - base AS warm", "end - base AS length",
        )
        .selectExpr("*", "aggregate(sources, 0L, (a, s) -> a + s.first) - base AS owed")
    )
    turns = (
        segments.selectExpr("sources", f"explode({SEGMENT}) AS x")
        .selectExpr("sources[x.i].src AS src", "x.j AS turn", "x.slot AS slot", "sources[x.i].blocks AS blocks")
    )
    # Written once: its end is read from it, and the join with the documents knows its size.
    turns = stage(turns, "mixing-turns")
    length = turns.where("turn = blocks - 1").agg(F.max("slot") + 1).first()[0] or 0
    return turns.where(F.col("slot") < length).withColumn("length", F.lit(length).cast("bigint"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        source_key().alias("src"),
        spread_key(F.col("doc_id")).alias("spread"),
        F.md5(F.coalesce("text", F.lit(""))).alias("tie"),
    ).withColumn("bucket", F.substring("spread", 1, 3))


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, block: int = BLOCK, slots: int = PARTS, segment: int = SEGMENT_SLOTS
) -> DataFrame:
    """``(row, src, block, epoch, slot, position, length)`` for every place of a document in the mixture.

    ``row`` holds all columns of ``docs``, whatever their names. Documents of a source are
    taken in order of their hashed id; rows with equal ids are ordered by a
    checksum of their text. ``slot`` is
    the place of the block in the schedule and ``position`` that of the document; both grow
    in the order of the mixture, which has ``length`` slots. A missing source is a source of its own. With ``weights``,
    a source without a positive weight has no place. An empty table gives no rows. A weight
    is held in whole parts of about ``slots``, one at least; there is no limit on sources.
    """
    keyed = _keyed(docs)
    counts = keyed.groupBy("src").agg(F.count(F.lit(1)).alias("total"))
    turns = schedule(counts, weights, block, slots, segment).selectExpr("src", "slot", "length", "turn % blocks AS block", "turn div blocks AS epoch")
    placed = start_positions(keyed, ["src"], "bucket", ["spread", "tie"], "number").withColumn("block", F.expr(f"number div {block}"))
    return (
        placed.join(turns, ["src", "block"])
        .withColumn("position", F.expr(f"slot * {block} + number % {block}"))
        .select("row", "src", "block", "epoch", "slot", "position", "length")
    )


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """The mixture itself: the columns of ``docs``, in parts that follow each other in its order."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Slots are full, so equal runs of slots are parts of equal size.
    part = F.expr(f"cast(slot * {parts} div length AS int)")
    return mix(docs, weights).repartitionById(parts, part).sortWithinPartitions("position").select("row.*")
