"""Ranked lexical search: the best documents for each item, by the Best Position Algorithm.

Documents are indexed in shards of about ``SHARD`` postings. A shard holds an impact list
for each term of the items: its documents by falling impact, with a direct access from a
document to its impact and its position. For an item the lists are read from the top, all
to the same depth. Every document met is looked up in all lists at once, which also marks
the position it has there; the best position of a list is the last one before the first
unmarked. A document that was not met stands behind the best position of every list, so
the weighted sum of the impacts there bounds its score, and reading stops as soon as that
sum is strictly below the score of rank ``TOP``.

Items are read in blocks of about ``BLOCK_CHARS`` characters, each searched in all documents,
so that what a task and the driver hold stays bounded however many items there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtally.session import stage

TOP = 10
SHARD = 1 << 21
BLOCK_CHARS = 4 << 20
#: Positions of each list read first; every further reading goes four times as deep.
FIRST_DEPTH = 64
#: Groups in which the tasks' best documents meet before the last ranking.
GROUPS = 64

# Terms are runs of digits, letters and everything beyond ASCII; lower() of bytes is A to Z only.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_PIECE = 1 << 20


def term_counts(text: bytes | None) -> Counter:
    """Uses of each term; a long text is read in pieces that end between terms."""
    data = (text or b"").lower()
    if len(data) <= _PIECE:
        return Counter(_TERM.findall(data))
    counts: Counter = Counter()
    low = 0
    while low < len(data):
        gap = _GAP.search(data, low + _PIECE)
        high = gap.start() if gap else len(data)
        counts.update(_TERM.findall(data, low, high))
        low = high
    return counts


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Items:
    """A block of items; terms are numbers in ``vocabulary``, each once with its repeats."""

    vocabulary: dict[bytes, int]
    ids: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def numbered(rows: list[tuple[int | None, bytes | None]]) -> Items:
    items = Items({}, [], [], [])
    for item_id, text in rows:
        counts = term_counts(text)
        items.ids.append(item_id)
        items.terms.append(np.array([items.vocabulary.setdefault(t, len(items.vocabulary)) for t in counts], np.int32))
        items.repeats.append(np.array(list(counts.values()), np.int64))
    return items


def _posting_batches(vocabulary: dict[bytes, int]):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            terms: list[int] = []
            uses: list[int] = []
            ends = np.zeros(batch.num_rows + 1, np.int32)
            for i, text in enumerate(batch.column("text")):
                counts = term_counts(text.as_py())
                n[i] = counts.total()
                for term in counts.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    uses.append(counts[term])
                ends[i + 1] = len(terms)
            ends_array = pa.array(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n),
                    pa.ListArray.from_arrays(ends_array, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(ends_array, pa.array(uses, pa.int64())),
                ],
                ["doc_id", "n", "terms", "uses"],
            )

    return postings


class Shard:
    """Impact lists over some documents, with direct access by document."""

    def __init__(self, sizes: np.ndarray, holders: np.ndarray, terms: np.ndarray, uses: np.ndarray, n_terms: int) -> None:
        """``sizes``: ``m`` of each document; ``holders``: the document of each posting, rising."""
        self.n_docs = len(sizes)
        impacts = (1_000_000_000 * uses // (1000 * uses + 8 * sizes[holders])).astype(np.int32)
        by_doc = np.argsort(terms, kind="stable")
        self.doc, self.impact = holders[by_doc].astype(np.int32), impacts[by_doc]
        self.start = np.searchsorted(terms[by_doc], np.arange(n_terms + 1))
        #: Places of the postings by term, then falling impact, then document.
        self.ranked = np.lexsort((-self.impact, terms[by_doc]))
        self.position = np.empty(len(terms), np.int32)
        self.position[self.ranked] = np.arange(len(terms)) - np.repeat(self.start[:-1], np.diff(self.start))

    def best(self, terms: np.ndarray, weights: np.ndarray, top: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores that hold all of the ``top`` best with a score of ``floor``
        or more, and how many postings of each list were read at most."""
        lists = [(self.start[t], self.start[t + 1], w) for t, w in zip(terms, weights) if w > 0 and self.start[t + 1] > self.start[t]]
        marked = [np.zeros(b - a, bool) for a, b, _ in lists]
        reached = [0] * len(lists)
        met = np.zeros(self.n_docs, bool)
        found, scores = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        kth, read, depth = max(floor, 1), 0, FIRST_DEPTH
        while True:
            fresh = np.unique(np.concatenate([np.zeros(0, np.int32), *(self.doc[self.ranked[a + read : min(b, a + depth)]] for a, b, _ in lists)]))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            score = np.zeros(len(fresh), np.int64)
            bound = 0
            for i, (a, b, w) in enumerate(lists):
                place = np.searchsorted(self.doc[a:b], fresh)
                place[place == b - a] = 0
                place += a
                held = self.doc[place] == fresh
                place = place[held]
                score[held] += w * self.impact[place]
                marked[i][self.position[place]] = True
                rest = marked[i][reached[i] :]
                step = int(rest.argmin()) if len(rest) else 0
                reached[i] += step if len(rest) and not rest[step] else len(rest)
                if reached[i] < b - a:
                    bound += int(w) * int(self.impact[self.ranked[a + reached[i] - 1]])
            found.append(fresh)
            scores.append(score)
            every = np.concatenate(scores)
            if len(every) >= top:
                kth = max(kth, int(np.partition(every, len(every) - top)[len(every) - top]))
            if bound < kth:
                kept = every >= kth
                return np.concatenate(found)[kept], every[kept], depth
            read, depth = depth, depth * 4


def _first(scores: np.ndarray, docs: list[int | None], top: int) -> list[tuple[int, int | None]]:
    """The ``top`` best of some documents: higher scores, then no id, then smaller ids."""
    listed = sorted(zip(scores.tolist(), docs), key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
    return listed[:top]


def _rank_batches(items: Items, weights: np.ndarray, documents: int, length: int, top: int, shard: int):
    n_terms = len(items.vocabulary)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in items.ids]
        parts: list[pa.RecordBatch] = []
        held = 0

        def search() -> None:
            ids = [x for p in parts for x in p.column("doc_id").to_pylist()]
            n = np.concatenate([p.column("n").to_numpy() for p in parts])
            counts = np.concatenate([p.column("terms").value_lengths().to_numpy() for p in parts])
            terms = np.concatenate([p.column("terms").flatten().to_numpy() for p in parts])
            uses = np.concatenate([p.column("uses").flatten().to_numpy() for p in parts])
            index = Shard(25 + 75 * n * documents // length, np.repeat(np.arange(len(n)), counts), terms, uses, n_terms)
            for q, (wanted, repeats) in enumerate(zip(items.terms, items.repeats)):
                floor = best[q][-1][0] if len(best[q]) == top else 0
                docs, scores, _ = index.best(wanted, weights[wanted] * repeats, top, floor)
                if len(docs):
                    old = np.array([s for s, _ in best[q]], np.int64)
                    best[q] = _first(np.concatenate([old, scores]), [d for _, d in best[q]] + [ids[d] for d in docs], top)

        for batch in batches:
            # A batch may hold more than a shard; a document is never parted.
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy())
            low = 0
            while low < batch.num_rows:
                base = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, base + shard - held, "right")))
                parts.append(batch.slice(low, high - low))
                held += int(ends[high - 1] - base)
                low = high
                if held >= shard or low < batch.num_rows:
                    search()
                    parts, held = [], 0
        if parts:
            search()
        rows = [(q, items.ids[q], doc, score) for q, listed in enumerate(best) for score, doc in listed]
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["query", "item_id", "doc_id", "score"])

    return rank


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """``(item_id, text)`` of the items with text, about ``block_chars`` characters at a time."""
    listed = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL")
    listed = stage(listed.withColumn("row", F.monotonically_increasing_id()), "lexical-items")
    total = listed.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    blocks = -(-total // block_chars) or 1
    dealt = listed.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    for number in range(blocks):
        rows = dealt.where(F.col("block") == number).orderBy("row").collect()
        yield [(r.item_id, r.text.encode()) for r in rows]


def _search_block(docs: DataFrame, items: Items, top: int, shard: int) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    index = stage(narrow.mapInArrow(_posting_batches(items.vocabulary), "doc_id bigint, n bigint, terms array<int>, uses array<bigint>"), "lexical-index")
    documents, length = index.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(items.vocabulary), np.int64)
    # One number for each term of the block comes to the driver.
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toPandas()
    holding[counted.term.to_numpy(np.int64)] = counted.n.to_numpy(np.int64)
    weights = np.array([term_weight(documents, int(n)) for n in holding], np.int64)
    found = index.where(F.size("terms") > 0).mapInArrow(
        _rank_batches(items, weights, documents, length, top, shard), "query int, item_id bigint, doc_id bigint, score bigint"
    )
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    grouped = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    few = grouped.withColumn("place", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS, shard: int = SHARD) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of each row of ``items``.

    Documents score by term weights and impacts, whole numbers throughout; only scores above
    0 are returned, equal scores by rising ``doc_id``, a missing id first. Rows of documents
    that share an id are documents of their own, rows of items that share an id are items of
    their own. NULL and empty texts have no terms: such documents are found by nothing and
    count for nothing, such items find nothing. With no documents or no items there are no
    rows. Other columns are not read.
    """
    found = [_search_block(docs, numbered(rows), top, shard) for rows in item_blocks(items, block_chars)]
    return reduce(DataFrame.unionAll, found)
