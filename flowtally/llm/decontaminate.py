"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

Words are numbered by the benchmark's vocabulary; all other words share one number. A task
gathers documents into shards of about ``SHARD`` words, indexes each, searches all windows
of the benchmark backwards at once, locates the hits and merges them into spans of words.
A document longer than a shard is indexed in parts that overlap by a window less a word.

The benchmark is read in blocks of at most ``BLOCK_CHARS`` characters of items (one item
may be longer), each searched in all documents, so that what a task and the driver hold
stays bounded however long the benchmark is. All blocks are searched in the texts as they
came; what they find is put together by row before anything is counted or cut.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.fmindex import FMIndex
from flowtally.session import stage

WINDOW = 10
SHARD = 1 << 19
BLOCK_CHARS = 16 << 20

# Words are runs of digits, letters a to z and everything beyond ASCII, once A to Z are lower.
_FOLD = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

END, OTHER = 1, 2  # numbers of the end of a piece and of words no item has


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


@dataclass
class Phrases:
    """Windows of items by length, and the items that have each."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]

    @property
    def bits(self) -> int:
        return max(2, (len(self.vocabulary) + OTHER).bit_length())

    @property
    def longest(self) -> int:
        return max(self.by_length, default=1)


def phrases(items: Iterable[tuple[str, str | None]], window: int = WINDOW) -> Phrases:
    """The distinct windows of ``(item_id, text)``: ``window`` words, or a whole shorter item."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + OTHER + 1) for w in words(text.encode() if text else None)]
        width = min(window, len(numbers))
        for i in range(len(numbers) - width + 1 if numbers else 0):
            owners[tuple(numbers[i : i + width])].add(item)
    by_length: dict[int, list] = defaultdict(list)
    for numbers in owners:
        by_length[len(numbers)].append(numbers)
    return Phrases(
        vocabulary,
        {n: np.array(rows, np.int64) for n, rows in by_length.items()},
        {n: [sorted(owners[r]) for r in rows] for n, rows in by_length.items()},
    )


def find(shard: np.ndarray, wanted: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, window, position)``: where the windows of each length occur in a shard."""
    index = FMIndex(shard, wanted.bits)
    for length, patterns in wanted.by_length.items():
        low, high = index.search(patterns)
        counts = high - low
        window = np.repeat(np.arange(len(patterns)), counts)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        yield length, window, index.locate(rows)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans ``[start, end)`` that overlap or touch, made one; sorted."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.concatenate([first[1:], [True]])]


def _scan_batches(wanted: Phrases):
    get = wanted.vocabulary.get

    def hits(pieces: list[tuple[int, int, np.ndarray]], rows: dict[int, list]) -> None:
        """Search pieces ``(row, first word, numbers)`` as one shard."""
        firsts = np.cumsum([0] + [len(p[2]) + 1 for p in pieces])
        shard = np.concatenate([x for p in pieces for x in (p[2], [END])])
        for length, window, position in find(shard, wanted):
            piece = np.searchsorted(firsts, position, "right") - 1
            for k in np.unique(piece):
                row, offset, _ = pieces[k]
                here = piece == k
                start = position[here] - firsts[k] + offset
                rows[row].append((start, start + length, {i for w in np.unique(window[here]) for i in wanted.items[length][w]}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[int, list] = defaultdict(list)
            totals = np.zeros(batch.num_rows, np.int64)
            pieces: list[tuple[int, int, np.ndarray]] = []
            held = 0
            for i, text in enumerate(batch.column("text")):
                listed = words(text.as_py())
                totals[i] = len(listed)
                numbers = np.fromiter((get(w, OTHER) for w in listed), np.int64, len(listed))
                del listed
                for low in range(0, max(1, len(numbers) - wanted.longest + 1), SHARD):
                    piece = numbers[low : low + SHARD + wanted.longest - 1]
                    if len(piece):
                        pieces.append((i, low, piece))
                        held += len(piece)
                    if held >= SHARD:
                        hits(pieces, rows)
                        pieces, held = [], 0
            if pieces:
                hits(pieces, rows)
            spans, items = [], []
            for i in range(batch.num_rows):
                found = rows.get(i, [])
                empty = [np.zeros(0, np.int64)]
                starts, ends = merged_spans(np.concatenate([f[0] for f in found] or empty), np.concatenate([f[1] for f in found] or empty))
                spans.append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
                items.append(sorted(set().union(*[f[2] for f in found])))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(totals), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
                [*kept, "n_words", "spans", "items"],
            )

    return scan


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[str, str | None]]]:
    """The items with words, a bounded block at a time. Rows without id get the id ``null``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where("text IS NOT NULL").distinct()
    size = F.length("text").cast("bigint")
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = -(-total // (block_chars // 2)) or 1
    if blocks == 1:
        yield [(row.item, row.text) for row in items.collect()]
        return
    # Sorted by block, so that reading one opens few of the stored rows.
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    dealt = stage(dealt.repartitionByRange("block").sortWithinPartitions("block"), "benchmark")
    for number in range(blocks):
        yield [(row.item, row.text) for row in dealt.where(F.col("block") == number).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` for each row of ``docs``.

    ``spans`` are the merged runs ``[start, end)`` of words inside an occurrence of a window,
    ``items`` the sorted ids of items with a window that occurs. NULL and empty texts have no
    words and no hits, in documents as in items; repeated rows are answered each; empty
    tables give no rows, or rows without hits. Other columns are not read. Into how many
    blocks the benchmark falls makes no difference to the result.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    blocks = benchmark_blocks(benchmark, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return narrow.mapInArrow(_scan_batches(phrases(first, window)), f"doc_id bigint, {FOUND}")
    rows = stage(narrow.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    return _found_by_row(rows, chain([first, second], blocks), window).drop("row")


def _found_by_row(rows: DataFrame, blocks: Iterable[list[tuple[str, str | None]]], window: int) -> DataFrame:
    """``(row, doc_id, n_words, spans, items)`` of stored ``(row, doc_id, text)``: every block is
    searched in the unchanged texts, one after another, and what is found is joined by row."""
    narrow = rows.select("row", "doc_id", F.col("text").cast("binary").alias("text"))
    parts = []
    for number, block in enumerate(blocks):
        found = narrow.mapInArrow(_scan_batches(phrases(block, window)), f"row bigint, doc_id bigint, {FOUND}")
        # The first block tells the words of every row; of the others only hits are kept.
        parts.append(stage(found if number == 0 else found.where(F.size("spans") > 0), "decontaminate-hits"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("s"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .select("row", "doc_id", "n_words", F.expr(MERGE).alias("spans"), "items")
    )


MERGE = """
aggregate(
  array_sort(s), cast(array() AS array<struct<start: bigint, end: bigint>>),
  (done, x) -> CASE
    WHEN size(done) > 0 AND x.start <= element_at(done, -1).end
    THEN array_append(slice(done, 1, size(done) - 1), struct(element_at(done, -1).start AS start, greatest(element_at(done, -1).end, x.end) AS end))
    ELSE array_append(done, x) END)"""


def report(found: DataFrame) -> DataFrame:
    """Counts of words, hit words and items, and a checksum of the items."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the blanks between them."""
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    kept, last = [], 0
    for a, b in spans:
        kept.append(data[last : places[a][0]])
        last = places[b - 1][1]
    return b"".join([*kept, data[last:]]).decode()


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with benchmark passages cut out of ``text`` and ``n_chars`` set anew.

    A document of which no word is left goes; every other one stays, clean ones unchanged.
    What is cut is judged on the text as it came, whatever the blocks of the benchmark. Of
    columns whose names clash with those used inside, none is touched.
    """
    blocks = benchmark_blocks(benchmark, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.mapInArrow(_cut_batches(phrases(first, window)), docs.schema)
    every = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("document")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), every), "decontaminate-rows")
    texts = rows.select("row", F.lit(None).cast("bigint").alias("doc_id"), "document.text")
    hits = _found_by_row(texts, chain([first, second], blocks), window).where(F.size("spans") > 0).select("row", "spans")
    joined = rows.join(hits, "row", "left").select("document.*", F.col("spans").alias(_SPANS_OF_ROW))
    return joined.mapInArrow(_cut_found_batches, docs.schema)


#: Column that carries the spans of a row to where they are cut.
_SPANS_OF_ROW = "_decontaminate_spans"


def _cut_batch(batch: pa.RecordBatch, spans: list[list[dict] | None]) -> pa.RecordBatch:
    if not any(spans):
        return batch
    texts = batch.column("text").to_pylist()
    for i, listed in enumerate(spans):
        if listed:
            texts[i] = cut_words(texts[i], [(s["start"], s["end"]) for s in listed])
    kept = [not listed or bool(words(texts[i].encode())) for i, listed in enumerate(spans)]
    columns = []
    for field, column in zip(batch.schema, batch.columns):
        if field.name == "text":
            column = pa.array(texts, field.type)
        elif field.name == "n_chars":
            old = column.to_pylist()
            column = pa.array([len(texts[i]) if spans[i] else old[i] for i in range(len(old))], field.type)
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(kept))


def _cut_found_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(_SPANS_OF_ROW).to_pylist()
        yield _cut_batch(batch.drop_columns([_SPANS_OF_ROW]), spans)


def _cut_batches(wanted: Phrases):
    scan = _scan_batches(wanted)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pa.RecordBatch.from_arrays([batch.column("text").cast(pa.binary())], ["text"])
            yield _cut_batch(batch, next(scan(iter([data]))).column("spans").to_pylist())

    return cut
