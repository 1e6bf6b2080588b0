"""Repeated passages: bytes of strings of 50 that also start in a document with a smaller id.

Suffixes are sampled by content, so that equal strings are sampled alike: of the 25 starts
of ``SEED`` bytes inside a string of ``LENGTH`` bytes, the one with the smallest hash stands
for the string. Neighbouring strings with the same seed form a *run*. Whether a string
repeats is settled between the runs that share its seed, and in three steps:

1. Tasks read chunks of documents and send a 32-bit mark for each seed to the seed's bucket,
   which answers with a bit: is the seed in more than one document? With each mark goes how
   many different runs of the seed the chunk has.
2. Runs of such seeds are sent to the bucket with their bytes, once for each chunk. A bucket
   takes its runs in batches, by document id. Each batch becomes an index of its strings,
   is searched in the levels of all earlier batches, and becomes a level itself. Levels of
   equal size merge, so there are never more than the logarithm of the number of batches.
   The bucket answers with a bit for each string.
3. The chunks turn the bits into byte spans.

An index holds the strings of repeated seeds in the order of a 64-bit hash of their 50
bytes, not in that of a suffix array: nothing but equality of 50 bytes is asked.

A phrase amid ever different surroundings makes a run of its own in every document, and all
of them would fill the bucket of its seed. A seed with more than ``CROWDED`` different runs,
counted over all chunks, sends single strings, each to a bucket chosen by the whole string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import stage

LENGTH = 50
SEED = 26
STARTS = LENGTH - SEED + 1
WIDTH = LENGTH + STARTS - 1  # bytes of the longest run
#: Bytes of text in a chunk, and for each bucket; a longer document is a chunk of its own.
CHUNK = 8 << 20
BUCKET = 16 << 20
#: Strings looked at together.
SLICE = 1 << 19
#: Strings of a batch of the index.
BATCH = 1 << 18
#: Different runs, a chunk's copies counted once, beyond which a seed's strings part ways: a 64th of a bucket.
CROWDED = BUCKET // WIDTH // 64
#: Runs of a seed in one chunk that are counted without a look at their bytes.
FEW = 8
NO_ID = np.iinfo(np.int64).max

_B = 0x9E3779B97F4A7C15 | 1
_RANDOM = np.random.default_rng(20240131).integers(0, 1 << 64, 256, np.uint64)
_COLUMN = np.random.default_rng(7).integers(0, 1 << 64, WIDTH + 1, np.uint64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_B, n, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _rolled(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all strings of ``length`` along the last axis, by doubling."""
    done, size, h_size = None, 0, 1
    width = h.shape[-1] - length + 1
    while True:
        if length & h_size:
            # The strings of this size stand before those gathered so far.
            if done is None:
                done, size = h, h_size
            else:
                done = h[..., : done.shape[-1] - h_size] * _power(size) + done[..., h_size:]
                size += h_size
        if size == length:
            return done[..., :width]
        h = h[..., : h.shape[-1] - h_size] * _power(h_size) + h[..., h_size:]
        h_size *= 2


class Runs:
    """The runs of a chunk: first string, number of strings, hash of the seed, document."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray) -> None:
        ends = np.cumsum(lengths)
        self.data = data
        edge = np.zeros(len(data) + 1, np.int8)  # inside a document's last 49 bytes no string starts
        short = np.minimum(lengths, LENGTH - 1)
        np.add.at(edge, ends - short, 1)
        np.add.at(edge, ends, -1)
        valid = np.cumsum(edge[:-1], dtype=np.int8) == 0
        parts = [self._of_slice(valid, low) for low in range(0, max(0, len(data) - LENGTH + 1), SLICE)]
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.first, self.count, self.seed = (np.concatenate(x) for x in zip(*parts)) if parts else empty
        self.doc = np.searchsorted(ends, self.first, "right")

    def _of_slice(self, valid: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = self.data[low : low + SLICE + LENGTH - 1]
        n = len(x) - LENGTH + 1
        seeds = _mixed(_rolled(_RANDOM[x], SEED))
        place = np.uint64((1 << 24) - 1)
        least = (seeds & ~place) | np.arange(len(seeds), dtype=np.uint64)
        size = 1
        while size * 2 <= STARTS:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < STARTS:
            least = np.minimum(least[: len(least) - (STARTS - size)], least[STARTS - size :])
        chosen = (least & place).astype(np.int64)
        ok = valid[low : low + n]
        start = ok & np.concatenate([[True], (chosen[1:] != chosen[:-1]) | ~ok[:-1]])
        first = np.flatnonzero(start)
        # A run ends before the next one or the next place where no string starts.
        stop = np.flatnonzero(np.concatenate([start[1:] | ~ok[1:], [True]]) & ok) + 1
        return first + low, stop - first, seeds[chosen[first]]

    def contents(self, rows: np.ndarray) -> np.ndarray:
        """The bytes of runs, one row each, filled up with zeros."""
        size = self.count[rows] + LENGTH - 1
        at = self.first[rows, None] + np.arange(WIDTH)
        inside = np.arange(WIDTH) < size[:, None]
        return np.where(inside, self.data[np.minimum(at, len(self.data) - 1)], 0).astype(np.uint8)

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each run."""
        code = np.zeros(len(rows), np.uint64)
        for low in range(0, len(rows), 1 << 15):
            part = rows[low : low + (1 << 15)]
            bytes_ = self.contents(part).astype(np.uint64) + np.uint64(1)
            code[low : low + len(part)] = (bytes_ * _COLUMN[:WIDTH]).sum(1) + self.count[part].astype(np.uint64) * _COLUMN[WIDTH]
        return _mixed(code)


def _bucket_mark(seed: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((seed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), seed.astype(np.uint32)


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * (1 + len(kinds)), []
    for kind, size in zip(kinds, np.frombuffer(data, np.int64, len(kinds), 8).tolist()):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _chunk_batches(limit: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int64)
            blob = _packed(np.array(ids, np.int64), lengths, np.frombuffer(b"".join(texts), np.uint8))
            return pa.RecordBatch.from_pydict({"chunk": [(task << 32) + number], "n_bytes": [held], "data": [blob]})

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_py() or b""
                if texts and held + len(data) > limit:
                    yield row()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(NO_ID if doc is None else doc)
                texts.append(data)
                held += len(data)
        if texts:
            yield row()

    return pack


def _read(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(_unpacked(blob, np.int64, np.int64, np.uint8))


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and its rows, in the order they have."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1], [True]])) if len(order) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(bucket[order[a]]), order[a:b]


def _marks(seed: np.ndarray, doc: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, mark) pairs in order, whether two documents of the chunk have them,
    and for each run its pair."""
    bucket, mark = _bucket_mark(seed, buckets)
    pair, run = np.unique(bucket << 32 | mark.astype(np.int64), return_inverse=True)
    low, high = np.full(len(pair), NO_ID), np.full(len(pair), -NO_ID)
    np.minimum.at(low, run, doc)
    np.maximum.at(high, run, doc)
    return pair >> 32, (pair & 0xFFFFFFFF).astype(np.uint32), low < high, run


def _different(runs: Runs, pair_of: np.ndarray, pairs: int) -> np.ndarray:
    """How many different runs each pair has."""
    count = np.bincount(pair_of, minlength=pairs)
    rows = np.flatnonzero(count[pair_of] > FEW)
    pair, code = pair_of[rows], runs.codes(rows)
    order = np.lexsort((code, pair))
    pair, code = pair[order], code[order]
    new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (code[1:] != code[:-1])])[: len(pair)]
    several = np.bincount(pair[new], minlength=pairs)
    return np.where(count > FEW, several, count).astype(np.uint32)


def _mark_batches(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                ids, lengths, data = _read(blob.as_py())
                runs = Runs(data, lengths)
                bucket, mark, several, pair_of = _marks(runs.seed, ids[runs.doc], buckets)
                runs_of = _different(runs, pair_of, len(bucket))
                rows = [(b, chunk, mark[at].tobytes(), np.packbits(several[at]).tobytes(), runs_of[at].tobytes()) for b, at in _by_bucket(bucket)]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "chunk", "marks", "several", "runs"]
                    )

    return emit


def _answer_marks(crowded: int):
    def answer(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(m, np.uint32) for m in table.column("marks").to_pylist()]
        flags = [np.unpackbits(np.frombuffer(s, np.uint8))[: len(m)] for s, m in zip(table.column("several").to_pylist(), lists)]
        marks, run, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = count > 1
        shared[run[np.concatenate(flags) == 1]] = True
        sizes = np.concatenate([np.frombuffer(r, np.uint32) for r in table.column("runs").to_pylist()])
        many = np.bincount(run, weights=sizes, minlength=len(marks)) > crowded
        edges = np.cumsum([0] + [len(m) for m in lists])
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            out.append((np.packbits(shared[run[a:b]]).tobytes(), np.packbits(many[run[a:b]]).tobytes()))
        return pa.table(
            {"chunk": table.column("chunk"), "bucket": table.column("bucket"), "shared": pa.array([o[0] for o in out], pa.binary()), "many": pa.array([o[1] for o in out], pa.binary())}
        )

    return answer


class _Sent:
    """What a chunk sends to the buckets; the same each time it is worked out."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, data: np.ndarray, answers: list[dict], buckets: int) -> None:
        runs = Runs(data, lengths)
        bucket, _, _, pair_of = _marks(runs.seed, ids[runs.doc], buckets)
        shared, many = np.zeros(len(bucket), bool), np.zeros(len(bucket), bool)
        replies = {a["bucket"]: a for a in answers}
        for b, at in _by_bucket(bucket):
            for bits, name in ((shared, "shared"), (many, "many")):
                bits[at] = np.unpackbits(np.frombuffer(replies[b][name], np.uint8))[: len(at)].astype(bool)
        rows = np.flatnonzero(shared[pair_of])
        alone = many[pair_of[rows]]
        first, count, own = runs.first[rows], runs.count[rows], bucket[pair_of[rows]]
        split = np.flatnonzero(alone)
        if len(split):  # each string of a crowded seed goes by itself
            within = np.arange(count[split].sum()) - np.repeat(np.cumsum(count[split]) - count[split], count[split])
            first = np.concatenate([first[~alone], np.repeat(first[split], count[split]) + within])
            own = np.concatenate([own[~alone], np.full(len(within), -1)])
            count = np.concatenate([count[~alone], np.ones(len(within), np.int64)])
        runs.first, runs.count = first, count
        self.first, self.count = first, count
        self.doc = ids[np.searchsorted(np.cumsum(lengths), first, "right")]
        code = runs.codes(np.arange(len(first)))
        self.bucket = np.where(own < 0, (code % np.uint64(buckets)).astype(np.int64), own)
        # One row for runs with equal bytes, with the smallest document that has them.
        _, self.of = np.unique(code, return_inverse=True)
        n = int(self.of.max()) + 1 if len(code) else 0
        self.smallest = np.full(n, NO_ID)
        np.minimum.at(self.smallest, self.of, self.doc)
        self.sample = np.zeros(n, np.int64)
        self.sample[self.of] = np.arange(len(code))
        self.contents = runs.contents


def _sent_batches(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, blob, answers = (batch.column(c)[row].as_py() for c in ("chunk", "data", "answers"))
                sent = _Sent(*_read(blob), answers or [], buckets)
                out = []
                for b, at in _by_bucket(sent.bucket[sent.sample]):
                    runs = sent.sample[at]
                    bytes_ = sent.contents(runs)
                    inside = np.arange(WIDTH) < (sent.count[runs] + LENGTH - 1)[:, None]
                    out.append((b, chunk, _packed(sent.smallest[at], sent.count[runs].astype(np.uint8), bytes_[inside])))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                        ["bucket", "chunk", "runs"],
                    )

    return emit


class Levels:
    """Sorted string hashes with the smallest document of each, in levels of growing size."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def smallest(self, keys: np.ndarray) -> np.ndarray:
        """The smallest document any level knows for each of the sorted ``keys``."""
        found = np.full(len(keys), NO_ID)
        for level_keys, docs in self.levels:
            at = np.minimum(np.searchsorted(level_keys, keys), len(level_keys) - 1)
            found = np.minimum(found, np.where(level_keys[at] == keys, docs[at], NO_ID))
        return found

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        """A new level; while the last two are about equal in size they become one."""
        self.levels.append((keys, docs))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (k2, d2), (k1, d1) = self.levels.pop(), self.levels.pop()
            self.levels.append(smallest_by_key(np.concatenate([k1, k2]), np.concatenate([d1, d2])))


def smallest_by_key(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.minimum.reduceat(docs, first)


def _answer_runs(batch_size: int):
    def answer(table: pa.Table) -> pa.Table:
        docs, counts, texts = zip(*(_unpacked(b, np.int64, np.uint8, np.uint8) for b in table.column("runs").to_pylist()))
        edges = np.cumsum([0] + [len(d) for d in docs])
        doc, count, text = np.concatenate(docs), np.concatenate(counts).astype(np.int64), np.concatenate(texts)
        start = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
        masks = np.zeros(len(doc), np.uint32)
        index = Levels()
        per_batch = max(1, batch_size // (STARTS // 2))
        order = np.argsort(doc, kind="stable")
        for low in range(0, len(order), per_batch):
            rows = order[low : low + per_batch]
            at = np.minimum(start[rows, None] + np.arange(WIDTH), len(text) - 1)
            hashes = _mixed(_rolled(_RANDOM[text[at]], LENGTH))
            inside = np.arange(STARTS) < count[rows, None]
            row, column = np.nonzero(inside)
            keys, own = hashes[row, column], doc[rows][row]
            # The batch's index: its strings in order, and the smallest document of each.
            strings, smallest = smallest_by_key(keys, own)
            known = np.minimum(smallest, index.smallest(strings))
            again = known[np.searchsorted(strings, keys)] < own
            np.bitwise_or.at(masks, rows[row[again]], np.uint32(1) << column[again].astype(np.uint32))
            index.add(strings, smallest)
        return pa.table(
            {"chunk": table.column("chunk"), "bucket": table.column("bucket"), "masks": pa.array([_packed(masks[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary())}
        )

    return answer


def _removed(ids: np.ndarray, lengths: np.ndarray, data: np.ndarray, answers: list[dict], masks: list[dict], buckets: int) -> np.ndarray:
    """A mark for each byte of the chunk that is to go."""
    sent = _Sent(ids, lengths, data, answers, buckets)
    mask = np.zeros(len(sent.sample), np.uint32)
    replies = {m["bucket"]: m["masks"] for m in masks}
    for b, at in _by_bucket(sent.bucket[sent.sample]):
        mask[at] = _unpacked(replies[b], np.uint32)[0]
    # The smallest document of the chunk that has a run follows the answer, the others have it twice.
    every = (np.uint32(1) << sent.count.astype(np.uint32)) - np.uint32(1)
    mask = np.where(sent.doc == sent.smallest[sent.of], mask[sent.of], every)
    edge = np.zeros(len(data) + 1, np.int32)
    for column in range(STARTS):
        starts = sent.first[(mask >> np.uint32(column)) & 1 == 1] + column
        edge += np.bincount(starts, minlength=len(edge)).astype(np.int32)
        edge -= np.bincount(starts + LENGTH, minlength=len(edge)).astype(np.int32)
    return np.cumsum(edge[:-1]) > 0


def _result_batches(buckets: int, texts: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                blob, answers, masks = (batch.column(c)[row].as_py() for c in ("data", "answers", "masks"))
                ids, lengths, data = _read(blob)
                gone = _removed(ids, lengths, data, answers or [], masks or [], buckets)
                out, end = [], 0
                for doc, size in zip(ids.tolist(), lengths.tolist()):
                    begin, end = end, end + size
                    mine = gone[begin:end]
                    kept = data[begin:end][~mine].tobytes()
                    spans = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(size > 0 and mine[0])
                    out.append((None if doc == NO_ID else doc, size, int(mine.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if texts else None))
                columns = list(zip(*out))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)][: 6 if texts else 5],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if texts else 5],
                )

    return emit


def repeated_passages(
    docs: DataFrame, chunk: int = CHUNK, bucket: int = BUCKET, batch: int = BATCH, crowded: int = CROWDED, texts: bool = False
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for each row of ``docs``, and the
    remaining bytes as ``kept`` if ``texts``.

    Strings are judged on the input. NULL text is empty; texts below 50 bytes lose nothing;
    rows that share an id do not take from each other; a row without id loses what any row
    with an id has, and nobody loses to it; an id of 2^63 - 1 counts as none. An empty table gives no rows; other columns are
    not read. ``chunk`` and ``bucket`` bound the memory of a task: some 30 times the larger.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    chunks = stage(narrow.mapInArrow(_chunk_batches(chunk), "chunk bigint, n_bytes bigint, data binary"), "chunks")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = int(total // bucket + 1)
    marks = chunks.mapInArrow(_mark_batches(buckets), "bucket bigint, chunk bigint, marks binary, several binary, runs binary")
    answers = stage(
        marks.groupBy("bucket")
        .applyInArrow(_answer_marks(crowded), "chunk bigint, bucket bigint, shared binary, many binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "shared", "many")).alias("answers")),  # one for each bucket
        "seed-answers",
    )
    asked = chunks.join(answers, "chunk", "left")
    runs = asked.mapInArrow(_sent_batches(buckets), "bucket bigint, chunk bigint, runs binary")
    masks = (
        runs.groupBy("bucket")
        .applyInArrow(_answer_runs(batch), "chunk bigint, bucket bigint, masks binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "masks")).alias("masks"))
    )
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    done = asked.join(masks, "chunk", "left")
    return done.mapInArrow(_result_batches(buckets, texts), schema + (", kept binary" if texts else ""))
