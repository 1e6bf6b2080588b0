"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the n-grams (3 to 5 bytes of the lower-cased text, runs of white
space and ASCII punctuation read as one blank) that occur in it at least once. Each is
multiplied with the log ratio of its share among toxic and other texts (smoothed by one),
and a regularised logistic regression is fitted on the products.

The classifier is fitted on a bounded sample: ``per_class`` labelled documents of each
class, the first in order of their hashed id. Everything else is Spark work over all
documents, and a fitted model is two arrays of at most ``n_features`` entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.llm.common import held_out, spread_key
from flowtally.session import stage

ORDERS = (3, 4, 5)
BUCKETS = 1 << 22
THRESHOLD = 0.3
#: Bounds of the fit: labelled documents of each class, and features kept.
PER_CLASS = 4_000
N_FEATURES = 8_192
#: A feature counts if this many sampled texts of a class have it.
MIN_TEXTS = 3
#: Bytes looked at together; a longer text is read in overlapping parts.
PART = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x30] = _FOLD[0x3A:0x41] = _FOLD[0x5B:0x61] = _FOLD[0x7B:0x80] = 0x20
_FOLD[0x41:0x5B] += 0x20


@dataclass(frozen=True)
class Model:
    """``weights`` holds the ratio times the coefficient of each of ``buckets`` (sorted)."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def features(text: bytes | None, among: np.ndarray | None = None) -> np.ndarray:
    """The distinct hashed n-grams of a text, sorted; none for NULL.

    ``among``, a mark for each bucket, leaves the others out early.
    """
    parts = []
    data = b" " + (text or b"") + b" "
    for low in range(0, len(data), PART):
        x = _FOLD[np.frombuffer(data, np.uint8)[low : low + PART + max(ORDERS)]]
        blank = x == 0x20
        x = x[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint64)
        h = np.full(len(x), 1, np.uint64)
        for n in range(1, min(max(ORDERS), len(x)) + 1):
            h = (h[: len(x) - n + 1] + x[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if n in ORDERS:
                found = ((h >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int32)
                parts.append(found if among is None else found[among[found]])
    found = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int32)
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def _chosen(wanted: np.ndarray):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = np.zeros(BUCKETS, bool)
        among[wanted] = True
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text")):
                found = np.searchsorted(wanted, features(text.as_py(), among)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"toxic": pa.array([label], pa.int32()), "found": pa.array([found.tobytes()])})

    return emit


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a feature, summed over the task before they leave it."""
    counts = np.zeros((2, BUCKETS), np.int32)
    for batch in batches:
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text")):
            counts[label, features(text.as_py())] += 1
    seen = np.flatnonzero(counts.any(0))
    for low in range(0, len(seen), 1 << 16):
        part = seen[low : low + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(counts[1, part].astype(np.int64)), pa.array(counts[0, part].astype(np.int64))],
            ["bucket", "toxic_texts", "other_texts"],
        )


def training_labels(labels: DataFrame) -> DataFrame:
    """``(id, toxic)`` of all documents to learn from, one row each.

    Held-out documents and rows without id or label never get in. Of repeated labels of a
    document the larger counts.
    """
    return (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )


def sample(docs: DataFrame, known: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``(text, toxic)`` of at most ``per_class`` documents of each class in ``known``.

    Rows that repeat an id and its text are one document. An id with several texts gives as
    many documents, which count towards the bound like others.
    """
    # Two lists of at most per_class rows.
    firsts = [known.where(F.col("toxic") == c).orderBy(spread_key(F.col("id"))).limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(firsts[0].union(firsts[1]))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("binary").alias("text"))
    # Stored, because the bound is found from the marks of the texts before any text moves.
    rows = stage(texts.join(chosen, "id").withColumn("mark", F.xxhash64("text")), "toxicity-rows")
    marks = rows.select("toxic", "id", "mark").distinct()
    kept = [marks.where(F.col("toxic") == c).orderBy(spread_key(F.col("id")), "mark").limit(per_class) for c in (0, 1)]
    return (
        rows.join(F.broadcast(kept[0].union(kept[1])), ["toxic", "id", "mark"])
        .groupBy("toxic", "id", "mark")
        .agg(F.first("text").alias("text"))
        .select("text", "toxic")
    )


def _logistic(
    rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, toxic_share: float, l2: float = 1e-4, steps: int = 200
) -> tuple[np.ndarray, float]:
    """Coefficients of scaled presence features and the bias, by accelerated gradient steps.

    Classes weigh as they do among all labelled documents. A coefficient's step comes from
    a bound of its own curvature, so that rare features move as fast as common ones.
    """
    share = np.where(y == 1, toxic_share / (y == 1).sum(), (1 - toxic_share) / (y == 0).sum())
    # Texts are taken a few at a time, so that nothing but their features is held at once.
    parts, low = [], 0
    while low < len(rows):
        high, size = low + 1, len(rows[low])
        while high < len(rows) and size + len(rows[high]) <= PART:
            size, high = size + len(rows[high]), high + 1
        parts.append((low, high))
        low = high

    def entries() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for low, high in parts:
            row = np.repeat(np.arange(high - low, dtype=np.int32), [len(r) for r in rows[low:high]])
            yield slice(low, high), np.concatenate(rows[low:high]), row

    curve, bias_curve = np.zeros(len(scale)), 0.0
    for at, column, row in entries():
        value = np.abs(scale[column])
        reach = share[at] * (np.bincount(row, value, at.stop - at.start) + 1)
        curve += np.bincount(column, value * reach[row], len(scale))
        bias_curve += reach.sum()
    rate, bias_rate = 1 / (0.25 * curve + l2), 1 / (0.25 * bias_curve)
    w, b = np.zeros(len(scale)), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        slope_w, slope_b = l2 * ahead_w, 0.0
        for at, column, row in entries():
            z = np.bincount(row, (scale * ahead_w)[column], at.stop - at.start) + ahead_b
            slope = share[at] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at])
            slope_w = slope_w + np.bincount(column, slope[row], len(scale)) * scale
            slope_b += slope.sum()
        new_w, new_b = ahead_w - rate * slope_w, ahead_b - bias_rate * slope_b
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead_w, ahead_b = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, n_features: int = N_FEATURES) -> Model:
    """Fit on :func:`sample`. With one class only, or none, the model knows the share alone."""
    known = training_labels(labels)
    total, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    chosen = stage(sample(docs, known, per_class), "toxicity-sample")
    sizes = {row.toxic: row.n for row in chosen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.zeros(0, np.int32), np.zeros(0), 4.0 if 1 in sizes else -4.0)
    counts = chosen.mapInArrow(_count_batches, "bucket int, toxic_texts bigint, other_texts bigint")
    counts = counts.groupBy("bucket").agg(F.sum("toxic_texts").alias("p"), F.sum("other_texts").alias("q"))
    share = F.log((F.col("p") + 1) / (sizes[1] + 2)) - F.log((F.col("q") + 1) / (sizes[0] + 2))
    # How unlikely the difference of the shares is by chance, in standard deviations.
    pooled = (F.col("p") + F.col("q") + 1) / (sizes[0] + sizes[1] + 2)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]) + 1e-9)
    strength = F.abs(F.col("p") / sizes[1] - F.col("q") / sizes[0]) / spread
    best = (
        counts.where(F.greatest("p", "q") >= MIN_TEXTS)
        .select("bucket", share.alias("ratio"), strength.alias("strength"))
        .orderBy(F.desc("strength"), "bucket")
        .limit(n_features)
        .toPandas()
        .sort_values("bucket")
    )
    buckets, ratio = best.bucket.to_numpy(np.int32), best.ratio.to_numpy(float)
    rows = chosen.mapInArrow(_chosen(buckets), "toxic int, found binary").collect()
    y = np.array([row.toxic for row in rows])
    w, bias = _logistic([np.frombuffer(row.found, np.int32) for row in rows], y, ratio, toxic / total)
    return Model(buckets, w * ratio, bias)


def _score(texts: pa.Array, model: Model, weight: np.ndarray) -> np.ndarray:
    among = weight != 0
    z = [float(weight[features(text.as_py(), among)].sum()) for text in texts]
    return 1 / (1 + np.exp(-np.clip(np.array(z, float) + model.bias, -30, 30)))


def _spread(model: Model) -> np.ndarray:
    weight = np.zeros(BUCKETS)
    weight[model.buckets] = model.weights
    return weight


def _score_batches(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _spread(model)
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "text"]
            p = pa.array(_score(batch.column("text"), model, weight))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), p], [*kept, "score"])

    return score


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score)`` of every row; an empty text scores by the bias alone.

    Only the text makes the score. NULL reads as empty; repeated rows are scored each; an
    empty table gives no rows; other columns are not read.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    return narrow.mapInArrow(_score_batches(model), "doc_id bigint, held_out boolean, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = _spread(model)
        for batch in batches:
            p = _score(batch.column("text").cast(pa.binary()), model, weight)
            yield batch.filter(pa.array(p < threshold))

    return docs.mapInArrow(keep, schema)
