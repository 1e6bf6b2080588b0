"""Embedding whitening: covariance over distinct vectors weighted by multiplicity.

Entries become whole numbers, so equal vectors are exactly equal and are grouped. Each
distinct vector is held once, with its number of copies; a fit takes copies or one as its
weight. Tasks centre their vectors, multiply them (one weighted GEMM for each batch) and hand
on only sums. The eigenvectors of the covariance are found on the driver, every distinct
vector is whitened once, and the rows get the result by a join on the vector.

Vectors of each length are a space of their own. What comes to the driver is one square
matrix for each length, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtally.session import stage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Whole numbers end here, which is reached by entries of 17 thousand million.
LARGEST = 2**40
MAX_LONG = 2**63 - 1


def whole(embedding: Column) -> Column:
    """``floor(64 * entry) + 1000000`` of each entry, as whole numbers up to ``LARGEST``.

    Sums stay exact as long as the number of vectors times the largest entry fits 64 bits.
    """
    return F.transform(
        embedding, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("bigint") + F.lit(SHIFT)
    )


def sound(embedding: Column) -> Column:
    """True for a vector without NULL, NaN or infinite entries; an empty one has nothing to whiten."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(finite, F.lit(False))


@dataclass(frozen=True)
class Space:
    """The whitening of vectors of one length; ``axes`` are the scaled eigenvectors."""

    n: int
    total: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    eigenvalues: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``; the difference is taken in whole numbers, so nothing cancels."""
        return (x * self.n - self.total) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of ``(n * x - S) ** 2``; NULL where no 64-bit number holds one."""
        off = x * self.n - self.total
        large = (off.astype(float) ** 2).sum(1) > MAX_LONG * (1 - 1e-9)
        return pa.array(np.where(large, 0, (np.where(large[:, None], 0, off) ** 2).sum(1)), pa.int64(), mask=large)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, vectors, rows)`` for each length of vector in a batch."""
    lengths = batch.column("x").value_lengths().to_numpy()
    values, ends = batch.column("x").flatten().to_numpy(), np.cumsum(lengths)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield int(length), values[(ends[rows] - length)[:, None] + np.arange(length)], rows


MOMENTS = "dim int, i int, j int, value double"


def _moment_batches(points: Callable[[int, np.ndarray], np.ndarray | None], weigh: bool):
    """Sums over a task of ``z`` (at ``i`` -1) and of the products of its entries, by vector length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            copies = batch.column("copies").to_numpy().astype(float)
            for dim, x, rows in _vectors(batch):
                z = points(dim, x)
                if z is None:
                    continue
                weighted = z * copies[rows, None] if weigh else z
                sums[dim] = sums.get(dim, 0) + weighted.sum(0)
                products[dim] = products.get(dim, 0) + z.T @ weighted
        for dim, product in products.items():
            table = np.vstack([sums[dim], product])
            i, j = np.indices(table.shape)
            for low in range(0, table.size, 1 << 16):
                at = slice(low, low + (1 << 16))
                columns = [np.full(table.size, dim)[at], i.ravel()[at] - 1, j.ravel()[at], table.ravel()[at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["dim", "i", "j", "value"])

    return add


def _moments(distinct: DataFrame, points: Callable[[int, np.ndarray], np.ndarray | None], weigh: bool) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: the summed points and their summed products."""
    rows = distinct.select("x", "copies").mapInArrow(_moment_batches(points, weigh), MOMENTS)
    listed = rows.groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).toPandas()
    found = {}
    for dim, part in listed.groupby("dim"):
        table = np.zeros((part.i.max() + 2, part.j.max() + 1))
        table[part.i + 1, part.j] = part.value
        found[int(dim)] = (table[0], table[1:])
    return found


def group(rows: DataFrame) -> DataFrame:
    """``(x, copies)``: each distinct vector once, as a table."""
    return stage(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "whitening-vectors")


def fit(distinct: DataFrame, weigh: bool = False, components: int = COMPONENTS) -> dict[int, Space]:
    """The whitening of each vector length, from ``(x, copies)``.

    A vector weighs its copies, or one each without ``weigh``. Components come by falling
    eigenvalue; those without variance cannot be whitened and are left out.
    """
    weight = F.col("copies") if weigh else F.lit(1)
    sums = distinct.select(F.size("x").alias("dim"), weight.cast("bigint").alias("w"), F.posexplode("x").alias("i", "v"))
    totals: dict[int, tuple[int, np.ndarray]] = {}
    listed = sums.groupBy("dim", "i").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("v")).alias("s")).toPandas()
    for dim, part in listed.groupby("dim"):
        total = np.zeros(dim, np.int64)
        total[part.i] = part.s
        totals[int(dim)] = int(part.n.iloc[0]), total
    centre = _centring(totals)
    spaces = {}
    for dim, (_, products) in _moments(distinct, centre, weigh).items():
        n, total = totals[dim]
        covariance = (products + products.T) / (2 * n)
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1], vectors[:, ::-1]
        # Either sign is right; the largest entry of each is made positive.
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(dim)])
        kept = (values > values[0] * dim * np.finfo(float).eps) & (np.arange(dim) < components) & (values > 0)
        spaces[dim] = Space(n, total, vectors[:, kept] / np.sqrt(values[kept]), values[kept] / np.trace(covariance), values[kept])
    return spaces


def _centring(totals: dict[int, tuple[int, np.ndarray]]):
    def centred(dim: int, x: np.ndarray) -> np.ndarray:
        n, total = totals[dim]
        return (x * n - total) / n

    return centred


def identity_errors(distinct: DataFrame, spaces: dict[int, Space], weigh: bool = False) -> dict[int, float]:
    """How far the covariance of the whitened vectors is from the identity, measured on all."""

    def whitened(dim: int, x: np.ndarray) -> np.ndarray | None:
        space = spaces.get(dim)
        return space.whitened(x) if space is not None and space.axes.shape[1] else None

    errors = {}
    for dim, (total, products) in _moments(distinct, whitened, weigh).items():
        n = spaces[dim].n
        covariance = products / n - np.outer(total / n, total / n)
        errors[dim] = float(np.abs(covariance - np.eye(len(covariance))).max())
    return errors


def _whiten_batches(spaces: dict[int, Space], errors: dict[int, float]):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, x, rows in _vectors(batch):
                space = spaces.get(dim)
                if space is None or not space.axes.shape[1]:
                    continue
                z = space.whitened(x)
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("x").take(pa.array(rows)), pa.array(np.full(len(rows), space.n)), space.deviations(x),
                        pa.ListArray.from_arrays(ends, pa.array(z.ravel())),
                        pa.ListArray.from_arrays(ends, pa.array(np.tile(space.explained, len(rows)))),
                        pa.array(np.full(len(rows), errors[dim])),
                    ],
                    ["x", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whiten


WHITENED = "x array<bigint>, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"


def whiten(embeddings: DataFrame, weigh: bool = False, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each
    sound vector and component.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries go. Rows that share an
    id, or have none, are rows of their own; other columns are not read. Vectors of each length
    are whitened among themselves. Where all vectors are equal, as where there are none, no
    component has variance and there are no rows.
    """
    # A vector that very many rows share is one row of the right side; the adaptive skew join
    # splits the left side.
    rows = embeddings.where(sound(F.col("embedding"))).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole(F.col("embedding")).alias("x"))
    distinct = group(rows)
    spaces = fit(distinct, weigh, components)
    errors = identity_errors(distinct, spaces, weigh)
    once = stage(distinct.select("x").mapInArrow(_whiten_batches(spaces, errors), WHITENED), "whitening-whitened")
    joined = rows.join(once, "x").select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "z"))
    return joined.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "z.whitened", "z.explained", "identity_error"
    )
