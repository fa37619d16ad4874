"""Whitened embeddings from exact sums of products over bit planes.

An entry c becomes the whole number x = floor(``SCALE`` * c) + ``SHIFT``.  A task takes blocks of rows.  In a
block each dimension is shifted to start at zero and cut into bit planes, and a plane's bits of all rows are
scattered into 64-bit words.  The product sum of two dimensions is then

    sum over planes a, b of 2^(a + b) * popcount(plane a of the one AND plane b of the other)

which is exact, as is the way back from the shift in whole numbers.  Tasks combine their blocks, a grouping by
pair of dimensions adds up the tasks (decimals of 38 digits), and the driver receives one number for
each pair of dimensions, which is the matrix that has to be decomposed.  It forms n * sum(xy) - sum(x) * sum(y) in
whole numbers, divides once, and calls ``eigh``.

``identity_error`` is measured on the whitened rows themselves: each task centres its rows before it
multiplies, and the centred sums of the tasks are merged.

Nulls and odd rows: a vector that is null, or holds a null or a non-finite entry, is left out; a null id is kept.
Rows with equal ids are rows of their own.  In a shorter vector the missing entries count as c = 0.  A component
without variance has whitened null and explained 0, and no part in ``identity_error`` (null if no component has
any).  An entry for which x is no 62-bit number is an error.  An empty table, or one without a usable vector, gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Whole numbers per unit, what is added to them, components kept.
SCALE, SHIFT, COMPONENTS = 1024.0, 100_000, 8

# Rows whose planes are compared at once.
ROWS = 8192

# Places of the sums in the rows that tasks report: (COUNT, COUNT) holds n, (COUNT, j) the sum of dimension j.
COUNT = -1

SUMS_SCHEMA = "i int, j int, value decimal(38,0)"
MOMENTS_SCHEMA = "i int, j int, n double, mean_i double, mean_j double, together double"
WHITENED_SCHEMA = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double"


def whole_numbers(ids: pa.Array, vectors: pa.Array, width: int = 0) -> tuple[pa.Array, np.ndarray]:
    """Ids and floor(SCALE * c) of the usable rows, filled up with 0 to the widest row, and to ``width`` at least."""
    lengths = np.diff(vectors.offsets.to_numpy())
    # A null vector may still span values, so each row reads its own part.
    first = vectors.offsets.to_numpy()[:-1]
    values = vectors.values
    null = np.zeros(len(values), dtype=bool) if not values.null_count else ~values.is_valid().to_numpy(zero_copy_only=False)
    x = np.floor(SCALE * values.to_numpy(zero_copy_only=False).astype(np.float64))
    odd = np.concatenate([[0], np.cumsum(null | ~np.isfinite(x))])
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (odd[first + lengths] == odd[first])
    kept = np.flatnonzero(usable)
    out = np.zeros((len(kept), max(width, int(lengths[kept].max(initial=0)))), dtype=np.int64)
    inside = np.arange(out.shape[1])[None, :] < lengths[kept][:, None]
    taken = x[(first[kept][:, None] + np.arange(out.shape[1])[None, :])[inside]]
    if np.abs(taken).max(initial=0) >= 1 << 62:
        raise ValueError("an entry is too large for a whole number of 62 bits")
    out[inside] = taken.astype(np.int64)
    return ids.take(pa.array(kept)), out


def planes(z: np.ndarray) -> np.ndarray:
    """(dimensions, bits, words): the bit planes of non-negative numbers, 64 rows to a word."""
    bits = max(1, int(z.max(initial=0)).bit_length())
    padded = np.zeros((-(-len(z) // 64) * 64, z.shape[1]), dtype=np.int64)
    padded[: len(z)] = z
    out = np.empty((z.shape[1], bits, len(padded) // 64), dtype=np.uint64)
    for bit in range(bits):
        packed = np.packbits((padded >> bit & 1).astype(np.uint8), axis=0)
        out[:, bit, :] = np.ascontiguousarray(packed.T).view(np.uint64)
    return out


def _weighted(counts: np.ndarray) -> np.ndarray:
    """Sum over the last axis of counts[b] * 2^b; whole numbers of any length once 64 bits could be too few."""
    bits = counts.shape[-1]
    kind = np.int64 if bits + int(counts.max(initial=0)).bit_length() < 62 else object
    return (counts.astype(kind) * np.array([1 << b for b in range(bits)], dtype=kind)).sum(axis=-1)


def block_sums(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products (upper triangle), of a block as Python's whole numbers."""
    n, d = y.shape
    least = y.min(axis=0)
    sliced = planes(y - least)
    bits = sliced.shape[1]
    shifted = _weighted(np.bitwise_count(sliced).sum(axis=2, dtype=np.int64)).astype(object)
    products = np.zeros((d, d), dtype=object)
    for i in range(d):
        others = sliced[i:].reshape((d - i) * bits, -1)
        of_row = 0
        for bit in range(bits):
            if sliced[i, bit].any():
                both = np.bitwise_count(others & sliced[i, bit]).sum(axis=1, dtype=np.int64)
                of_row = of_row + _weighted(both.reshape(d - i, bits)).astype(object) * (1 << bit)
        products[i, i:] = of_row
    least = least.astype(object)
    back = np.outer(least, shifted) + np.outer(shifted, least) + n * np.outer(least, least)
    return shifted + n * least, products + np.triu(back)


def _grown(array: np.ndarray, d: int) -> np.ndarray:
    out = np.zeros((d,) * array.ndim, dtype=object)
    out[(slice(array.shape[0]),) * array.ndim] = array
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, products = 0, np.zeros(0, dtype=object), np.zeros((0, 0), dtype=object)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, y = whole_numbers(batch.column(0).slice(at, ROWS), batch.column(1).slice(at, ROWS), len(sums))
            if not len(y):
                continue
            if y.shape[1] > len(sums):
                sums, products = _grown(sums, y.shape[1]), _grown(products, y.shape[1])
            n += len(y)
            if y.shape[1]:
                more = block_sums(y)
                sums, products = sums + more[0], products + more[1]
    if n:
        i, j = np.triu_indices(len(sums))
        found = [n, *sums, *products[i, j]]
        places = [COUNT] * (1 + len(sums)), [COUNT, *range(len(sums))]
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([*places[0], *i.tolist()], pa.int32()), "j": pa.array([*places[1], *j.tolist()], pa.int32()),
                "value": pa.array([Decimal(int(v)) for v in found], pa.decimal128(38, 0)),
            }
        )


@dataclass(frozen=True)
class Whitening:
    """Fit of n vectors; ``sums`` are those of floor(SCALE * c), without the shift."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    @property
    def has_variance(self) -> np.ndarray:
        return np.isfinite(self.eigenvalues)

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64 bits if they hold all squares summed up, else Python's whole numbers."""
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if len(self.sums) * most * most < 1 << 62 else object
        return self.n * y.astype(kind) - np.array(self.sums, dtype=kind)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        deviations = (centred / self.n).astype(np.float64)
        return deviations @ self.components / np.sqrt(self.eigenvalues)


def decompose(n: int, sums: list[int], products: dict[tuple[int, int], int], components: int) -> Whitening:
    """Largest components of the covariance (divisor n); those without variance have a NaN as eigenvalue."""
    d = len(sums)
    covariance = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            covariance[i, j] = covariance[j, i] = (n * products[i, j] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = math.fsum(np.diag(covariance))
    order = np.argsort(-values, kind="stable")[:components]
    kept = values[order]
    none = kept <= d * np.finfo(np.float64).eps * trace
    return Whitening(
        n, tuple(sums), np.where(none, np.nan, kept), vectors[:, order], np.where(none, 0.0, kept / (trace or 1.0))
    )


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The fit over all usable rows of (vec_id, embedding); None if there is none."""
    rows = _rows(vectors).mapInArrow(_sums, SUMS_SCHEMA).groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = {(r["i"], r["j"]): int(r["value"]) for r in rows}
    if not found:
        return None
    d = 1 + max(j for _, j in found)
    products = {(i, j): found.get((i, j), 0) for i in range(d) for j in range(i, d)}
    return decompose(found[COUNT, COUNT], [found.get((COUNT, j), 0) for j in range(d)], products, components)


def _moments(whitening: Whitening):
    """Means and centred products of the whitened rows of a task, for components with variance."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.flatnonzero(whitening.has_variance)
        n, mean, together = 0, np.zeros(len(places)), np.zeros((len(places), len(places)))
        for batch in batches:
            _, y = whole_numbers(batch.column(0), batch.column(1), len(whitening.sums))
            if len(y):
                w = whitening.whiten(whitening.centred(y))[:, places]
                own = w.mean(axis=0)
                apart = own - mean
                together += (w - own).T @ (w - own) + np.outer(apart, apart) * (n * len(w) / (n + len(w)))
                mean += apart * (len(w) / (n + len(w)))
                n += len(w)
        if n:
            i, j = (x.ravel() for x in np.indices(together.shape))
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "n": pa.array(np.full(len(i), float(n))),
                    "mean_i": mean[i], "mean_j": mean[j], "together": together[i, j],
                }
            )

    return of_batches


def identity_error(vectors: DataFrame, whitening: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    merged = (
        _rows(vectors).mapInArrow(_moments(whitening), MOMENTS_SCHEMA)
        .groupBy("i", "j")
        .agg(
            F.sum("n").alias("n"), F.sum("together").alias("within"), F.sum(F.col("n") * F.col("mean_i") * F.col("mean_j")).alias("between"),
            F.sum(F.col("n") * F.col("mean_i")).alias("sum_i"), F.sum(F.col("n") * F.col("mean_j")).alias("sum_j"),
        )
    )
    covariance = (F.col("within") + F.col("between") - F.col("sum_i") * F.col("sum_j") / F.col("n")) / F.col("n")
    return merged.agg(F.max(F.abs(covariance - (F.col("i") == F.col("j")).cast("double")))).first()[0]


def _whitened(whitening: Whitening):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(whitening.eigenvalues)
        for batch in batches:
            ids, y = whole_numbers(batch.column(0), batch.column(1), len(whitening.sums))
            if not len(y) or not k:
                continue
            centred = whitening.centred(y)
            w = whitening.whiten(centred).ravel()
            deviation = pa.array([Decimal(int(v)) for v in (centred * centred).sum(axis=1)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": ids.take(each), "component": pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                    "n": pa.array(np.full(len(w), whitening.n), pa.int64()), "deviation": deviation.take(each),
                    "whitened": pa.array(w, mask=np.isnan(w)), "explained": np.tile(whitening.explained, len(y)),
                }
            )

    return of_batches


def _rows(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    ``deviation`` is the sum of (n * x - S)^2 over all dimensions, as a decimal: it passes 64 bits in large tables.
    """
    whitening = fit(vectors, components)
    if whitening is None:
        rows = vectors.sparkSession.createDataFrame([], WHITENED_SCHEMA)
        return rows.withColumn("identity_error", F.lit(None).cast("double"))
    error = identity_error(vectors, whitening)
    rows = _rows(vectors).mapInArrow(_whitened(whitening), WHITENED_SCHEMA)
    return rows.withColumn("identity_error", F.lit(error).cast("double"))
