"""Whitening of vectors with a covariance from bit planes.

Vectors are put on an integer lattice and each distinct one counts once. Over a
block of them every dimension is shifted by its least value and cut into bit
planes, packed across the rows into 64-bit words. The product of two dimensions,
summed over the rows, is the sum of the AND-popcounts of their planes, weighted
by powers of two: integers, exact whatever the order of summation. They are
centred as integers, and only the quotient is a double.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.storage import durable

STEPS, ORIGIN = 64, 1_000_000
COMPONENTS = 16
#: Rows whose bits share words; a plane is 128 words.
BLOCK_ROWS = 8192
#: Entries beyond this count as this, so that a lattice point is always a long.
FARTHEST = float(1 << 61)
_LONGS = (-(1 << 63), (1 << 63) - 1)

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What a row needs to be whitened; its size is that of the vectors' width, not of the table."""

    n: int
    sums: list[int]
    projector: np.ndarray  # width x components; NaN for a component without variance
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, points: np.ndarray) -> np.ndarray:
        """``n * x - S`` exactly; Python integers where longs could overflow."""
        most = self.n * (int(np.abs(points).max(initial=0)) + 1) + max(map(abs, self.sums))
        if most < _LONGS[1]:
            return self.n * points - np.array(self.sums, np.int64)
        return self.n * points.astype(object) - np.array(self.sums, object)

    def whitened(self, points: np.ndarray) -> np.ndarray:
        return (self.centred(points).astype(np.float64) / self.n) @ self.projector


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    Vectors that are null, empty, or hold a null or non-finite entry are left out.
    Where widths differ, those of the most frequent width take part (of equally
    frequent ones the larger). Narrow vectors have as many components as entries.
    Repeated vectors and ids give a row each and count once in the fit. A component
    without variance (one distinct vector, a constant or dependent dimension) has a
    null ``whitened`` and is no part of ``identity_error``. A ``deviation`` beyond a
    long is null. An empty table gives an empty result; further columns are left
    behind. The driver holds width squared numbers, whatever the number of rows.
    """
    points = durable(vectors.where(_usable(F.col(column))).select(F.col(key).cast("bigint").alias("vec_id"), _lattice(F.col(column)).alias("x")), "lattice")
    widths = points.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("rows"))
    width = widths.orderBy(F.desc("rows"), F.desc("width")).first()
    if width is None:
        return vectors.sparkSession.createDataFrame([], _OUT)
    points = points.where(F.size("x") == width["width"])
    fit_list = durable(points.select("x").distinct(), "fit_list")
    model = fit(fit_list, width["width"], components)
    return points.mapInArrow(lambda batches: _rows(batches, model), _OUT)


def _usable(vector: Column) -> Column:
    entry = lambda e: e.isNotNull() & (F.abs(e.cast("double")) < float("inf"))  # noqa: E731  NaN is above infinity
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, entry), F.lit(False))


def _lattice(vector: Column) -> Column:
    scaled = lambda e: F.greatest(F.least(e.cast("double") * STEPS, F.lit(FARTHEST)), F.lit(-FARTHEST))
    return F.transform(vector, lambda e: F.floor(scaled(e)) + F.lit(ORIGIN))


def matrix(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """The lattice points of a batch as rows."""
    flat = batch.column("x").combine_chunks().flatten() if isinstance(batch, pa.Table) else batch.column("x").flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def fit(fit_list: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of a written table of distinct lattice points, from two passes over it."""
    parts = fit_list.mapInArrow(_scatter, "i int, j int, part decimal(38,0)").groupBy("i", "j").agg(F.sum("part").alias("total")).toArrow()
    total = np.zeros((width + 1, width + 1), object)
    total[parts["i"].to_numpy(), parts["j"].to_numpy()] = [int(v) for v in parts["total"].to_pylist()]
    n, sums = total[width, width], total[:width, width]
    upper = np.triu(total[:width, :width])
    products = upper + np.triu(upper, 1).T
    centred = n * products - np.outer(sums, sums)
    square = n * n
    covariance = np.array([[value / square for value in row] for row in centred.tolist()], np.float64).reshape(width, width)
    trace = int(np.trace(centred)) / square

    values, axes = np.linalg.eigh(covariance)
    best = np.argsort(-values, kind="stable")[:components]
    values, axes = values[best], axes[:, best]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(best))] < 0, -1.0, 1.0)
    real = values > max(values[0], 0.0) * width * np.finfo(float).eps
    projector = np.where(real, axes / np.sqrt(np.where(real, values, 1.0)), np.nan)
    explained = np.where(real, values / (trace or 1.0), 0.0)
    model = Whitening(int(n), [int(s) for s in sums], projector, explained)
    return Whitening(model.n, model.sums, projector, explained, _identity_error(fit_list, model))


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums of products of all pairs of dimensions; the dimension after the last is the constant 1."""
    total = None
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = cross_products(matrix(batch.slice(start, BLOCK_ROWS)))
            total = part if total is None else total + part
    if total is None:
        return
    i, j = np.triu_indices(len(total))
    values = [Decimal(int(v)) for v in total[i, j]]
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["i", "j", "part"])


def cross_products(points: np.ndarray) -> np.ndarray:
    """Sums over the rows of ``x_i * x_j`` as Python integers, with a constant dimension 1 at the end.

    ``points`` are shifted by the least value of each dimension, so that planes are
    few; the shift is taken back by ``(y + m)(y' + m') = yy' + my' + m'y + mm'``.
    """
    rows, width = points.shape
    least = points.min(axis=0)
    shifted = (points - least).view(np.uint64)  # the difference fits, though it may pass the largest long
    bits = [int(v).bit_length() for v in shifted.max(axis=0)]
    dims = np.repeat(np.arange(width), bits)
    shift = np.concatenate([np.arange(b) for b in bits]).astype(np.int64)
    planes = _packed(shifted, dims, shift)

    counts = np.zeros((len(dims), len(dims)), np.int64)
    for p in range(len(dims)):
        counts[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T

    exact = np.int64 if 2 * max(bits, default=0) + rows.bit_length() < 62 else object
    weight = np.array([1 << int(s) for s in shift], exact)
    products, sums = np.zeros((width, width), object), np.zeros(width, object)
    starts = np.flatnonzero(np.diff(dims, prepend=-1))
    if len(starts):
        moving = dims[starts]
        weighted = counts.astype(exact) * weight[:, None] * weight
        products[np.ix_(moving, moving)] = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1)
        sums[moving] = np.add.reduceat(np.diag(counts).astype(exact) * weight, starts)
    low = least.astype(object)
    lift = np.outer(sums, low)
    out = np.zeros((width + 1, width + 1), object)
    out[:width, :width] = products + lift + lift.T + rows * np.outer(low, low)
    out[:width, width] = out[width, :width] = sums + rows * low
    out[width, width] = rows
    return out


def _packed(shifted: np.ndarray, dims: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Bit ``shift[p]`` of dimension ``dims[p]`` of all rows, as 64-bit words: one line for each plane."""
    width = -(-len(shifted) // 64) * 8
    planes = np.zeros((len(dims), width), np.uint8)
    columns = np.ascontiguousarray(shifted.T)
    for p, (dim, bit) in enumerate(zip(dims, shift)):
        packed = np.packbits(((columns[dim] >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8))
        planes[p, : len(packed)] = packed
    return planes.view(np.uint64)


def _identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on its rows."""
    real = np.flatnonzero(~np.isnan(model.projector).any(axis=0))
    if not len(real):
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(real), len(real)))
        for batch in batches:
            if batch.num_rows:
                white = model.whitened(matrix(batch))[:, real]
                total += white.T @ white
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "part"])

    found = fit_list.mapInArrow(moments, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("total"))
    share = F.col("total") / model.n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return float(found.agg(F.max(F.abs(share)).alias("error")).first()["error"])


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    count = model.projector.shape[1]
    for batch in batches:
        if not batch.num_rows:
            continue
        points = matrix(batch)
        white = model.whitened(points).ravel()
        off = model.centred(points)
        far = float(np.abs(off.astype(np.float64)).max(initial=0.0))
        if off.dtype != object and far * far * points.shape[1] < 2.0**62:
            deviation = pa.array((off * off).sum(axis=1), pa.int64())
        else:
            squares = [sum(int(v) ** 2 for v in row) for row in off]
            deviation = pa.array([v if v <= _LONGS[1] else None for v in squares], pa.int64())
        each = np.repeat(np.arange(len(points)), count)
        total = len(each)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1), len(points)), pa.int32()),
                pa.array(np.full(total, model.n), pa.int64()),
                deviation.take(pa.array(each)),
                pa.array(white, pa.float64(), mask=np.isnan(white)),
                pa.array(np.tile(model.explained, len(points))),
                pa.array(np.full(total, model.identity_error)),
            ],
            [field.split()[0] for field in _OUT.split(", ")],
        )
