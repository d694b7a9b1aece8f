"""Whitening of embeddings by their leading principal components.

A vector's entries become whole numbers, ``x = floor(256 c)``, and each distinct x-vector counts once. Over those, Spark sums the entries
exactly, then the outer products of the centred vectors: one d x d matrix leaves a task, whatever its rows, and the sums
of all tasks are added by Spark. Only the d x d covariance comes to the driver. There it is made tridiagonal by Householder
reflections, its leading eigenvalues are found by bisection on Sturm counts and their vectors by inverse iteration, with vectors of
close eigenvalues made orthogonal. The components go back to tasks, which project their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.session import persist_reliably

SCALE = 256
COMPONENTS = 4
_CLUSTER = 1e-3  # eigenvalues closer than this share of the matrix' norm have their vectors made orthogonal
_EPS = np.finfo(float).eps


# ---- whole-number vectors ----------------------------------------------------------------------------


def _whole(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their x-vectors as a matrix) for every length of the usable vectors of a list column."""
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.drop_null()
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)  # null entries are NaN
    ends = np.cumsum(size)
    for dim in np.unique(size):
        of = np.flatnonzero(size == dim)
        if dim == 0:
            continue
        x = flat[(ends[of] - dim)[:, None] + np.arange(dim)]
        with np.errstate(over="ignore"):
            x = np.floor(scale * x)
        fits = (np.abs(x) < 2.0**62).all(axis=1)  # false for NaN and infinities too
        yield rows[of[fits]], x[fits].astype(np.int64)


def _packed(scale: int):
    """The x-vectors as bytes, two for an entry where that is enough for the vector."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _whole(batch.column(0), scale):
                small = (np.abs(x) < 1 << 15).all(axis=1)
                packed = [*map(np.ndarray.tobytes, x[small].astype(np.int16)), *map(np.ndarray.tobytes, x[~small])]
                yield pa.record_batch([np.full(len(x), x.shape[1], np.int32), pa.array(packed, pa.binary())], names=["dim", "x"])

    return over, "dim int, x binary"


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    out = np.empty((len(size), dim), np.int64)
    for width, kind in ((2, np.int16), (8, np.int64)):
        of = size == width * dim
        if of.any():
            out[of] = np.frombuffer(b"".join(column.filter(pa.array(of)).to_pylist()), kind).reshape(-1, dim)
    return out


# ---- sums over the distinct vectors ----------------------------------------------------------------------


def _sums(dim: int):
    """Per task the number of vectors, and of every entry the sum in two halves that cannot overflow."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = _unpacked(batch.column(0), dim)
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        if n:
            yield pa.record_batch([np.arange(dim, dtype=np.int32), np.full(dim, n), low, high], names=["i", "n", "low", "high"])

    return over, "i int, n long, low long, high long"


def _products(dim: int, values, width: int):
    """Per task the sum of the outer products of ``values(x)``, row by row."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            v = values(_unpacked(batch.column(0), dim))
            total += v.T @ v
            some = True
        if some:
            yield pa.record_batch([np.arange(width, dtype=np.int32), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    return over, "i int, row array<double>"


def _added(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of all tasks' matrices; width x width numbers come to the driver."""
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    return (out + out.T) / 2


# ---- eigenvectors --------------------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and the unit vectors of the Householder reflections that lead there."""
    a, n = matrix.copy(), len(matrix)
    mirrors = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        v[0] += np.copysign(norm, v[0])
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            p = a[k + 1 :, k + 1 :] @ v
            w = 2 * (p - (v @ p) * v)
            a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def _below(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each of ``at``."""
    tiny = np.finfo(float).tiny / _EPS
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    square = np.append(0.0, side**2)
    for d, e in zip(diagonal, square, strict=True):
        q = d - at - e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bit."""
    n = len(diagonal)
    reach = np.append(np.abs(side), 0) + np.append(0, np.abs(side))
    pad = 4 * _EPS * max(np.abs(diagonal).max(), reach.max(), np.finfo(float).tiny)
    low, high = np.full(k, (diagonal - reach).min() - pad), np.full(k, (diagonal + reach).max() + pad)
    rank = n - 1 - np.arange(k)  # so many eigenvalues lie below the wanted one
    for _ in range(1100):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        over = _below(diagonal, side, middle) > rank
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    return high


def _solve(diagonal: np.ndarray, side: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """Solves (T - shift) y = b by elimination with row exchanges."""
    n = len(diagonal)
    d, up, up2, y = diagonal - shift, np.append(side, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        pivot, below = d[i], side[i]
        if abs(below) > abs(pivot):
            factor = pivot / below
            d[i], up[i], up2[i], d[i + 1], up[i + 1] = below, d[i + 1], up[i + 1], up[i] - factor * d[i + 1], -factor * up[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(pivot) < tiny:
                d[i] = pivot = tiny
            factor = below / pivot
            d[i + 1] -= factor * up[i]
            y[i + 1] -= factor * y[i]
    if abs(d[-1]) < tiny:
        d[-1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= up[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= up2[i] * y[i + 2]
        y[i] /= d[i]
        if abs(y[i]) > 1e150:  # only the direction counts
            y /= abs(y[i])
    return y / np.linalg.norm(y)


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector for every eigenvalue (falling) by inverse iteration; those of a cluster are orthogonal."""
    norm = np.abs(diagonal).max() + 2 * np.abs(side).max(initial=0)
    out = np.empty((len(values), len(diagonal)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLUSTER * norm:
            first = j
        shift = value - (j - first) * 8 * _EPS * norm  # equal eigenvalues get shifts that differ
        y = np.random.default_rng(j).standard_normal(len(diagonal))
        for _ in range(8):
            for _ in range(2):
                y -= out[first:j].T @ (out[first:j] @ y)
            y = _solve(diagonal, side, shift, y, _EPS * norm)
        for _ in range(2):
            y -= out[first:j].T @ (out[first:j] @ y)
            y /= np.linalg.norm(y)
        out[j] = y
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors; a vector's largest entry is positive."""
    size = np.abs(matrix).max(initial=0)
    k = min(k, len(matrix))
    if not size:
        return np.zeros(k), np.eye(len(matrix))[:k]
    diagonal, side, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, side, k)
    vectors = leading_vectors(diagonal, side, values)
    for at, v in reversed(list(enumerate(mirrors))):
        part = vectors[:, at + 1 :]
        part -= 2 * np.outer(part @ v, v)
    largest = vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]
    return values * size, vectors * np.sign(largest)[:, None]


# ---- the operator --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What is learned: the number of distinct x-vectors, the sums of their entries, and the components with variance."""

    scale: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, with the whole part taken off before any rounding."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The sum of (n x - S)^2 in whole numbers; null where it does not fit a long."""
        rough = ((self.n * self.centred(x)) ** 2).sum(axis=1)
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        small = rough < 2.0**62
        exact = ((self.n * (x[small] - whole) - rest) ** 2).sum(axis=1)
        out = np.zeros(len(x), np.int64)
        out[small] = exact
        fits = small.copy()
        for row in np.flatnonzero(~small & (rough < 2.0**64)):
            value = sum((self.n * a - s) ** 2 for a, s in zip(x[row].tolist(), self.sums, strict=True))
            if value < 1 << 63:
                out[row], fits[row] = value, True
        return pa.array(out, mask=~fits)


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct x-vectors of ``rows``; None if no vector is usable.

    Vectors that are null or empty, hold null or non-finite entries, or entries whose x does not fit 62 bits take no part. If lengths
    differ, those of the commonest length (of several the longest) count. Components without variance are left out.
    """
    spark = rows.sparkSession
    vectors = rows.select(F.col(vector_col).cast("array<double>").alias("v"))
    distinct = persist_reliably(vectors.mapInArrow(*_packed(scale)).groupBy("dim", "x").agg(F.count("*").alias("copies")))
    lengths = distinct.groupBy("dim").agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if lengths is None:
        return None
    dim = lengths["dim"]
    distinct = distinct.filter(F.col("dim") == dim).select("x")
    whole = F.sum(F.col("low").cast("decimal(38,0)")) + F.sum(F.col("high").cast("decimal(38,0)")) * (1 << 32)
    sums = distinct.mapInArrow(*_sums(dim)).groupBy("i").agg(F.sum("n").alias("n"), whole.alias("s")).orderBy("i").collect()
    n, sums = sums[0]["n"], tuple(int(row["s"]) for row in sums)
    centre = Whitening(scale, n, sums, np.empty(0), np.empty((0, dim)), 0.0, 0.0)
    covariance = _added(distinct.mapInArrow(*_products(dim, centre.centred, dim)), dim) / n
    trace = float(np.trace(covariance))
    values, vectors = leading_components(covariance, components)
    some = values > 64 * _EPS * dim * trace
    model = Whitening(scale, n, sums, values[some], vectors[some], trace, 0.0)
    width = len(model.values)
    if width:
        sent = spark.sparkContext.broadcast(model)
        spread = _added(distinct.mapInArrow(*_products(dim, lambda x: sent.value.whitened(x), width)), width) / n
        sent.unpersist()
        error = float(np.abs(spread - np.eye(width)).max())
        model = Whitening(scale, n, sums, values[some], vectors[some], trace, error)
    return model


_ROWS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error), a row for each usable row and component of the model.

    Rows that ``fit`` leaves out have none. Repeated rows and rows without an id are rows like others. The model is a few vectors, sent
    to every task.
    """
    spark = rows.sparkSession
    narrow = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    if model is None:
        return spark.createDataFrame([], f"{id_col} long, {_ROWS}")
    sent = spark.sparkContext.broadcast(model)
    names = ["id", *(part.split()[0] for part in _ROWS.split(", "))]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k = len(model.values)
        for batch in batches:
            for at, x in _whole(batch.column(1), model.scale):
                if x.shape[1] != len(model.sums):
                    continue
                each = pa.array(np.repeat(np.arange(len(x)), k))
                same = np.ones(len(x) * k)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(at)).take(each),
                        np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                        np.full(len(x) * k, model.n),
                        model.deviation(x).take(each),
                        model.whitened(x).ravel(),
                        np.tile(model.values / model.trace, len(x)) if k else same,
                        same * model.identity_error,
                    ],
                    names=names,
                )

    return narrow.mapInArrow(over, f"id long, {_ROWS}").withColumnRenamed("id", id_col)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``transform`` by the whitening that ``fit`` learns from the same rows. An empty table gives no rows."""
    return transform(rows, fit(rows, vector_col, components, scale), id_col, vector_col)
