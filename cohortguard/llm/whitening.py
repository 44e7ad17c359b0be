"""Embedding whitening by QDWH spectral divide and conquer.

Spark sums the rows: exact sums first, then the centred covariance, a matrix
whose size depends on the dimension alone.  Its eigenvectors come from polar
decompositions: the polar factor of the covariance shifted by s is +1 on the
subspace of eigenvalues above s and -1 below, so half its sum with the identity
projects on the upper one.  Each subspace is split again in the same way until
single directions remain; lower subspaces that no wanted component lies in are
left whole.  The mean and the wanted directions, a few rows of numbers, go to
the tasks that whiten all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

_EPS = np.finfo(float).eps


# --- eigenvectors of a symmetric matrix


def polar(a: np.ndarray) -> np.ndarray | None:
    """Polar factor of a symmetric matrix by dynamically weighted Halley steps
    (None if the matrix is singular)."""
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))  # no singular value is smaller
    except np.linalg.LinAlgError:
        return None
    if not low > _EPS / 16:
        return None
    eye = np.eye(len(a))
    for _ in range(40):
        low = min(low, 1.0)
        q = low * low
        d = np.cbrt(4 * (1 - q) / (q * q))
        wa = math.sqrt(1 + d) + math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - q) / (q * math.sqrt(1 + d)))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # badly scaled: by orthogonal factors
            both, _r = np.linalg.qr(np.vstack([math.sqrt(wc) * x, eye]))
            y = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * both[:len(a)] @ both[len(a):].T
        else:
            y = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        y = (y + y.T) / 2
        step, x = np.linalg.norm(y - x), y
        low = low * (wa + wb * q) / (1 + wc * q)
        if step < 1e-13 * math.sqrt(len(a)):
            break
    return x


def _range_of(projector: np.ndarray, k: int) -> np.ndarray:
    """Orthonormal basis of the ``k`` dimensions that a projector keeps."""
    basis = np.random.default_rng(k).standard_normal((len(projector), k))
    for _ in range(3):
        basis, _r = np.linalg.qr(projector @ basis)
    return basis


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the upper and lower invariant subspaces, or None where all
    eigenvalues are one."""
    m, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(m)) / math.sqrt(m)  # deviation of the eigenvalues
    if spread <= 8 * _EPS * np.linalg.norm(a):
        return None
    # the mean has eigenvalues on both sides; so has a little more or less
    near = [mean + t * spread / m for t in (0, 0.31, -0.31, 0.57, -0.57, 0.83, -0.83, 0.113, -0.113)]
    best = None
    for shift in [float(np.median(np.diag(a))), *near]:
        sign = polar(a - shift * np.eye(m))
        if sign is None:
            continue
        upper = (sign + np.eye(m)) / 2
        k = round(float(np.trace(upper)))
        if not 0 < k < m:
            continue
        v1, v2 = _range_of(upper, k), _range_of(np.eye(m) - upper, m - k)
        left = np.linalg.norm(v2.T @ a @ v1) / np.linalg.norm(a)
        if best is None or left < best[0]:
            best = left, v1, v2
        if left < 100 * m * _EPS:
            break
    return best and best[1:]


def leading_eigenvectors(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns."""
    wanted = min(wanted, len(a))
    if wanted <= 0:
        return np.empty(0), np.empty((len(a), 0))
    bases = _split(a) if len(a) > 1 else None
    if bases is None:
        order = np.argsort(-np.diag(a), kind="stable")[:wanted]
        return np.diag(a)[order], np.eye(len(a))[:, order]
    found = []
    for basis in bases:
        if wanted > 0:
            inner = basis.T @ a @ basis
            _, vectors = leading_eigenvectors((inner + inner.T) / 2, wanted)
            found.append(basis @ vectors)
            wanted -= vectors.shape[1]
    vectors, upper = np.linalg.qr(np.hstack(found))
    vectors = vectors * np.where(np.diag(upper) < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- sums over rows


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as a matrix of long integers."""
    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            yield part, part["x"].flatten().to_numpy().reshape(-1, dim)


def _sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for _, x in _matrices(batches, dim):
            wide = x if abs(x.astype(float)).max(initial=0) < 2.0 ** 50 else x.astype(object)
            total = [int(a) + int(b) for a, b in zip(total, wide.sum(axis=0))]
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()),
                                          pa.array([str(v) for v in [n, *total]])], names=["dim", "total"])

    return run


def _gram(rows: DataFrame, dim: int, width: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the rows of the outer products of ``centred`` vectors.

    A task sends one matrix; rows of the matrices are added where they meet,
    streamed, and ``width`` rows reach the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for _, x in _matrices(batches, dim):
            y = centred(x)
            total += y.T @ y
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total))],
                                             names=["i", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch["i"].to_pylist(), batch["sums"].flatten().to_numpy().reshape(-1, width)):
                sums[i] = sums[i] + row if i in sums else row
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["i", "sums"])

    kind = "i int, sums array<double>"
    found = rows.mapInArrow(products, kind).repartition("i").mapInArrow(added, kind).collect()
    out = np.zeros((width, width))
    for r in found:
        out[r.i] = r.sums
    return out


@dataclass(frozen=True)
class Whitener:
    """What the tasks need: ``sums`` and ``n`` of the fit list, directions
    (columns) and their eigenvalues; ``identity_error`` as measured."""
    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exactly: long integers where they fit."""
        most = abs(x.astype(float)).max(initial=0) * self.n + max(map(abs, self.sums), default=0)
        exact = np.int64 if most < 2.0 ** 62 else object
        return x.astype(exact) * self.n - np.array(self.sums, exact)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.values)


def integer_vectors(rows: DataFrame, vector_col: str, id_col: str, scale: int = 256) -> DataFrame:
    """(id, x): vectors without null or non-finite entries, each entry as
    ``floor(scale * entry)``.

    Vectors of another length than the most frequent one (the larger on ties)
    cannot be compared and are left out; so are empty ones.
    """
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))
    v = F.col("v")
    clean = (rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
             .where(v.isNotNull() & F.coalesce(F.forall("v", entry), F.lit(False)) & (F.size("v") > 0)))
    return clean.select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x"))


def fit_whitener(vectors: DataFrame, components: int = 4) -> Whitener | None:
    """Fit on each distinct ``x`` of ``vectors`` once (None without any).

    Directions whose variance is nothing but rounding are left out, so there
    may be fewer than ``components``, or none where all vectors are one.
    """
    sizes = vectors.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        return None
    dim = sizes.dim
    distinct = written(vectors.where(F.size("x") == dim).select("x").distinct(), "distinct-vectors")
    totals = {r.dim: int(r.total) for r in distinct.mapInArrow(_sums(dim), "dim int, total string")
              .groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    n, sums = totals[-1], tuple(totals[i] for i in range(dim))
    centre = Whitener(n, sums, np.empty((dim, 0)), np.empty(0), 0.0)
    cov = _gram(distinct, dim, dim, centre.centred) / n
    cov = (cov + cov.T) / 2
    values, vectors_ = leading_eigenvectors(cov, components)
    real = values > dim * 4 * _EPS * max(float(np.trace(cov)), 0.0)
    fitted = Whitener(n, sums, vectors_[:, real], values[real], float(np.trace(cov)))
    k = int(real.sum())
    if not k:
        return fitted
    error = float(abs(_gram(distinct, dim, k, fitted.whitened) / n - np.eye(k)).max())
    return Whitener(n, sums, fitted.directions, fitted.values, fitted.trace, error)


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 256) -> DataFrame:
    """One row for each usable vector and component: ``id_col, component, n,
    deviation`` (decimal, exact), ``whitened, explained, identity_error``.

    Null vectors and vectors with null or non-finite entries are dropped, as
    are those of another length (:func:`integer_vectors`).  Equal vectors count
    once in the fit; repeated rows are all returned.  Components number from
    1 by falling eigenvalue, fewer than asked where the vectors span fewer
    dimensions; the result is empty where they span none.  Equal eigenvalues
    leave the choice of directions free.  Null ids stay null; other columns
    are ignored.
    """
    vectors = integer_vectors(rows, vector_col, id_col, scale)
    fitted = fit_whitener(vectors, components)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    dim, k = fitted.directions.shape
    explained = fitted.values / fitted.trace if k else np.empty(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, dim):
            d = fitted.deviations(x)
            if d.dtype != object and float(abs(d.astype(float)).max(initial=0)) ** 2 * dim >= 2.0 ** 62:
                d = d.astype(object)
            m = len(x)
            deviation = pa.array(map(int, np.repeat((d * d).sum(axis=1), k)), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [part["id"].take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, fitted.n)), deviation, pa.array(fitted.whitened(x).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, fitted.identity_error or 0.0))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.where(F.size("x") == dim).mapInArrow(run, schema).withColumnRenamed("id", id_col)
