"""Embedding whitening: a distributed covariance, float32 eigenvectors, and their refinement in higher precision.

Spark sums counts, exact integer sums and centred products per task and adds them up by cell, so only
numbers whose count depends on the dimension (d sums, d (d + 1) / 2 products) reach the driver. There the
covariance is rounded to float32 and solved; the Ogita-Aishima iteration then corrects all
eigenvectors at once by matrix products, first in double and last in extended precision. It divides by
differences of eigenvalues, so eigenvalues closer than its error bound are a cluster: their
vectors are only made orthonormal, and the small problem of the cluster, projected on its vectors and shifted by
its mean eigenvalue, is solved by itself before the iteration goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelflow.session import materialised

#: Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: A larger |floor(SCALE * c)| is no longer exact in a double: its vector is dropped like one that is not finite.
LARGEST = 2.0**53
#: A component whose share of the trace is not above this has no variance: its whitened value is 0.
FLAT = 1e-11


class Fit(NamedTuple):
    """n, the exact sums S and the range of x over the fit list; eigenpairs by falling eigenvalue."""

    n: int
    sums: list[int]
    low: int
    high: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(64 c) of the usable vectors among arrays of `size` entries, and which they are."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)  # null entries: NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(flat * SCALE)
        good = (np.abs(x) <= LARGEST).all(axis=1)
    return x[good].astype(np.int64), good


def _exact_sums(x: np.ndarray) -> list[int]:
    if np.abs(x).max(initial=0) < 2**40:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in x.astype(object).sum(axis=0)]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per length and dimension of this task: rows, exact sum, least and greatest."""
    held: dict[int, list] = {}
    for b in batches:
        column = b.column(0)
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            x, _ = integers(column.filter(pa.array(sizes == size)), int(size))
            if len(x):
                n, sums, low, high = held.get(int(size), (0, [0] * int(size), int(x.min()), int(x.max())))
                sums = [a + c for a, c in zip(sums, _exact_sums(x), strict=True)]
                held[int(size)] = (n + len(x), sums, min(low, int(x.min())), max(high, int(x.max())))
    rows = [(size, i, n, Decimal(v), low, high) for size, (n, sums, low, high) in held.items() for i, v in enumerate(sums)]
    cols = [list(c) for c in zip(*rows, strict=True)] or [[]] * 6
    types = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["size", "i", "n", "s", "low", "high"])


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n in double, by whole numbers up to the last rounding. `x` and `sums` have no offset."""
    base = [s // n for s in sums]
    rest = np.array([(s - m * n) / n for s, m in zip(sums, base, strict=True)])
    return (x - np.array(base, np.int64)).astype(np.float64) - rest


def deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None beyond a long."""
    base = [s // fit.n for s in fit.sums]
    rest = [s - m * fit.n for s, m in zip(fit.sums, base, strict=True)]
    y = x - np.array(base, np.int64)
    most = (fit.high - fit.low + 1) * fit.n
    if len(base) * most * most < 2**62:
        d = fit.n * y - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = fit.n * y.astype(object) - np.array(rest, object)
    return [int(v) if v < 2**63 else None for v in (d * d).sum(axis=1)]


def _products(values):
    """Per task, the upper triangle of the products of values(x), which are centred."""

    def run(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x, _ = integers(b.column(0), size)
            y = values(x)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def _covariance(vectors: DataFrame, size: int, n: int, values, width: int) -> np.ndarray:
    run = _products(values)
    cells = vectors.mapInArrow(lambda bs: run(bs, size), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in cells.toLocalIterator():
        out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out


def _norm(a: np.ndarray) -> float:
    return float(np.linalg.norm(a.astype(np.float64), 2)) if a.size else 0.0


def _clusters(values: np.ndarray, gap: float) -> np.ndarray:
    """A number for each eigenvalue; those that a chain of steps of at most `gap` joins have the same."""
    order = np.argsort(values)
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(np.diff(values[order], prepend=values[order[0]]) > gap)
    return out


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step: values, vectors, the values' clusters, and the size of the correction.

    No gap is told apart that is below what double precision knows of the matrix. Both products are made
    symmetric: rounding that is not is divided by small gaps and spoils the vectors' right angles.
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    gap = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    of = _clusters(values, max(gap, len(a) * np.finfo(np.float64).eps * _norm(a)))
    wide = of[None, :] != of[:, None]
    apart = np.where(wide, values[None, :] - values[:, None], 1)
    e = np.where(wide, (s + values[None, :] * r) / apart, r / 2)
    return values, x + x @ e, of, _norm(e)


def refined_eigenpairs(a: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and orthonormal eigenvectors of a symmetric matrix, to double precision.

    float32 gives the start. Each step is a few matrix products, the last ones in extended
    precision. Clusters are solved by themselves whenever their members' values are closer than
    the step's error bound. A zero matrix gives the unit vectors; a matrix without rows, nothing.
    """
    d = len(a)
    if d == 0 or not np.any(a):
        return np.zeros(d), np.eye(d)
    top = float(np.abs(a).max())
    wide = (a / top).astype(np.float64)
    x = np.linalg.eigh(wide.astype(np.float32))[1][:, ::-1].astype(np.float64)
    tiny = d * np.finfo(np.float64).eps
    for _ in range(steps):
        values, x, of, size = _corrected(wide, x)
        for c in (np.nonzero(of == i)[0] for i in range(of.max() + 1)):
            if len(c) > 1:
                x[:, c] = _sub_solve(wide, x[:, c], float(values[c].mean()))
        if size <= tiny:
            break
    wide = (a.astype(np.longdouble)) / np.longdouble(top)
    x = x.astype(np.longdouble)
    for _ in range(steps):
        values, x, _, size = _corrected(wide, x)
        if size <= tiny:
            break
    values = np.einsum("ij,ij->j", x, wide @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return (values[order] * np.longdouble(top)).astype(np.float64), x[:, order].astype(np.float64)


def _sub_solve(a: np.ndarray, x: np.ndarray, centre: float) -> np.ndarray:
    """The vectors of a cluster turned to the eigenvectors of the problem projected on them, shifted by its centre.

    The shift leaves small differences of nearly equal values, which the solve then tells apart.
    """
    q = np.linalg.qr(x)[0]
    small = q.T @ (a @ q - centre * q)
    return q @ np.linalg.eigh((small + small.T) / 2)[1][:, ::-1]


def _projection(fit: Fit, components: int) -> np.ndarray:
    """The matrix that whitens centred rows; a component without variance has a column of zeros."""
    k = min(components, len(fit.values))
    e = fit.values[:k]
    scale = np.where(e > FLAT * fit.trace, 1 / np.sqrt(np.where(e > 0, e, 1)), 0.0)
    return fit.vectors[:, :k] * scale


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vector, id) of the rows with a vector; entries that are neither float nor double become double."""
    kind = rows.schema[vector_col].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{vector_col} holds no arrays")
    v = F.col(vector_col)
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        v = v.cast("array<double>")
    return rows.select(v.alias("vector"), F.col(id_col).alias("id")).filter(F.size("vector") > 0)


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Fit | None:
    """The whitening of the usable vectors; None without any. See `whiten`."""
    vectors = usable(rows, id_col, vector_col).select("vector")
    shape = "size int, i int, n bigint, s decimal(38,0), low bigint, high bigint"
    parts = materialised(vectors.mapInArrow(_moments, shape), "moments")
    sizes = parts.filter("i = 0").groupBy("size").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    found = parts.filter(F.col("size") == most["size"]).groupBy("i").agg(F.sum("s").cast("string").alias("s")).collect()
    sums = [int(r.s) for r in sorted(found, key=lambda r: r.i)]
    n, size = most.n, most["size"]
    same = vectors.filter(F.size("vector") == size)
    cov = _covariance(same, size, n, lambda x: _centred(x, n, sums), size)
    values, basis = refined_eigenpairs(cov)
    return Fit(n, sums, most.low, most.high, values, basis, float(np.trace(cov)))


def identity_error(rows: DataFrame, got: Fit, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity.

    Components without variance are left out; 0 if all are.
    """
    size, w = len(got.sums), _projection(got, components)
    n, sums = got.n, got.sums
    same = usable(rows, id_col, vector_col).select("vector").filter(F.size("vector") == size)
    ones = lambda x: np.ones((len(x), 1))
    # a last column of ones gives the sums, so that the means are known before the products are centred
    white = lambda x: _centred(x, n, sums) @ w
    k = w.shape[1]
    mean = _covariance(same, size, n, lambda x: np.hstack([white(x), ones(x)]), k + 1)[:k, k]
    cov = _covariance(same, size, n, lambda x: white(x) - mean, k)
    live = np.any(w != 0, axis=0)
    return float(np.abs(cov[np.ix_(live, live)] - np.eye(int(live.sum()))).max(initial=0.0))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per usable row and component.

    An entry c counts as x = floor(64 c) + 1000000. Rows are dropped whose vector is null or empty, holds a null or
    an entry that is not finite or beyond 2^53 / 64, or has another length than most usable vectors (ties:
    the longest). Repeated rows and rows with a null id count each. Of d dimensions there are
    min(`components`, d) components. One whose eigenvalue is at most 1e-11 of the trace has no variance: its
    `whitened` is 0, and the identity error leaves it out; with a trace of 0 `explained` is 0 too. A
    `deviation` beyond a long is null. No usable vector gives no row. Other columns are not touched.

    The model is of a size that depends on d alone and is sent along with the tasks.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    got = fit(rows, id_col, vector_col)
    if got is None:
        return rows.sparkSession.createDataFrame([], shape)
    error = identity_error(rows, got, id_col, vector_col, components)
    size, w = len(got.sums), _projection(got, components)
    k = w.shape[1]
    share = got.values[:k] / got.trace if got.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, good = integers(b.column(0), size)
            m = len(x)
            white = _centred(x, got.n, got.sums) @ w
            each = pa.array(np.repeat(np.arange(m), k))
            ids = b.column(1).filter(pa.array(good)).take(each)
            deviation = pa.array(deviations(x, got), pa.int64()).take(each)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, got.n, np.int64)),
                    deviation,
                    pa.array(white.ravel()),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable(rows, id_col, vector_col).filter(F.size("vector") == size).mapInArrow(run, shape)
