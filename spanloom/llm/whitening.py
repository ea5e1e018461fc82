"""Whitening of embeddings by the cyclic Jacobi method.

Entries become whole steps of 1/256.  The fit list holds each distinct step vector once; its count
and sums are exact, and its scatter is summed over tasks from centred vectors.  The driver holds one
square matrix of the dimension (at most ``MAX_DIM``) and turns it by Jacobi rotations until what is
off the diagonal is lost beside the diagonal entries it stands between, which keeps small
eigenvalues accurate.  The rows are then multiplied by a matrix of the dimension times the
components, the only thing sent to the tasks.

Rows whose vector is null, or has null or non-finite entries, are left out, and so are rows that
have not the commonest length (of equally common ones the longest): they have no place in the
covariance.  Repeated rows are returned each and count once in the fit.  An empty table gives an
empty one.  A component without variance has a null ``whitened``, and all variances zero make
``explained`` zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import stage

STEPS = 256
#: The largest dimension: the driver holds a few matrices of its square (130 MB each at the bound).
MAX_DIM = 4096
#: A component is flat where its eigenvalue is below this share of the trace.
FLAT = 1e-14


@dataclass(frozen=True)
class Whitening:
    """Count and sums of the fit list, eigenvalues by size, their unit vectors (columns), and the fit's largest error."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    error: float = 0.0

    def matrix(self, k: int) -> np.ndarray:
        """Projection on the first ``k`` components, each over the root of its eigenvalue; flat ones are NaN."""
        e = self.values[:k]
        good = e > FLAT * max(self.values.sum(), 0.0)
        return np.where(good, self.vectors[:, :k] / np.sqrt(np.where(good, e, 1.0)), np.nan)


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, by cyclic rotations.

    An entry is zero when it is below the precision of the roots of the two diagonal entries
    multiplied: the test under which small eigenvalues of a scatter keep their digits.  Each
    vector's largest entry is positive."""
    a = np.array(a, float)
    n = len(a)
    v = np.eye(n)
    tiny = np.finfo(float).eps
    floor = tiny * tiny * max(np.abs(a).max(initial=0.0), np.finfo(float).tiny)
    for _ in range(sweeps):
        turned = False
        for p in range(n - 1):
            for q in range(p + 1, n):
                x = a[p, q]
                if abs(x) <= max(tiny * np.sqrt(abs(a[p, p]) * abs(a[q, q])), floor):
                    continue
                turned = True
                t = (a[q, q] - a[p, p]) / (2 * x)
                t = (1.0 if t >= 0 else -1.0) / (abs(t) + np.hypot(1.0, t))
                c = 1 / np.hypot(1.0, t)
                s = t * c
                low, high = a[p, p] - t * x, a[q, q] + t * x
                rp, rq = a[p].copy(), a[q]
                a[p], a[q] = c * rp - s * rq, s * rp + c * rq
                a[:, p], a[:, q] = a[p], a[q]
                a[p, p], a[q, q], a[p, q], a[q, p] = low, high, 0.0, 0.0
                vp = v[:, p].copy()
                v[:, p], v[:, q] = c * vp - s * v[:, q], s * vp + c * v[:, q]
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    v = v[:, order] / np.linalg.norm(v[:, order], axis=0)
    return np.diag(a)[order], v * np.where(v[np.abs(v).argmax(0), np.arange(n)] < 0, -1.0, 1.0) if n else v


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """A list column of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def step_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key`` and ``x``, the vectors in whole steps, of the rows that can be used; every row is read once."""
    slim = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where("v is not null")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    x = F.transform("v", lambda c: F.floor(c.cast("double") * STEPS).cast("long"))
    return slim.where(F.forall("v", fine)).select("key", x.alias("x"))


def _common_length(x: DataFrame) -> int:
    """The length of most vectors; one row for each length reaches the driver's single row."""
    best = x.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d")).alias("best")).first()["best"]
    return best["d"] if best else 0


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b in batches:
        x = _matrix(b.column(0), np.int64)
        n, total = n + len(x), x.sum(0) + (0 if total is None else total)
    if n:
        at = np.arange(-1, len(total))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([[n], total]))], ["at", "v"])


def _scatter(mean: np.ndarray, w: np.ndarray | None = None):
    """Sum of products of centred vectors (times ``w``, if given), a row of ``(i, values)`` for each line of the matrix."""

    def run(batches):
        total = None
        for b in batches:
            if len(b):
                y = _matrix(b.column(0), np.float64) - mean
                y = y if w is None else y @ w
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            i, j = np.divmod(np.arange(total.size), len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    return run


def _square(fit: DataFrame, mean: np.ndarray, n: int, d: int, w: np.ndarray | None = None) -> np.ndarray:
    """The scatter over ``n``, summed over the tasks by entry."""
    rows = fit.mapInArrow(K.freeing(_scatter(mean, w)), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((d, d))
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["v"].to_numpy() / n
    return (out + out.T) / 2


def fit_whitening(x: DataFrame, components: int | None = None) -> Whitening | None:
    """The whitening of ``x`` (as ``step_vectors`` gives it, of one length), and how far its first ``components`` are from
    the identity over the fit list; None for no rows."""
    fit = stage(x.select("x").distinct(), "fit")
    got = fit.mapInArrow(K.freeing(_sums), "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    if not len(got):
        return None
    all_ = got["v"].to_numpy()[np.argsort(got["at"].to_numpy())]
    n, sums = int(all_[0]), all_[1:]
    d = len(sums)
    if d > MAX_DIM:
        raise ValueError(f"vectors of more than {MAX_DIM} entries")
    mean = sums / n
    values, vectors = jacobi(_square(fit, mean, n, d))
    out = Whitening(n, sums, values, vectors)
    w = out.matrix(components or d)
    w = w[:, ~np.isnan(w).any(0)]
    error = float(np.abs(_square(fit, mean, n, w.shape[1], w) - np.eye(w.shape[1])).max()) if w.shape[1] else 0.0
    return Whitening(n, sums, values, vectors, error)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sums of (n x - S) squared, exact; in Python integers where 64 bits might not hold them."""
    top = n * max(int(np.abs(x).max(initial=0)), 1) + int(np.abs(sums).max(initial=0))
    if top * top * max(x.shape[1], 1) < 1 << 63:
        return ((n * x - sums) ** 2).sum(1)
    return np.array([sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x], object)


def _project(m: Whitening, k: int):
    mean, w, share = m.sums / m.n, m.matrix(k), m.values[:k] / (m.values.sum() or 1.0)

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), np.int64)
            y = (x - mean) @ w if len(x) else np.zeros((0, k))
            dev = _deviation(x, m.n, m.sums)
            rows, per = len(x), y.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(np.arange(rows), per))), pa.array(np.tile(np.arange(1, per + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * per, m.n)), pa.array([str(v) for v in np.repeat(dev, per)], pa.string()),
                    pa.array(y.ravel(), mask=np.isnan(y.ravel())), pa.array(np.tile(share, rows)), pa.array(np.full(rows * per, m.error)),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """Up to ``components`` rows for each usable row of ``df``.

    ``component`` counts from 1 by falling eigenvalue; ``deviation`` is exact (null beyond 64 bits); ``whitened`` is the centred
    vector on the component over the root of its eigenvalue; ``explained`` is the eigenvalue's share; ``identity_error`` is the
    largest distance of the whitened covariance from the identity, one value."""
    x = step_vectors(df, key, vector)
    x = x.where(F.size("x") == _common_length(x))
    of = x.schema["key"].dataType.simpleString()
    shape = f"key {of}, component int, n long, deviation string, whitened double, explained double, identity_error double"
    m = fit_whitening(x, components)
    if m is None:
        none = x.select("key", *(F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in shape.split(", ")[1:])).where("false")
        out = none
    else:
        out = x.select("key", "x").mapInArrow(K.freeing(_project(m, min(components, len(m.values)))), shape)
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)")).withColumnRenamed("key", key)
