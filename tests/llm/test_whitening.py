"""Whitening against numpy's eigenvalues and exact integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from spanloom.llm import whitening as W

COLUMNS = "vec_id long, embedding array<float>, label int, x double, component int, i string"


def brute(rows, k):
    """Rows by id as the docstring of ``whiten`` defines them, over exact sums."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max({len(v) for _, v in good}, key=lambda d: (sum(len(v) == d for _, v in good), d))
    good = [(i, v) for i, v in good if len(v) == size]
    fit = sorted(set(map(tuple, (v for _, v in good))))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(v, s)] for v in fit])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, v in good:
        c = np.array([float(Fraction(a) - Fraction(b, n)) for a, b in zip(v, s)])
        dev = sum((n * a - b) ** 2 for a, b in zip(v, s))
        out.setdefault(i, []).append([(n, dev, abs(c @ u[:, j]) / math.sqrt(e[j]), e[j] / e.sum()) for j in range(min(k, size))])
    return out


def rows_of(r, n, d):
    scale = [2.0 ** -(j % 7) for j in range(d)]
    rows = [(i, [r.gauss(0, 1) * s for s in scale]) for i in range(n)]
    rows += [(n + i, list(rows[3][1])) for i in range(n // 3)]  # one vector in a quarter of all rows
    return rows + [(5, list(rows[5][1])), (9001, None), (9002, [None] + [0.1] * (d - 1)), (9003, [float("nan")] * d), (9004, [float("inf")] + [0.0] * (d - 1)), (9005, [0.5] * (d - 1)), (9006, []), (None, [0.25] * d)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, 7, "z") for i, v in rows], COLUMNS).repartition(5)


@pytest.mark.parametrize("d", [2, 3, 12])
def test_equals_numpy(spark, d):
    rows = rows_of(random.Random(d), 90, d)
    want = brute(rows, 4)
    got = {}
    for x in W.whiten(frame(spark, rows)).collect():
        got.setdefault(x.vec_id, []).append(x)
    assert set(got) == set(want)
    for i, lists in want.items():
        assert len(got[i]) == sum(map(len, lists))
        flat = sorted(got[i], key=lambda x: x.component)
        for j, x in enumerate(sorted((c + 1, *v) for vs in lists for c, v in enumerate(vs))):
            assert (flat[j].component, flat[j].n, flat[j].deviation) == x[:3]
            assert abs(abs(flat[j].whitened) - x[3]) < 1e-7 and abs(flat[j].explained - x[4]) < 1e-12
            assert flat[j].identity_error < 1e-10


def test_jacobi_keeps_small_eigenvalues():
    r = np.random.default_rng(4)
    core = np.eye(6) + 0.1 * (lambda m: m + m.T)(r.random((6, 6)))
    d = np.diag(10.0 ** -np.arange(0, 12, 2))
    e, v = W.jacobi(d @ core @ d)
    assert np.abs(v.T @ v - np.eye(6)).max() < 1e-12
    # the exact values by rational determinants: the least is 1e-10 times its diagonal entry of the last Schur complement
    assert abs(np.prod(e) / (np.linalg.det(core) * np.prod(np.diag(d)) ** 2) - 1) < 1e-10
    assert np.all(np.diff(e) <= 0)
    assert W.jacobi(np.zeros((0, 0)))[0].shape == (0,)


def test_flat_empty_and_huge(spark):
    assert W.whiten(frame(spark, []).limit(0)).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [None])])).collect() == []
    flat = W.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(4)])).collect()
    assert len(flat) == 8 and all((x.n, x.deviation, x.whitened, x.explained, x.identity_error) == (1, 0, None, 0.0, 0.0) for x in flat)
    line = W.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert all((x.whitened is None) == (x.component == 2) for x in line)
    big = W._deviation(np.array([[1 << 30, 5]]), 1 << 20, np.array([-(1 << 40), 0]))
    assert list(big) == [((1 << 50) + (1 << 40)) ** 2 + (5 << 20) ** 2]
    zero = W.whiten(frame(spark, [(1, [-0.0, 0.001]), (2, [0.0, 0.002])])).collect()
    assert {x.n for x in zero} == {1}
