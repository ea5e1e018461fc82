"""Distribution tails and exact tests on counts and moments that Spark has aggregated."""

from __future__ import annotations

from math import comb, erf, erfc, exp, lgamma, log, pi, sqrt

import numpy as np


def pnorm(x: float, mean: float = 0.0, sd: float = 1.0) -> float:
    return 0.5 * erfc(-(x - mean) / (sd * sqrt(2)))


def dnorm(x, mean: float, sd: float):
    x = np.asarray(x, float)
    return np.exp(-((x - mean) ** 2) / (2 * sd * sd)) / (sd * sqrt(2 * pi))


def dpois(k: int, mean: float) -> float:
    if mean <= 0:
        return 1.0 if k == 0 else 0.0
    return exp(k * log(mean) - mean - lgamma(k + 1))


def log_dpois(k: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Logs of Poisson probabilities of whole counts, of which each distinct one's factorial is taken once."""
    k, mean = np.broadcast_arrays(np.asarray(k, float), np.asarray(mean, float))
    kinds, at = np.unique(k, return_inverse=True)
    factorial = np.array([lgamma(x + 1) for x in kinds])[at].reshape(k.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = k * np.log(mean) - mean - factorial
    return np.where(mean > 0, out, np.where(k == 0, 0.0, -np.inf))


def sign_test(positive: int, n: int) -> float:
    """Two-sided exact binomial test at one half."""
    if n == 0:
        return 1.0
    k = min(positive, n - positive)
    if n <= 1000:
        return min(1.0, 2 * sum(comb(n, i) for i in range(k + 1)) / 2**n)
    return min(1.0, 2 * pnorm((k + 0.5 - n / 2) / sqrt(n / 4)))


def signed_rank_test(values: list[float], mu: float = 0.5, times: list[int] | None = None) -> float:
    """Wilcoxon signed rank: exact below 50 values without ties or zeros, else normal with continuity.

    ``times`` says how often each value occurs, so that distinct values with counts will do."""
    d = np.round(np.asarray(values, float) - mu, 12)
    held = np.ones(len(d), np.int64) if times is None else np.asarray(times, np.int64)
    zeros = bool((d == 0).any())
    d, held = d[d != 0], held[d != 0]
    n = int(held.sum())
    if n == 0:
        return float("nan")
    kinds, inverse = np.unique(np.abs(d), return_inverse=True)
    count = np.bincount(inverse, held, len(kinds))
    rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
    v = float((rank * held)[d > 0].sum())
    if n < 50 and not zeros and len(kinds) == n:
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1
        for r in range(1, n + 1):
            ways[r:] = ways[r:] + ways[: len(ways) - r].copy()
        p = ways / 2.0**n
        v = int(v)
        tail = p[v:].sum() if v > n * (n + 1) / 4 else p[: v + 1].sum()
        return min(1.0, 2 * float(tail))
    z = v - n * (n + 1) / 4
    sd = sqrt(n * (n + 1) * (2 * n + 1) / 24 - float((count**3 - count).sum()) / 48)
    z = (z - np.sign(z) * 0.5) / sd
    return 2 * min(pnorm(z), 1 - pnorm(z))


def rank_sum_test(x: list[float], y: list[float]) -> float:
    """Wilcoxon rank sum by the normal law, with continuity and tie correction."""
    kinds, inverse, count = np.unique(np.concatenate([x, y]), return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
    return rank_sum_p(len(x), len(y), float(rank[: len(x)].sum()), float((count.astype(float) ** 3 - count).sum()))


def rank_sum_p(n: int, m: int, ranks: float, ties: float) -> float:
    """The same from the sizes, the sum of the first sample's ranks, and the sum of t^3 - t over ties of t."""
    if n < 2 or m < 2:
        return float("nan")
    z = ranks - n * (n + 1) / 2 - n * m / 2
    sd = sqrt(max(0.0, n * m / 12 * ((n + m + 1) - ties / ((n + m) * (n + m - 1)))))
    if sd == 0:
        return float("nan")
    z = (z - np.sign(z) * 0.5) / sd
    return 2 * min(pnorm(z), 1 - pnorm(z))


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d or 1e-300)
    h = d
    for m in range(1, 300):
        for k, v in ((0, m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))), (1, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))):
            d = 1 / ((1 + v * d) or 1e-300)
            c = (1 + v / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def beta_tail(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_tail(t: float, df: float) -> float:
    """Two-sided tail of Student's t."""
    return beta_tail(df / 2, 0.5, df / (df + t * t))


def welch_test(n1: int, m1: float, v1: float, n2: int, m2: float, v2: float) -> float:
    """Welch's t test from counts, means and variances."""
    if n1 < 2 or n2 < 2 or v1 + v2 == 0:
        return float("nan")
    a, b = v1 / n1, v2 / n2
    return t_tail((m1 - m2) / sqrt(a + b), (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n2 - 1)))


def fisher_test(a: int, b: int, c: int, d: int) -> float:
    """Two-sided Fisher test of a 2 x 2 table."""
    n, row, column = a + b + c + d, a + b, a + c
    lc = lambda x, y: lgamma(x + 1) - lgamma(y + 1) - lgamma(x - y + 1)
    p = lambda k: exp(lc(row, k) + lc(n - row, column - k) - lc(n, column))
    own = p(a)
    return min(1.0, sum(q for k in range(max(0, row + column - n), min(row, column) + 1) if (q := p(k)) <= own * (1 + 1e-7)))


def normal_quantile(p: float) -> float:
    """Inverse of pnorm by Newton steps from a rough start."""
    if not 0 < p < 1:
        return float("inf") if p >= 1 else float("-inf")
    t = sqrt(-2 * log(min(p, 1 - p)))
    x = t - (2.30753 + 0.27061 * t) / (1 + 0.99229 * t + 0.04481 * t * t)
    x = -x if p < 0.5 else x
    for _ in range(8):
        x -= (pnorm(x) - p) / (exp(-x * x / 2) / sqrt(2 * pi))
    return x


def shapiro_wilk(values: list[float]) -> tuple[float, float]:
    """W and p by Royston's published approximation (1995); fewer than 3 or constant values give (1, 0)."""
    x = np.sort(np.asarray(values, float))
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return 1.0, 0.0
    m = np.array([normal_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    total = float((m**2).sum())
    u = 1 / sqrt(n)
    a = np.zeros(n)
    if n == 3:
        a[[0, -1]] = -sqrt(0.5), sqrt(0.5)
    else:
        # fixed values: the published polynomial coefficients, highest power first
        last = np.polyval([-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, m[-1] / sqrt(total)], u)
        if n > 5:
            next_ = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / sqrt(total)], u)
            scale = (total - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * next_**2)
            a[2:-2] = m[2:-2] / sqrt(scale)
            a[[1, -2]] = -next_, next_
        else:
            scale = (total - 2 * m[-1] ** 2) / (1 - 2 * last**2)
            a[1:-1] = m[1:-1] / sqrt(scale)
        a[[0, -1]] = -last, last
    w = float((a @ x) ** 2 / ((x - x.mean()) ** 2).sum())
    w = min(w, 1.0)
    if n == 3:
        p = 6 / pi * (np.arcsin(sqrt(w)) - np.arcsin(sqrt(0.75)))
        return w, float(min(max(p, 0.0), 1.0))
    if n <= 11:
        g = -2.273 + 0.459 * n
        y = -log(max(g - log(max(1 - w, 1e-300)), 1e-300))
        mean = np.polyval([-0.0006714, 0.025054, -0.39978, 0.544], n)
        sd = exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        y, ln = log(max(1 - w, 1e-300)), log(n)
        mean = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sd = exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return w, 1 - pnorm(y, float(mean), sd)


def gaussian_fit(x: np.ndarray, f: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Least-squares fit of a * exp(-(x - m)^2 / 2 s^2) to a histogram, by damped Gauss-Newton steps."""
    x, f = np.asarray(x, float), np.asarray(f, float)
    share = f / f.sum()
    m = float((share * x).sum())
    above = x[np.searchsorted(np.cumsum(share), 0.841, "left").clip(max=len(x) - 1)]
    a, s = float(f.max()), max(float(above - m), 1e-9)
    if s <= 1e-9:
        s = max(float(np.sqrt((share * (x - m) ** 2).sum())), 1e-9)
    loss = lambda a, m, s: float(((f - a * np.exp(-((x - m) ** 2) / (2 * s * s))) ** 2).sum())
    now, damp = loss(a, m, s), 1e-3
    for _ in range(steps):
        g = np.exp(-((x - m) ** 2) / (2 * s * s))
        j = np.column_stack([g, a * g * (x - m) / s**2, a * g * (x - m) ** 2 / s**3])
        h = j.T @ j
        step = np.linalg.lstsq(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ (f - a * g), rcond=None)[0]
        try_ = (a + step[0], m + step[1], abs(s + step[2]) or 1e-9)
        after = loss(*try_)
        if after < now:
            done = now - after < 1e-14 * (1 + now)
            (a, m, s), now, damp = try_, after, damp / 3
            if done:
                break
        else:
            damp *= 5
    return a, m, s


def two_sided_normal(x: float, mean: float, sd: float) -> float:
    return 1 - abs(erf((x - mean) / (sd * sqrt(2))))
