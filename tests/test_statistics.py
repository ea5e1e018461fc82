import math

import numpy as np
import pytest

from spanloom.functions import tails as T
from spanloom.operators import correlate as C


def test_exact_tests_by_hand():
    assert T.sign_test(0, 5) == pytest.approx(2 / 32)
    assert T.signed_rank_test([0.9, 0.8, 0.7, 0.6], 0.5) == pytest.approx(0.125)
    assert T.fisher_test(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert T.t_tail(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert T.dpois(2, 3.0) == pytest.approx(0.2240418)
    assert math.isnan(T.rank_sum_test([1.0], [2.0, 3.0]))


def test_welch_equals_the_formula():
    x, y = np.array([1.0, 2, 3, 4]), np.array([2.0, 4, 6, 9])
    p = T.welch_test(4, x.mean(), x.var(ddof=1), 4, y.mean(), y.var(ddof=1))
    assert 0.1 < p < 0.2


def test_shapiro_of_normal_and_skewed():
    z = [T.normal_quantile((i - 0.375) / 50.25) for i in range(1, 51)]
    assert T.shapiro_wilk(z)[1] > 0.9
    assert T.shapiro_wilk(list(np.exp(2 * np.array(z))))[1] < 1e-4
    assert T.shapiro_wilk([1.0, 1.0, 1.0])[1] == 0.0


def test_gaussian_fit_recovers():
    x = np.linspace(-5, 9, 60)
    _, m, s = T.gaussian_fit(x, 7 * np.exp(-((x - 2) ** 2) / (2 * 1.5**2)))
    assert (m, s) == (pytest.approx(2, abs=1e-4), pytest.approx(1.5, abs=1e-4))


TWO = [("c", 0, 3, 3.0, 2.0), ("c", 10, 12, 8.0, 9.0), ("c", 20, 24, 6.0, 5.0)]


def sample(bed, rows):
    return bed([(c, s, e, n, v, "+") for c, s, e, x, y in rows for n, v in (("a", x), ("b", y)) if v is not None])


def test_weighted_equals_unweighted_of_single_bases(bed):
    whole = C.pearson(C.align_samples(sample(bed, TWO), "a", "b"), weighted=True).first()
    single = [(c, p, p + 1, x, y) for c, s, e, x, y in TWO for p in range(s, e)]
    bases = C.pearson(C.align_samples(sample(bed, single), "a", "b")).first()
    for k in ("mean_x", "mean_y", "sd_x", "sd_y", "cov", "r"):
        assert whole[k] == pytest.approx(bases[k])


def test_compat_leaves_missing_features_out_of_the_deviation(bed):
    al = C.align_samples(sample(bed, [*TWO, ("c", 30, 31, 4.0, None)]), "a", "b")
    spec, compat = C.pearson(al).first(), C.pearson(al, compat=True).first()
    assert spec["mean_y"] == compat["mean_y"] == pytest.approx(4.0)
    assert compat["sd_y"] < spec["sd_y"]
    assert C.spearman(al).first()["n"] == 4


def test_repeated_feature_of_a_sample_is_an_error(bed):
    twice = sample(bed, [TWO[0], TWO[0]])
    with pytest.raises(Exception, match="repeated feature"):
        C.align_samples(twice, "a", "b").collect()
