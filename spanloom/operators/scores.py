"""Statistics of iterated scores: by iteration, by feature, by stratum, and against each other."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.functions import tails
from spanloom.functions.scalars import binned, log10_or_null
from spanloom.operators.correlate import ranked_values

AGGREGATES: dict[str, Callable[[], Column]] = {
    "AVERAGE": lambda: F.avg("score"),
    "SUM": lambda: F.sum("score"),
    "COUNT": lambda: F.sum((F.col("score") != 0).cast("double")),
    "MEDIAN": lambda: F.median("score"),
    "MIN": lambda: F.min("score"),
    "MAX": lambda: F.max("score"),
    "WEIGHTED": lambda: F.sum(F.col("length") * F.col("score")) / F.sum(F.when(F.col("score").isNotNull(), F.col("length"))),
    "WEIGHTED5": lambda: F.sum(F.col("bed_score") * F.col("score")) / F.sum(F.when(F.col("score").isNotNull(), F.col("bed_score"))),
}


def mask_null(df: DataFrame, suppress: bool = False, score: str = "score") -> DataFrame:
    """Null scores become 0, or with ``suppress`` the rows go."""
    return df.where(F.col(score).isNotNull()) if suppress else df.withColumn(score, F.coalesce(score, F.lit(0.0)))


def apply_log10(df: DataFrame, score: str = "score") -> DataFrame:
    return df.withColumn(score, log10_or_null(score))


def aggregate_iterations(iterated: DataFrame, how: str = "AVERAGE", keys: tuple[str, ...] = ()) -> DataFrame:
    """``iteration, value`` (within ``keys``)."""
    return iterated.groupBy(*keys, "iteration").agg(AGGREGATES[how]().alias("value"))


def tail_p(by_iteration: DataFrame) -> DataFrame:
    """The actual value (iteration -1) with the share of simulations at or beyond it on the nearer side."""
    actual = by_iteration.where("iteration = -1").select(F.col("value").alias("actual"))
    sims = by_iteration.where("iteration >= 0").select("value")
    n = sims.join(F.broadcast(actual)).agg(
        F.first("actual").alias("actual"), F.sum((F.col("value") <= F.col("actual")).cast("long")).alias("below"),
        F.sum((F.col("value") >= F.col("actual")).cast("long")).alias("above"), F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
    )
    return n.select("actual", "mean", "sd", "n", (F.least("below", "above") / F.col("n")).alias("p"))


def gaussian_p(by_iteration: DataFrame, bins: int = 50) -> tuple[float, float, float]:
    """Mean, sd and two-sided p of the actual value under a Gaussian fitted to the histogram of simulations."""
    r = by_iteration.agg(
        F.min(F.when(F.col("iteration") >= 0, F.col("value"))).alias("lo"), F.max(F.when(F.col("iteration") >= 0, F.col("value"))).alias("hi"),
        F.max(F.when(F.col("iteration") == -1, F.col("value"))).alias("actual"),
    ).first()
    if r["lo"] is None or r["lo"] == r["hi"]:
        return float("nan"), float("nan"), float("nan")
    width = (r["hi"] - r["lo"]) / bins
    hist = by_iteration.where("iteration >= 0").groupBy((F.least(F.floor((F.col("value") - r["lo"]) / width), F.lit(bins - 1))).cast("int").alias("bin")).count().collect()
    x = r["lo"] + (np.arange(bins) + 0.5) * width
    f = np.zeros(bins)
    for h in hist:
        f[h["bin"]] = h["count"]
    _, mean, sd = tails.gaussian_fit(x, f)
    return mean, sd, tails.two_sided_normal(r["actual"], mean, sd)


def feature_quantile(iterated: DataFrame) -> DataFrame:
    """Mid-rank of each feature's actual score among its simulations: ``id, actual, n, median, low, high, quantile``."""
    actual = F.max(F.when(F.col("iteration") == -1, F.col("score"))).over(Window.partitionBy("id"))
    sims = iterated.withColumn("actual", actual).where("iteration >= 0")
    less, equal = F.sum((F.col("score") < F.col("actual")).cast("long")), F.sum((F.col("score") == F.col("actual")).cast("long"))
    return sims.groupBy("id", "actual").agg(
        F.count("*").alias("n"), F.median("score").alias("median"), F.min("score").alias("low"), F.max("score").alias("high"),
        ((less + equal / 2) / F.count("*")).alias("quantile"),
    )


def aggregate_features(quantiles: DataFrame) -> dict[str, float]:
    """Sign and signed-rank tests of the quantiles against one half, or nan where their premises fail.

    The sign test fails where a feature's median is its least or largest simulation; the
    rank test where that holds for over 5 % of the features' simulations' ends.  The counts
    come from Spark; the rank test reads the quantiles, one number per feature class."""
    c = quantiles.agg(
        F.sum((F.col("quantile") > 0.5).cast("long")).alias("pos"), F.sum((F.col("quantile") != 0.5).cast("long")).alias("n"),
        F.max(((F.col("median") == F.col("low")) | (F.col("median") == F.col("high"))).cast("int")).alias("stuck"),
    ).first()
    out = {"sign": float("nan"), "rank": float("nan")}
    if c["n"] and not c["stuck"]:
        out["sign"] = tails.sign_test(c["pos"], c["n"])
    # values with their counts: at most one per distinct mid-rank, of which there are 2 n_iterations + 1
    counts = quantiles.groupBy("quantile").count().collect()
    if counts:
        out["rank"] = tails.signed_rank_test([r["quantile"] for r in counts], times=[r["count"] for r in counts])
    return out


def mid_rank_percentile(df: DataFrame, score: str, runs: int = 64) -> DataFrame:
    """Add ``percentile``: mid-rank times 100.  Ranks come from counts of distinct values, not from one global sort of rows."""
    ranks = ranked_values(df, score, runs).select(score, ((F.col("before") + F.col("ties") / 2) / F.col("total") * 100).alias("percentile"))
    return df.join(ranks, score)


OPERATIONS: dict[str, Callable[[Column, float], Column]] = {
    ">": lambda c, x: c > x, ">=": lambda c, x: c >= x, "<": lambda c, x: c < x, "<=": lambda c, x: c <= x,
    "==": lambda c, x: c == x, "!=": lambda c, x: c != x,
}


def stratum_predicate(score: Column, op: str, c1: float, c2: float | None = None) -> Column:
    """A named comparison; ``between`` includes its lower end only."""
    if op == "between":
        return (score >= c1) & (score < c2)
    return OPERATIONS[op](score, c1)


def by_score(
    iterated: DataFrame, *, stratum: float, low: float | None = None, high: float | None = None, percentile: bool = False,
    groups: list[tuple] = (), how: str = "AVERAGE",
) -> DataFrame:
    """Aggregates by stratum of the BED score: ``stratum, iteration, n, value``.

    Strata are multiples of ``stratum`` (rounded half to even; floored for percentiles), ends
    clamped to ``low`` and ``high``; ``groups`` of (label, op, c1[, c2]) add strata by
    predicate on the unbinned score.  Rows have ``id, iteration, bed_score, score``."""
    base = "bed_score"
    if percentile:
        iterated = mid_rank_percentile(iterated, "bed_score")
        base = "percentile"
    label = F.format_string("%.4f", binned(base, stratum, low, high, floor=percentile))
    named = [iterated.withColumn("stratum", label)]
    for g in groups:
        named.append(iterated.where(stratum_predicate(F.col("bed_score"), *g[1:])).withColumn("stratum", F.lit(g[0])))
    all_ = named[0]
    for more in named[1:]:
        all_ = all_.unionByName(more)
    return all_.groupBy("stratum", "iteration").agg(F.count("*").alias("n"), AGGREGATES[how]().alias("value"))


def rank_sums(scores: DataFrame, a: str, b: str) -> DataFrame:
    """What a rank-sum test of two strata needs, one row: sizes ``n, m``, ``ranks`` of the first, ``ties``, and the score ``z``.

    Ranks come from counts of distinct scores (``stratum, score``), so no stratum is gathered."""
    two = scores.where(F.col("stratum").isin(a, b) & F.col("score").isNotNull())
    own = two.groupBy("score").agg(F.count_if(F.col("stratum") == a).alias("first"), F.count_if(F.col("stratum") == b).alias("second"))
    t = F.col("ties").cast("double")
    sums = ranked_values(two, "score").join(own, "score").agg(
        F.coalesce(F.sum("first"), F.lit(0)).alias("n"), F.coalesce(F.sum("second"), F.lit(0)).alias("m"),
        F.sum(F.col("first") * (F.col("before") + (t + 1) / 2)).alias("ranks"), F.sum(t * t * t - t).alias("ties"),
    )
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    z = F.col("ranks") - n * (n + 1) / 2 - n * m / 2
    var = n * m / 12 * ((n + m + 1) - F.col("ties") / ((n + m) * (n + m - 1)))
    return sums.withColumn("z", F.when((n > 1) & (m > 1) & (var > 0), (z - F.signum(z) * 0.5) / F.sqrt(var)))


def compare_strata(scores: DataFrame, a: str, b: str) -> dict[str, float]:
    """Welch, rank-sum and Fisher tests of two strata's scores, from their moments, rank sums, and counts of zeros and ones."""
    m = {
        r["stratum"]: r
        for r in scores.where(F.col("stratum").isin(a, b)).groupBy("stratum").agg(
            F.count("score").alias("n"), F.avg("score").alias("mean"), F.var_samp("score").alias("var"),
            F.count_if(F.col("score") == 0).alias("zero"), F.count_if(F.col("score") == 1).alias("one"),
        ).collect()
    }
    nan = float("nan")
    if a not in m or b not in m or min(m[a]["n"], m[b]["n"]) < 2:
        return {"welch": nan, "rank_sum": nan, "fisher": nan}
    x, y = m[a], m[b]
    r = rank_sums(scores, a, b).first()
    return {
        "welch": tails.welch_test(x["n"], x["mean"], x["var"] or 0.0, y["n"], y["mean"], y["var"] or 0.0),
        "rank_sum": tails.rank_sum_p(r["n"], r["m"], r["ranks"], r["ties"]),
        "fisher": tails.fisher_test(x["zero"], x["one"], y["zero"], y["one"]),
    }


def strata_table(iterated: DataFrame, pairs: list[tuple[str, str]], strata: DataFrame) -> DataFrame:
    """Pairwise tests of strata, a row for each pair: ``first, second, welch, rank_sum, fisher, quantile_rank_sum``.

    ``strata`` (``stratum, id``) says which features a stratum holds.  Scores are the actual
    ones; the last column compares the features' quantiles among their simulations."""
    actual = iterated.where("iteration = -1").join(strata, "id").select("stratum", "score")
    quantiles = feature_quantile(iterated).join(strata, "id").select("stratum", F.col("quantile").alias("score"))
    rows = []
    for a, b in pairs:
        r = rank_sums(quantiles, a, b).first()
        got = compare_strata(actual, a, b)
        rows.append((a, b, got["welch"], got["rank_sum"], got["fisher"], tails.rank_sum_p(r["n"], r["m"], r["ranks"] or 0.0, r["ties"] or 0.0)))
    return iterated.sparkSession.createDataFrame(rows, "first string, second string, welch double, rank_sum double, fisher double, quantile_rank_sum double")


def aggregate(iterated: DataFrame, how: str = "AVERAGE") -> DataFrame:
    """The summary of a simulation in one row.

    By iteration: the actual aggregate, mean and sd of the simulated ones, tail p, and the
    two-sided p of a Gaussian fitted to their histogram.  By feature: how many there are,
    their mean quantile, and sign and signed-rank p of the quantiles against one half."""
    by_iteration = aggregate_iterations(iterated, how)
    t = tail_p(by_iteration).first()
    _, _, gaussian = gaussian_p(by_iteration)
    quantiles = feature_quantile(iterated)
    f = quantiles.agg(F.count("*").alias("n"), F.avg("quantile").alias("mean")).first()
    tests = aggregate_features(quantiles)
    return iterated.sparkSession.createDataFrame(
        [(t["actual"], t["mean"], t["sd"], t["n"], t["p"], gaussian, f["n"], f["mean"], tests["sign"], tests["rank"])],
        "actual double, mean double, sd double, n_iterations long, tail_p double, gaussian_p double, n_features long, mean_quantile double, sign_p double, rank_p double",
    )


def frequency(by_iteration: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of iteration values in ``bins`` bins, with shares at or below and at or above: ``x, n, at_most, at_least``."""
    sims = by_iteration.where("iteration >= 0")
    r = sims.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    width = F.when(width > 0, width).otherwise(F.raise_error(F.lit("values have no range")).cast("double"))
    x = F.floor(F.col("value") / F.col("width") + 0.5) * F.col("width")
    hist = sims.crossJoin(F.broadcast(r.select(width.alias("width")))).groupBy(x.alias("x")).agg(F.count("*").alias("n"))
    up = Window.orderBy("x")  # at most ``bins`` + 1 rows
    total = F.sum("n").over(Window.partitionBy())
    at_most = F.sum("n").over(up)
    return hist.select("x", "n", (at_most / total).alias("at_most"), ((total - at_most + F.col("n")) / total).alias("at_least"))


FEATURE_AGGREGATES = {"AVERAGE": F.avg, "MEDIAN": F.median, "MIN": F.min, "MAX": F.max}
DISTRIBUTIONS = ("unpaired_all", "unpaired_agg", "paired_all", "paired_agg", "percentile")


def distribution(iterated: DataFrame, kind: str, *, bin_size: float | None = None, bins: int = 50, how: str = "AVERAGE") -> DataFrame:
    """Histogram with shares, by one of DISTRIBUTIONS: ``series, x, n, share``.

    Unpaired kinds show actual scores (series ``actual``) beside simulated ones, all or their
    aggregate ``how`` of each feature; paired kinds show a feature's actual score less each
    simulation's, or less their aggregate; ``percentile`` shows the rounded mid-rank of the
    actual score among the feature's simulations.  Values are rounded half to even to
    multiples of ``bin_size``, by default a ``bins``-th of their range (1 without a range)."""
    actual = F.max(F.when(F.col("iteration") == -1, F.col("score")))
    simulated = F.col("iteration") >= 0
    if kind in ("unpaired_all", "unpaired_agg"):
        own = iterated.where("iteration = -1").select(F.lit("actual").alias("series"), F.col("score").alias("v"))
        sims = iterated.where(simulated)
        sims = sims.select("score") if kind == "unpaired_all" else sims.groupBy("id").agg(FEATURE_AGGREGATES[how]("score").alias("score"))
        rows = own.unionByName(sims.select(F.lit("simulated").alias("series"), F.col("score").alias("v")))
    elif kind == "paired_all":
        with_actual = iterated.withColumn("actual", actual.over(Window.partitionBy("id"))).where(simulated)
        rows = with_actual.select(F.lit("delta").alias("series"), (F.col("actual") - F.col("score")).alias("v"))
    elif kind == "paired_agg":
        per = iterated.groupBy("id").agg(actual.alias("actual"), FEATURE_AGGREGATES[how](F.when(simulated, F.col("score"))).alias("sim"))
        rows = per.select(F.lit("delta").alias("series"), (F.col("actual") - F.col("sim")).alias("v"))
    elif kind == "percentile":
        rows = feature_quantile(iterated.where("score is not null")).where("actual is not null")
        rows = rows.select(F.lit("percentile").alias("series"), F.bround(F.col("quantile") * 100).alias("v"))
    else:
        raise ValueError(f"unknown distribution {kind}")
    rows = rows.where("v is not null")
    if bin_size is None:
        width = rows.agg(((F.max("v") - F.min("v")) / bins).alias("w")).select(F.when(F.col("w") > 0, F.col("w")).otherwise(1.0).alias("w"))
        rows = rows.crossJoin(F.broadcast(width))  # one row
    else:
        rows = rows.withColumn("w", F.lit(bin_size))
    hist = rows.groupBy("series", (F.bround(F.col("v") / F.col("w")) * F.col("w")).alias("x")).agg(F.count("*").alias("n"))
    return hist.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("series")))  # as many rows as bins


def relate(df: DataFrame, x: str, y: str, bin_size: float) -> DataFrame:
    """Mean, median and 5 and 95 % quantiles of ``y`` in bins of ``x``."""
    q = F.percentile(y, [0.05, 0.95])
    return df.groupBy((F.bround(F.col(x) / bin_size) * bin_size).alias("x")).agg(
        F.count("*").alias("n"), F.avg(y).alias("mean"), F.median(y).alias("median"), q[0].alias("q05"), q[1].alias("q95")
    )


def relate_iterations(df: DataFrame, x: str, y: str, bin_size: float) -> DataFrame:
    """By bins of ``x``, over iterations: the mean of their means, and median and 5 and 95 % quantiles of their medians."""
    each = df.where("iteration >= 0").groupBy((F.bround(F.col(x) / bin_size) * bin_size).alias("x"), "iteration").agg(
        F.avg(y).alias("mean"), F.median(y).alias("median")
    )
    q = F.percentile("median", [0.05, 0.95])
    return each.groupBy("x").agg(
        F.avg("mean").alias("mean_mean"), F.median("median").alias("median_median"), q[0].alias("median_q05"), q[1].alias("median_q95")
    )


def cdf_points(iterated: DataFrame) -> DataFrame:
    """Empirical distribution of each feature's simulations: ``id, score, share, mid``."""
    w = Window.partitionBy("id").orderBy("score")
    n = F.count("*").over(Window.partitionBy("id"))
    ties = F.count("*").over(Window.partitionBy("id", "score"))
    sims = iterated.where("iteration >= 0")
    return sims.select("id", "score", F.cume_dist().over(w).alias("share"), ((F.rank().over(w) - 1 + ties / 2) / n).alias("mid")).distinct()


def normality(iterated: DataFrame, most: int = 1000) -> DataFrame:
    """Shapiro-Wilk p of each feature's simulations, raw and log10, of at most ``most`` values by hash (the feature's own limit)."""
    import pandas as pd

    w = Window.partitionBy("id").orderBy(F.xxhash64("iteration"))
    some = iterated.where("iteration >= 0").withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most).select("id", "score")

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["score"].dropna().to_numpy()
        logs = np.log10(v[v > 0])
        return pd.DataFrame({"id": pdf["id"].iloc[:1], "n": [len(v)], "p": [tails.shapiro_wilk(v)[1]], "p_log": [tails.shapiro_wilk(logs)[1]]})

    kind = iterated.schema["id"].dataType.simpleString()
    return some.groupBy("id").applyInPandas(test, f"id {kind}, n long, p double, p_log double")
