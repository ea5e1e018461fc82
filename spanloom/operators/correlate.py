"""Correlation and regression of two scores, from one-pass sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def align_samples(features: DataFrame, a: str, b: str, *, stranded: bool = False) -> DataFrame:
    """Full outer alignment of samples ``a`` and ``b`` (feature names) by place: ``chrom, start, end, x, y, has_x, has_y``.

    A missing score is 0.  More than one row of a sample at a place is an error."""
    key = F.col("strand") if stranded else F.lit(".")
    of = lambda n: F.when(F.col("name") == n, F.col("score"))
    hits = lambda n: F.sum((F.col("name") == n).cast("int"))
    out = features.where(F.col("name").isin(a, b)).groupBy("chrom", "start", "end", key.alias("key")).agg(
        F.max(of(a)).alias("x"), F.max(of(b)).alias("y"), hits(a).alias("nx"), hits(b).alias("ny")
    )
    bad = (F.col("nx") > 1) | (F.col("ny") > 1)
    return out.select(
        "chrom", F.when(bad, F.raise_error(F.lit("repeated feature of a sample")).cast("long")).otherwise(F.col("start")).alias("start"), "end",
        F.coalesce("x", F.lit(0.0)).alias("x"), F.coalesce("y", F.lit(0.0)).alias("y"), (F.col("nx") > 0).alias("has_x"), (F.col("ny") > 0).alias("has_y"),
    )


def pearson(aligned: DataFrame, *, weighted: bool = False, compat: bool = False) -> DataFrame:
    """``n, weight, mean_x, mean_y, sd_x, sd_y, cov, r``; weights are lengths or 1.

    Variances and covariance divide by the sum of weights less one.  With ``compat`` the
    standard deviations leave out places where the sample has no feature."""
    w = (F.col("end") - F.col("start")).cast("double") if weighted else F.lit(1.0)
    rows = aligned.withColumn("w", w)
    sx, sy = (F.col("has_x"), F.col("has_y")) if compat else (F.lit(True), F.lit(True))
    s = rows.agg(
        F.count("*").alias("n"), F.sum("w").alias("total_w"),
        (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean_x"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("mean_y"),
    )
    # a second pass about the means: sums of squares of large scores lose digits
    dev = rows.crossJoin(F.broadcast(s))
    dx, dy = F.col("x") - F.col("mean_x"), F.col("y") - F.col("mean_y")
    out = dev.agg(
        F.first("n").alias("n"), F.first("total_w").alias("weight"), F.first("mean_x").alias("mean_x"), F.first("mean_y").alias("mean_y"),
        F.sqrt(F.sum(F.when(sx, F.col("w") * dx * dx)) / (F.first("total_w") - 1)).alias("sd_x"),
        F.sqrt(F.sum(F.when(sy, F.col("w") * dy * dy)) / (F.first("total_w") - 1)).alias("sd_y"),
        (F.sum(F.col("w") * dx * dy) / (F.first("total_w") - 1)).alias("cov"),
    )
    return out.withColumn("r", F.col("cov") / (F.col("sd_x") * F.col("sd_y")))


def ranked_values(df: DataFrame, score: str, runs: int = 64) -> DataFrame:
    """Distinct values with their counts, and how many rows stand before and in all: ``score, ties, before, total``.

    Values are cut into ``runs`` ranges; what stands before a range is a sum over ranges, so
    no task sorts all values."""
    counts = df.groupBy(score).agg(F.count("*").alias("ties"))
    cut = counts.agg(F.percentile_approx(score, [i / runs for i in range(1, runs)], 1000).alias("cuts"))
    ranged = counts.crossJoin(F.broadcast(cut)).withColumn("range", F.size(F.filter("cuts", lambda c: c < F.col(score)))).drop("cuts")
    w = Window.orderBy("range")  # one row for each of at most ``runs`` ranges
    sums = ranged.groupBy("range").agg(F.sum("ties").alias("in_range"))
    sums = sums.select("range", (F.sum("in_range").over(w) - F.col("in_range")).alias("base"), F.sum("in_range").over(Window.partitionBy()).alias("total"))
    own = Window.partitionBy("range").orderBy(score)
    before = F.col("base") + F.sum("ties").over(own) - F.col("ties")
    return ranged.join(F.broadcast(sums), "range").select(score, "ties", before.alias("before"), "total")


def average_ranks(df: DataFrame, score: str, rank: str) -> DataFrame:
    """Add the mean rank of ties."""
    ranks = ranked_values(df, score).select(score, (F.col("before") + (F.col("ties") + 1) / 2).alias(rank))
    return df.join(ranks, score)


def spearman(aligned: DataFrame) -> DataFrame:
    """Unweighted correlation of average ranks: ``n, r``."""
    ranked = average_ranks(average_ranks(aligned.select("x", "y"), "x", "rx"), "y", "ry")
    return ranked.agg(F.count("*").alias("n"), F.corr("rx", "ry").alias("r"))


def regression(df: DataFrame, x: str, y: str, *, cap_x: float = 0.0, cap_y: float = 0.0) -> DataFrame:
    """Least squares of ``y`` on ``x`` with standard errors: scores are cut at caps that are not 0."""
    cut = lambda c, cap: F.least(F.col(c), F.lit(cap)) if cap else F.col(c)
    d = df.select(cut(x, cap_x).alias("x"), cut(y, cap_y).alias("y"))
    s = d.agg(
        F.regr_count("y", "x").alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"), F.regr_sxx("y", "x").alias("sxx"), F.regr_syy("y", "x").alias("syy"), F.regr_avgx("y", "x").alias("mx"),
    )
    var = F.col("syy") * (1 - F.col("r2")) / (F.col("n") - 2)
    return s.select(
        "n", "slope", "intercept", "r2", F.sqrt(var / F.col("sxx")).alias("slope_se"),
        F.sqrt(var * (1 / F.col("n") + F.col("mx") * F.col("mx") / F.col("sxx"))).alias("intercept_se"),
    )
