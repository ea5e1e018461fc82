"""The steps of hotspot's rounds against plainer forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import intervals as I
from spanloom.operators import simulate as M

BED = "id string, chrom string, start long, end long, name string, score double, strand string"


def features(spark, n, size, longest, seed):
    r = np.random.default_rng(seed)
    rows = [(f"f{i}", "ab"[i % 2], int(s), int(s + m), f"f{i}", 1.0, "+") for i, (s, m) in enumerate(zip(r.integers(0, size, n), r.integers(0, longest + 1, n)))]
    return spark.createDataFrame(rows, BED)


@pytest.mark.parametrize("bin_size,longest", [(64, 30), (64, 200), (1 << 16, 30)])
def test_regions_equal_collapse(spark, bin_size, longest):
    f = features(spark, 700, 9000, longest, bin_size + longest)
    merged = I.collapse(f, names=False)
    want = sorted((r["chrom"], r["start"], r["end"], r["n"]) for r in merged.collect())
    members, regions = I.in_regions(f, bin_size=bin_size)
    assert sorted((r["chrom"], r["start"], r["end"], r["n"]) for r in regions.collect()) == want
    got = {r["id"]: r["n"] for r in members.collect()}
    assert len(got) == 700
    for r in f.collect():
        assert got[r["id"]] == next(n for c, s, e, n in want if c == r["chrom"] and s <= r["start"] and r["end"] <= e)
    for least in (1, 2, 4):
        some = I.region_counts(f, ["chrom"], least=least, longest=longest, bin_size=bin_size).collect()
        assert sorted((r["chrom"], r["n"]) for r in some) == sorted((c, n) for c, _, _, n in want if n >= least)


def test_few_exclusions_are_met_without_a_shuffle(spark):
    f = features(spark, 2000, 300_000, 90, 3)
    d = f.select("id", F.col("chrom").alias("to_chrom"), F.col("start").alias("s"), F.col("end").alias("e"))
    shut = features(spark, 40, 300_000, 3000, 4).select(F.col("chrom").alias("to_chrom"), F.col("start").alias("s"), F.col("end").alias("e"))
    few = M._few(shut, 90)
    free = M._by_few(d, few, "left_anti")
    assert "Exchange hashpartitioning(to_chrom" not in free._jdf.queryExecution().executedPlan().toString()
    clear = {r["id"] for r in free.collect()}
    assert clear == {r["id"] for r in M._free(d, shut, ["to_chrom"], 90).collect()}
    assert {r["id"] for r in M._by_few(d, few, "left_semi").collect()} == {f"f{i}" for i in range(2000)} - clear and 0 < len(clear) < 2000
    assert M._few(shut.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(M.CHAIN)))).drop("i"), 90) is None  # a crowded cell


def test_first_draws_are_compiled_and_all_forms_agree(spark):
    f = features(spark, 200, 5000, 50, 5).withColumns({"own": F.col("id"), "iteration": F.lit(0)})
    parts = [(f"c{i}", 100 + i, 1 + i % 2) for i in range(70)]
    for chroms in (parts[:5], parts):
        one = M.draws(f, chroms, F.lit(0), 1, seed=1, stranded=False)
        four = M.draws(f, chroms, F.lit(0), 4, seed=1, stranded=False).where("draw = 0")
        rows = lambda d: sorted((r["id"], r["to_chrom"], r["s"], r["e"]) for r in d.collect())
        assert rows(one) == rows(four)
    plan = M.draws(f, parts[:5], F.lit(0), 1, seed=1, stranded=False)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan


def test_hotspot_equals_rounds_of_collapse_and_permute(spark):
    f = features(spark, 900, 60_000, 25, 6)
    chroms = spark.createDataFrame([("a", 64_000, 1), ("b", 64_000, 1)], "chrom string, size long, copies int")
    got = M.hotspot(f, chroms, iterations=4, seed=9).orderBy("round").collect()
    left, shut = f, None
    for row in got:
        c = I.collapse(left, names=False)
        most = c.agg(F.max("n")).first()[0]
        k = c.where(F.col("n") == most).count()
        assert (row["n_features"], row["cluster_size"], row["n_clusters"], row["n_clustered"]) == (left.count(), most, k, most * k)
        sims = M.permute(left, chroms, iterations=4, seed=9 + row["round"], exclusions=shut, max_overlap=1.0).where("iteration >= 0").collect()
        held = []
        for i in range(4):
            own = spark.createDataFrame([(r["id"], r["chrom"], r["start"], r["end"], r["id"], 0.0, "+") for r in sims if r["iteration"] == i], BED)
            held.append(I.collapse(own, names=False).where(F.col("n") >= most).agg(F.sum("n")).first()[0] or 0)
        assert row["share"] == [sum(h >= most * j for h in held) / 4 for j in range(1, k + 1)]
        mine = c.where(F.col("n") == most).select("chrom", "start", "end").localCheckpoint()
        left = still_left(left, mine)
        shut = mine if shut is None else shut.unionByName(mine)
    assert left.count() == 0


def still_left(left, mine):
    from spanloom.operators.joins import outside

    return outside(left, mine).localCheckpoint()
