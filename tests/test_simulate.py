import inspect
import os
import random

import pytest
from pyspark.sql import functions as F

from spanloom import catalog
from spanloom.operators import simulate as M
from spanloom.operators.reshape import crosstab, uncrosstab
from spanloom.sources.folders import stored

FEATURES = [("f%d" % i, "c1" if i % 2 else "c2", i * 50, i * 50 + 5 + i, 1.0, "+") for i in range(12)]

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(DATA), reason="driver tables are absent")


@pytest.fixture(scope="module")
def world(spark):
    f = spark.createDataFrame(FEATURES, "id string, chrom string, start long, end long, score double, strand string")
    chroms = spark.createDataFrame([("c1", 2000, 2), ("c2", 1500, 1)], "chrom string, size long, copies int")
    ex = spark.createDataFrame([("c1", 100, 900, "x", 0.0, "+")], "chrom string, start long, end long, name string, score double, strand string")
    return f, chroms, ex


def test_permutations_keep_lengths_and_rules(world):
    f, chroms, ex = world
    got = M.permute(f, chroms, iterations=6, seed=4, exclusions=ex, offset_control=7).collect()
    lengths = sorted(x[3] - x[2] for x in FEATURES)
    for i in range(-2, 6):
        own = [r for r in got if r["iteration"] == i]
        assert sorted(r["end"] - r["start"] for r in own) == lengths
        if i >= 0:
            assert all(r["end"] <= (2000 if r["chrom"] == "c1" else 1500) for r in own)
            assert not any(r["chrom"] == "c1" and r["start"] < 900 and r["end"] > 100 for r in own)
            places = sorted((r["chrom"], r["start"], r["end"]) for r in own)
            assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(places, places[1:]))


def test_seed_decides_whatever_the_partitions(world):
    f, chroms, _ = world
    a = sorted(map(tuple, M.permute(f, chroms, iterations=4, seed=9).collect()))
    b = sorted(map(tuple, M.permute(f.repartition(7), chroms, iterations=4, seed=9).collect()))
    assert a == b != sorted(map(tuple, M.permute(f, chroms, iterations=4, seed=10).collect()))


def test_no_room_is_an_error(world):
    f, chroms, _ = world
    with pytest.raises(Exception, match="found no place"):
        M.permute(f, chroms.withColumn("size", F.lit(30).cast("long")), iterations=1, max_attempts=50).collect()


def test_hotspot_finds_the_planted_cluster(spark, world):
    _, chroms, _ = world
    rows = [("h%d" % i, "c1", 500 + i, 510 + i, 1.0, "+") for i in range(5)] + [("l%d" % i, "c2", 100 * i, 100 * i + 5, 1.0, "+") for i in range(5)]
    f = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string").withColumn("name", F.col("id"))
    first = M.hotspot(f, chroms, iterations=5, seed=2, rounds=2).where("round = 0").first()
    assert (first["n_features"], first["cluster_size"], first["n_clusters"]) == (10, 5, 1)
    assert first["share"][0] <= 0.2


def test_crosstab_round_trip(spark):
    long = spark.createDataFrame([(i, k, float(i * 10 + k)) for i in range(4) for k in range(-1, 3)], "id int, iteration int, score double")
    wide = crosstab(long, [-1, 0, 1, 2])
    assert sorted(map(tuple, uncrosstab(wide, [-1, 0, 1, 2]).collect())) == sorted(map(tuple, long.collect()))
    with pytest.raises(Exception, match="missing or repeated"):
        crosstab(long.where("not (id = 2 and iteration = 1)"), [-1, 0, 1, 2]).collect()


@needs_tables
def test_registered_simulations_take_every_feature(spark):
    n = spark.read.parquet(f"{DATA}/events.parquet").where("event_id % 3 != 0").count()
    assert catalog.QUERIES["simulate"](spark, DATA).count() == n
    placed = catalog.QUERIES["permute"](spark, DATA).groupBy("iteration").agg(F.countDistinct("id").alias("n")).collect()
    assert {r["iteration"]: r["n"] for r in placed} == {i: n for i in range(-2, 10)}


def test_hotspot_goes_on_until_no_cluster_is_left(spark, world):
    _, chroms, _ = world
    rows = [(f"n{n}.{i}", "c1", 100 * n + i, 100 * n + i + 20, 1.0, "+") for n in range(1, 6) for i in range(n)]
    f = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string").withColumn("name", F.col("id"))
    got = M.hotspot(f, chroms, iterations=3, seed=2).orderBy("round").collect()
    assert [(r["n_features"], r["cluster_size"], r["n_clusters"]) for r in got] == [(15, 5, 1), (10, 4, 1), (6, 3, 1), (3, 2, 1), (1, 1, 1)]
    assert inspect.signature(M.hotspot).parameters["rounds"].default is None  # no silent last round
    assert got[-1]["share"] == [1.0] and all(len(r["share"]) == r["n_clusters"] for r in got)


@needs_tables
def test_registered_hotspot_ends_with_single_features(spark):
    got = catalog.QUERIES["hotspot"](spark, DATA).orderBy("round").collect()
    n = spark.read.parquet(f"{DATA}/events.parquet").count()
    assert got[0]["n_features"] == n == sum(r["n_clustered"] for r in got) and got[-1]["cluster_size"] == 1
    assert all(list(r["share"]) == sorted(r["share"], reverse=True) for r in got)


def test_rounds_keep_to_the_rules_on_strands_probes_and_partial_exclusions(spark):
    rows = [("same", "c1", 10, 40, 1.0, "+")] * 5 + [(f"f{i}", "c2", i, i + 1 + i % 40, 2.0, "-") for i in range(80)] + [("none", "c1", 7, 7, 0.0, "+")]
    f = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string")
    chroms = spark.createDataFrame([("c1", 3000, 1), ("c2", 1000, 1)], "chrom string, size long, copies int")
    ex = spark.createDataFrame([("c1", 0, 1500, "x", 0.0, "+")], "chrom string, start long, end long, name string, score double, strand string")
    probes = spark.createDataFrame([("c1", p) for p in range(0, 3000, 7)], "chrom string, start long")
    got = M.permute(f, chroms, iterations=3, seed=8, exclusions=ex, probes=probes, min_probes=0, stranded=True, max_excluded=0.5).where("iteration >= 0").collect()
    assert len(got) == 3 * len(rows)
    for i in range(3):
        own = [r for r in got if r["iteration"] == i]
        assert sorted((r["id"], r["end"] - r["start"]) for r in own) == sorted((x[0], x[3] - x[2]) for x in rows)
        for r in own:
            n = r["end"] - r["start"]
            assert r["chrom"] != "c1" or n == 0 or max(0, min(1500, r["end"]) - r["start"]) / n <= 0.5
        for side in "+-":
            spans = sorted((r["chrom"], r["start"], r["end"]) for r in own if r["strand"] == side and r["end"] > r["start"])
            assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    held = M.permute(f.where("id = 'same'"), chroms, iterations=2, seed=8, probes=probes, min_probes=3).where("iteration >= 0").collect()
    assert all(r["chrom"] == "c1" and sum(r["start"] <= p <= r["end"] - 1 for p in range(0, 3000, 7)) >= 3 for r in held)
    part = M.permute(f, chroms, iterations=2, seed=8, max_overlap=0.3).where("iteration >= 0").count()
    assert part == 2 * len(rows)


def test_draws_that_meet_are_found_across_cells(spark):
    """Against brute force: long draws over several cells, draws that only touch, repeated ones, and ones without length."""
    width = M.BIN
    rows = [(0, "c", i, i, "i%d" % i, 1.0, 0, s, e, "+") for i, (s, e) in enumerate([
        (0, 3 * width), (width + 5, width + 6), (3 * width, 3 * width + 9), (3 * width + 9, 3 * width + 20), (5 * width - 3, 5 * width + 3), (5 * width, 5 * width + 1),
        (7 * width, 7 * width), (7 * width - 2, 7 * width + 2), (9 * width, 9 * width + 4), (9 * width, 9 * width + 4),
    ])]
    d = spark.createDataFrame(rows, "iteration int, to_chrom string, own long, rank long, id string, score double, draw int, s long, e long, side string")
    meets = lambda a, b: a[7] < a[8] and b[7] < b[8] and a[7] < b[8] and b[7] < a[8]
    want = sorted(a[2] for a in rows if any(meets(a, b) for b in rows if b[2] != a[2]))
    assert sorted(r["own"] for r in M._meeting(d, ["iteration", "to_chrom"]).collect()) == want == [0, 1, 4, 5, 8, 9]
    placed = [(0, "c", 0, 0, "p", 1.0, 0, s, e, "+") for s, e in [(2 * width, 2 * width + 1), (3 * width + 9, 5 * width - 3), (5 * width + 1, 5 * width + 2), (7 * width + 2, 9 * width + 1)]]
    free = M._free(d, spark.createDataFrame(placed, d.schema), ["iteration", "to_chrom"]).collect()
    assert sorted(r["own"] for r in free) == sorted(a[2] for a in rows if not any(meets(a, p) for p in placed)) == [1, 2, 5, 6, 7]


def test_a_full_genome_is_filled_in_rounds(spark):
    f = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("c").alias("chrom"), F.col("id").alias("start"), (F.col("id") + 10).alias("end"), F.lit(1.0).alias("score"), F.lit("+").alias("strand"))
    chroms = spark.createDataFrame([("c", 700, 1)], "chrom string, size long, copies int")
    got = M.permute(f, chroms, iterations=1, seed=3).where("iteration = 0").orderBy("start").collect()
    assert len(got) == 40 and all(a["end"] <= b["start"] for a, b in zip(got, got[1:]))


def test_placements_are_written_about_once(spark, monkeypatch):
    """What rounds keep between jobs: each placement once, and what is left for later rounds."""
    kept = []
    for how in ("materialized", "stored"):
        f = getattr(M, how, None)
        if f is not None:
            monkeypatch.setattr(M, how, lambda d, f=f: [t := f(d), kept.append(t.count())][0])
    rows = [(str(i), f"chr{i % 3 + 1}", i * 100, i * 100 + 50 + i % 40, 0.0, "+") for i in range(300)]
    features = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string")
    chroms = spark.createDataFrame([(f"chr{i}", 400_000) for i in (1, 2, 3)], "chrom string, size long")
    placed = M.permute(features, chroms, iterations=10, seed=4, exclusions=features.where("id % 7 = 0"))
    assert placed.where("iteration >= 0").count() == 3000
    assert sum(kept) < 1.5 * 3000 + 2 * 300


def test_crowded_draws_are_told_apart_by_rank_in_long_chains(spark, monkeypatch):
    """Chains of any length give what comparing all pairs gives."""
    rng = random.Random(3)
    rows = [(0, i, "c", s, s + rng.randint(1, 90), rng.getrandbits(40)) for i in range(300) for s in [rng.randint(0, 6000)]]
    d = spark.createDataFrame(rows, "iteration int, fid long, to_chrom string, s long, e long, rank long")
    want = sorted(a[1] for a in rows if any(a[3] < b[4] and b[3] < a[4] and b[5] > a[5] for b in rows))
    for chain in (64, 3):
        monkeypatch.setattr(M, "CHAIN", chain)
        met = M._chained(M._in_cells(d, 90), ["iteration", "to_chrom"]).where("met")
        assert sorted(r["fid"] for r in M._beaten(met, ["iteration", "to_chrom"], 90).collect()) == want


def test_a_draw_is_computed_once_and_not_for_each_chromosome(spark, world):
    f, _, _ = world
    d = M.draws(f.withColumns({"iteration": F.lit(0), "own": F.col("id")}), [(f"c{i}", 100, 1) for i in range(9)], F.lit(0), 4, seed=1, stranded=False)
    assert d._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_hotspot_plans_do_not_grow_with_the_rounds(spark, world, monkeypatch):
    _, chroms, _ = world
    tables = []

    def seen(features, chroms, *, exclusions=None, _permute=M.permute, **how):
        tables.append(0 if exclusions is None else exclusions._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return _permute(features, chroms, exclusions=exclusions, **how)

    monkeypatch.setattr(M, "permute", seen)
    rows = [(f"n{n}.{i}", "c1", 100 * n + i, 100 * n + i + 20, 1.0, "+") for n in range(1, 5) for i in range(n)]
    f = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string").withColumn("name", F.col("id"))
    M.hotspot(f, chroms, iterations=2, seed=2).collect()
    assert tables == [0, 1, 1, 1]


def test_broken_rules_are_counted(spark, world):
    _, chroms, ex = world
    rows = [(0, "c2", 5, 9), (0, "c2", 8, 12), (0, "c2", 12, 20), (0, "c1", 90, 101), (0, "c1", 900, 910), (0, "c1", 1990, 2001), (1, "c2", 65530, 65540), (1, "c2", 65539, 65600)]
    placed = spark.createDataFrame(rows, "iteration int, chrom string, start long, end long")
    assert sorted(map(tuple, M.rules_kept(placed, chroms, ex).collect())) == [(0, 5, 5, 4), (1, 0, 2, 0)]


def test_simulate_shuffles_a_placement_once_to_be_counted(spark):
    """Counting takes one shuffle of the queries; placements without scores are the same."""
    from spanloom.operators.joins import crossing

    f = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("chrom"), (F.col("id") * 7919 % 900000).alias("start"), F.lit(0.5).alias("score"), F.lit("+").alias("strand"))
    f = f.withColumn("end", F.col("start") + 1 + F.col("id").cast("long") % 500)
    refs = f.where("cast(id as long) % 3 = 0")
    chroms = spark.createDataFrame([("a", 3_000_000)], "chrom string, size long")
    own, bare = (M.permute(f, chroms, iterations=2, seed=3, scored=x).drop("score") for x in (True, False))
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, bare.collect()))
    got = crossing(f, refs, "COUNT")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    rows, others = f.collect(), [(r.start, r.end) for r in refs.collect()]
    want = {r.id: sum(a <= r.end and b >= r.start for a, b in others) for r in rows}
    assert {r.id: r.cross_score for r in got.collect()} == want


def test_first_round_is_read_once_for_its_places(spark, monkeypatch):
    """Rows that come twice or hold nulls keep their places and columns, and places are read from a round's table in one scan."""
    tables = []

    def noted(df):
        tables.append(stored(df))
        return tables[-1]

    monkeypatch.setattr(M, "stored", noted)
    rows = [(str(i % 60), "c1", 10 * i, 10 * i + 5 + i % 9, None if i % 7 == 0 else float(i), None if i % 11 == 0 else "+") for i in range(90)] + [(None, "c2", 0, 8, 1.0, "-")] * 2
    f = spark.createDataFrame(rows, "id string, chrom string, start long, end long, score double, strand string")
    shut = spark.createDataFrame([("c1", 100, 900), ("c2", 0, 50)], "chrom string, start long, end long")
    placed = M.permute(f, spark.createDataFrame([("c1", 3000), ("c2", 1500)], "chrom string, size long"), iterations=3, seed=4, exclusions=shut)
    got = placed.collect()
    for i in range(-1, 3):
        assert sorted(map(repr, ((r["id"], r["score"], r["strand"], r["end"] - r["start"]) for r in got if r["iteration"] == i))) == sorted(map(repr, ((x[0], x[4], x[5], x[3] - x[2]) for x in rows)))
    taken = sorted((r["iteration"], r["chrom"], r["start"], r["end"]) for r in got if r["iteration"] >= 0)
    assert all(a[:2] != b[:2] or a[3] <= b[2] for a, b in zip(taken, taken[1:]))
    assert not any(c == "c1" and s < 900 and e > 100 or c == "c2" and s < 50 for _, c, s, e in taken)
    first = next(t for t in tables if {"cell", "met", "taken"} <= {*t.columns})
    assert first.where("met").count() and first.where("taken").count()
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = placed.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert plan.count(first.inputFiles()[0].rsplit("/", 2)[1]) == 1
