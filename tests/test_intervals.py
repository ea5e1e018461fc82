"""Goldens derived from the documented rules, and properties."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import intervals as I
from spanloom.operators import joins as X

SAMPLE = [
    ("chr1", 0, 5000, "z", 1.0, "+"), ("chr1", 10000, 20000, "a", 2.0, "+"), ("chr1", 15000, 25000, "b", 3.0, "-"), ("chr1", 17000, 18000, "x", 4.0, "+"),
    ("chr1", 30000, 40000, "c", 5.0, "+"), ("chr1", 50000, 55000, "d", 6.0, "+"), ("chr1", 50000, 60000, "e", 7.0, "-"),
]


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def random_features(n=300, seed=5, chroms=2, span=5000, longest=120):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.randrange(span)
        out.append((f"chr{r.randrange(chroms)}", s, s + 1 + r.randrange(longest), str(i), float(r.randrange(1, 50)), r.choice("+-")))
    return out


def test_collapse_golden(bed):
    got = rows(I.collapse(bed(SAMPLE)), "start", "end", "n", "name")
    assert got == [(0, 5000, 1, "z"), (10000, 25000, 3, "a::b::x"), (30000, 40000, 1, "c"), (50000, 60000, 2, "d::e")]


def test_touching_regions_merge_and_empty_names_are_replaced(bed):
    got = rows(I.collapse(bed([("c", 0, 5, "", 0.0, "+"), ("c", 5, 9, "0", 0.0, "-")])), "start", "end", "name")
    assert got == [(0, 9, "c:0-5[.]::c:5-9[.]")]


@pytest.mark.parametrize("bin_size", [64, 1 << 20])
def test_collapse_is_idempotent_and_covers_the_same(bed, bin_size):
    f = random_features()
    once = I.collapse(bed(f), names=False, bin_size=bin_size)
    twice = I.collapse(once, names=False)
    assert rows(once, "chrom", "start", "end") == rows(twice, "chrom", "start", "end")
    covered = {(c, p) for c, s, e, *_ in f for p in range(s, e)}
    assert sum(e - s for _, s, e in rows(once, "chrom", "start", "end")) == len(covered)


def test_split_golden(bed):
    got = rows(I.split(bed(SAMPLE)), "start", "end", "name")
    assert len(got) == 14
    assert [g for g in got if g[0] == 17000] == [(17000, 18000, n) for n in ("a", "b", "x")]


@pytest.mark.parametrize("bin_size, cell", [(64, 32), (1 << 20, 1 << 14)])
def test_split_keeps_length(bed, bin_size, cell):
    f = random_features(seed=6)
    got = I.split(bed(f), bin_size=bin_size, cell=cell).groupBy("name").agg(F.sum(F.col("end") - F.col("start")).alias("n"))
    assert dict(map(tuple, got.collect())) == {name: e - s for _, s, e, name, _, _ in f}


@pytest.mark.parametrize("bin_size", [50, 1 << 20])
def test_depth_sums_to_length(bed, bin_size):
    f = random_features(seed=7)
    d = I.depth(bed(f), bin_size=bin_size)
    assert d.agg(F.sum((F.col("end") - F.col("start")) * F.col("depth"))).first()[0] == sum(e - s for _, s, e, *_ in f)


def test_complement_fills_the_chromosome(spark, bed):
    sizes = spark.createDataFrame([("chr1", 70000), ("chr2", 100)], "chrom string, size long")
    got = rows(I.complement(bed(SAMPLE), sizes), "chrom", "start", "end")
    assert got == [("chr1", 5000, 10000), ("chr1", 25000, 30000), ("chr1", 40000, 50000), ("chr1", 60000, 70000), ("chr2", 0, 100)]


def test_group_modes(bed):
    f = bed([("c", 0, 9, n, s, "+") for n, s in (("b", 1.0), ("a", 3.0), ("GAP", 50.0))])
    assert rows(I.group(f, "SUM", ignore_name="GAP"), "name", "score") == [("a::b", 4.0)]
    assert rows(I.group(f, "MEDIAN"), "score") == [(3.0,)]
    assert rows(I.group(f, "SUM", compat=True), "name", "score") == [("", 0.0)]


def brute(q, r, touch):
    return {i: [y for y in r if y[0] == x[0] and (y[1] <= x[2] and y[2] >= x[1] if touch else y[1] < x[2] and y[2] > x[1])] for i, x in enumerate(q)}


@pytest.mark.parametrize("touch", [True, False])
def test_crossing_equals_brute_force(bed, touch):
    q, r = random_features(120, 8), random_features(150, 9)
    q = [(*x[:3], str(i), *x[4:]) for i, x in enumerate(q)]
    got = X.crossing(bed(q), bed(r), "COUNT", touch=touch)
    want = {str(i): float(len(h)) for i, h in brute(q, r, touch).items()}
    assert {x["name"]: x["cross_score"] for x in got.collect()} == want
    far = X.crossing(bed(q), bed(r), "DISTANCE_EDGE")
    want = {str(i): float(min(max(0, y[1] - x[2], x[1] - y[2]) for y in r if y[0] == x[0])) for i, x in enumerate(q)}
    assert {x["name"]: x["cross_score"] for x in far.collect()} == want


def test_crossing_without_references_gives_defaults(bed):
    q = bed([("c", 1, 5, "a", 1.0, "+")])
    none = bed([])
    assert X.crossing(q, none, "COUNT").first()["cross_score"] == 0.0
    assert X.crossing(q, none, "MAX_REF_SCORE").first()["cross_score"] is None
    assert X.crossing(q, none, "DISTANCE_EDGE", max_null=-1.0).first()["cross_score"] == -1.0


def test_touching_needs_a_shared_search_bin_in_compat(bed):
    q, r = bed([("c", 0, 100, "a", 1.0, "+")]), bed([("c", 100, 200, "r", 1.0, "+"), ("c", 9000, 10000, "s", 1.0, "+")])
    assert X.search_bin(r) == 1100
    assert X.crossing(q, r, "COUNT", compat=True).first()["cross_score"] == 1.0
    wide = bed([("c", 1100, 1101, "r", 1.0, "+"), ("c", 109999, 110000, "s", 1.0, "+")])
    assert X.search_bin(wide) == 1100
    at_edge = bed([("c", 1000, 1100, "a", 1.0, "+")])
    assert X.crossing(at_edge, wide, "COUNT").first()["cross_score"] == 1.0
    assert X.crossing(at_edge, wide, "COUNT", compat=True).first()["cross_score"] == 0.0


def test_split_pieces_are_grouped_where_they_were_cut(spark, bed):
    """Pieces of crowded features take no shuffle of their own, and the cell changes no result."""
    from spanloom.operators import intervals as I

    d = bed([("c", i * 3 % 500, i * 3 % 500 + 40 + i % 50, str(i), 1.0, "+") for i in range(300)])
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(I.group(I.split(d, cells=True), "SUM")) == shuffles(I.split(d, cells=True))
    assert sorted(I.group(I.split(d, cells=True), "SUM").collect()) == sorted(I.group(I.split(d, cell=1 << 14), "SUM").collect())
