"""All scores of crossing against pairs, and their cost where references pile up."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import joins as X
from spanloom.operators import varbin as B

PAIRED = ["COUNT", "COUNT_ENDS", "WEIGHTED", "WEIGHTED2", "MAX_REF_LENGTH", "MAX_REF_SCORE"]
MERGED = ["LENGTH", "FRACTION", "BOOLEAN", "BOOLEAN_ENDS"]


def places(seed, n, span=300, lengths=(0, 1, 2, 3, 7, 20, 90)):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.randrange(span)
        out.append((r.choice("ab"), s, s + r.choice(lengths), str(i), r.choice([r.random() * 9, -r.random(), 0.0, 1e7 * r.random()]), r.choice("+-")))
    return out


def merged(refs):
    out = []
    for c, s, e, *_, k in sorted(refs, key=lambda x: (x[0], x[-1], x[1])):
        if out and out[-1][0] == c and out[-1][-1] == k and s <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([c, s, e, "", 0.0, k])
    return out


def div(a, b):
    return int(a / b)


def score(kind, q, refs, touch, width, pad):
    s, e = q[1] - pad, q[2] + pad
    if s == e:
        return None
    hits = [(r[1], r[2], r[4]) for r in refs if r[0] == q[0] and r[5] == q[5] and (r[1] <= e and r[2] >= s if touch else r[1] < e and r[2] > s)]
    if width:
        hits = [h for h in hits if div(h[0], width) <= div(e - 1, width) and div(h[1] - 1, width) >= div(s, width) and div(h[0], width) <= div(h[1] - 1, width)]
    if not hits:
        return None
    overlap = [min(e, b) - max(s, a) for a, b, _ in hits]
    ends = sum(a <= s <= b or a <= e <= b for a, b, _ in hits)
    part = sum(overlap) / (e - s)
    weighted = sum(o / (e - s) * h[2] for o, h in zip(overlap, hits))
    return {
        "COUNT": len(hits), "COUNT_ENDS": ends, "LENGTH": sum(overlap), "FRACTION": part, "BOOLEAN": part >= 1 / (e - s), "BOOLEAN_ENDS": ends > 0,
        "WEIGHTED": weighted, "WEIGHTED2": weighted / part if part else None, "MAX_REF_LENGTH": max(b - a for a, b, _ in hits), "MAX_REF_SCORE": max(h[2] for h in hits),
    }[kind]


@pytest.mark.parametrize("touch,compat,pad", [(True, False, 0), (False, False, 0), (True, True, 0), (True, False, 5), (True, True, 5)])
def test_scores_equal_pairs(bed, touch, compat, pad):
    q, r = places(1, 90), places(2, 130)
    qs, rs = bed(q).cache(), bed(r).cache()
    for kind in PAIRED + MERGED:
        refs = [(c, s - pad, e + pad, n, v, k) for c, s, e, n, v, k in r]
        if kind in MERGED:
            refs = merged(refs)
        width = max(int(max(x[2] for x in refs) / 100), int(2 * sum(x[2] - x[1] for x in refs) / len(refs)), 1) if compat else 0
        got = {x["name"]: x["cross_score"] for x in X.crossing(qs, rs, kind, stranded=True, touch=touch, compat=compat, padding=pad, max_null=-7.0).collect()}
        for x in q:
            want = score(kind, x, refs, touch, width, pad)
            want = want if want is not None else 0.0 if kind in X.ZERO_DEFAULT else -7.0
            assert got[x[3]] == pytest.approx(float(want), rel=1e-9, abs=1e-9), (kind, x)


@pytest.mark.parametrize("kind", ["COUNT", "COUNT_ENDS", "WEIGHTED2", "MAX_REF_LENGTH", "BOOLEAN_ENDS"])
def test_a_pile_up_of_references_is_linear(spark, kind):
    """A hundred thousand different references at one place, and as many queries: pairs would be ten thousand million."""
    n = 100_000
    at = lambda k: spark.range(n).select(F.lit("c").alias("chrom"), (F.lit(k) - F.col("id")).alias("start"), (F.lit(k + 1) + F.col("id") % 1000).alias("end"), F.lit("x").alias("name"), F.lit(1.0).alias("score"), F.lit("+").alias("strand"))
    got = X.crossing(at(500_000), at(500_000), kind).agg(F.count("*"), F.min("cross_score"), F.max("cross_score")).first()
    assert got[0] == n and got[2] >= got[1]
    if kind == "COUNT":
        assert got[1] == got[2] == n
    if kind == "MAX_REF_LENGTH":
        assert got[1] == got[2] == n - 1 + 1 + (n - 1) % 1000


def test_cells_make_up_their_span(spark):
    r = random.Random(3)
    spans = [(a, a + r.choice([0, 1, 5, 16, 63, 200, 5000])) for a in (r.randrange(-300, 5000) for _ in range(150))]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i long, a long, b long")
    for levels in (0, 2, 7):
        cells = {}
        for x in df.select("i", X._cover("a", "b", levels).alias("c")).select("i", "c.*").collect():
            cells.setdefault(x.i, []).extend(range(x.cell << 2 * x.level, (x.cell + 1) << 2 * x.level))
            assert x.level <= levels
        assert all(sorted(cells[i]) == list(range(a, b + 1)) for i, (a, b) in enumerate(spans))


def test_gaps_and_weights_read_lines(spark):
    bins = spark.createDataFrame([("c", k, 10 * k, 10 * k + 9) for k in range(6)], "chrom string, bin long, start long, end long")
    gaps = spark.createDataFrame([("c", 5, 25), ("c", 58, 90), ("d", 0, 9)], "chrom string, start long, end long")
    assert [x.no_gap_len for x in B.correct_for_gaps(bins, gaps).orderBy("bin").collect()] == [5, 0, 5, 10, 10, 8]
    breaks = spark.createDataFrame([("s", "c", 3, 2), ("s", "c", 12, -1), ("s", "c", 40, -1), ("t", "c", 0, 1), ("t", "c", 60, -1)], "sample string, chrom string, pos long, delta int")
    lengths = spark.createDataFrame([("s", 2.0), ("t", 10.0)], "sample string, avg_len double")
    got = {(x.sample, x.bin): x.raw for x in B.bin_weights(breaks, bins, lengths).collect()}
    assert got == {("s", 0): 7.0, ("s", 1): 6.0, ("s", 2): 5.0, ("s", 3): 5.0} | {("t", k): 1.0 for k in range(6)}


def test_a_query_of_one_base_does_not_cross_what_starts_behind_it(bed):
    got = X.crossing(bed([("c", 5, 6, "q", 1.0, "+")]), bed([("c", 6, 9, "r", 4.0, "+")]), "MAX_REF_SCORE", touch=False, max_null=-1.0)
    assert got.first()["cross_score"] == -1.0


def test_count_ends_makes_its_cells_once(spark):
    """References inside are counted at short and long levels of cells; the places' cells are made, and read, once."""
    r = np.random.default_rng(17)
    rows = lambda n: [("a", int(s), int(s + e), "x", 0.0, "+") for s, e in zip(r.integers(0, 900_000, n), 1 + 2 ** r.uniform(0, 19, n))]
    queries, refs = rows(300), rows(400)
    frame = lambda x: spark.createDataFrame(x, "chrom string, start long, end long, name string, score double, strand string")
    got = X.crossing(frame(queries), frame(refs), "COUNT_ENDS")
    want = sorted((s, e, float(sum(a <= e and b >= s and (a <= s <= b or a <= e <= b) for _, a, b, *_ in refs))) for _, s, e, *_ in queries)
    assert sorted((x.start, x.end, x.cross_score) for x in got.collect()) == want
    short = X.crossing(frame(queries).where("end - start < 60000"), frame(refs), "COUNT_ENDS")
    assert short._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") <= 5
