"""Forms that must stay linear, and kernels against step-by-step versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanloom.functions import tails as T
from spanloom.operators import coverage as V
from spanloom.operators import genome as G
from spanloom.operators import intervals as I
from spanloom.operators import jobs as J
from spanloom.operators import scores as S
from spanloom.operators import simulate as M
from spanloom.operators import varbin as B
from spanloom.sources.folders import set_checkpoint_folder


def test_many_fragments_of_one_sequence(spark):
    n = 100_000
    seq = spark.range(1).select(F.lit("c").alias("chrom"), F.repeat(F.lit("AAGATC"), n).alias("seq"))
    got = G.split_sequences(seq, "GATC").agg(F.count("*").alias("n"), F.max("end").alias("end"), F.count_if(F.col("start") % 6 != 0).alias("odd")).first()
    assert tuple(got) == (n, 6 * n, 0)
    hits = G.find_features(seq, spark.range(1).select(F.lit("c").alias("chrom"), F.lit("x").alias("name"), F.lit("gatc").alias("text")))
    assert tuple(hits.agg(F.count("*"), F.min("start"), F.max("end")).first()) == (n, 2, 6 * n)
    bins = G.motif_bins(seq, "GATC", 1000)
    assert tuple(bins.agg(F.count("*"), F.min("score"), F.max("score")).first()) == (n * 6 // 1000, 0.166, 0.167)


def test_a_million_disjoint_features_of_one_chromosome(spark):
    n = 1_000_000
    f = spark.range(n).select(
        F.lit("c").alias("chrom"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 5).alias("end"), F.col("id").cast("string").alias("name"),
        F.lit(1.0).alias("score"), F.lit("+").alias("strand"),
    )
    got = I.collapse(f, names=False).agg(F.count("*"), F.sum("n"), F.max("end")).first()
    assert tuple(got) == (n, n, 10 * n - 5)


@pytest.mark.parametrize("bin_size", [1, 7, 50, 1000])
def test_islands_whatever_the_bins(bed, bin_size):
    r = np.random.default_rng(bin_size)
    rows = [("c", int(s), int(s + 1 + r.integers(30) ** 2 // 9), f"f{k}", 1.0, "+") for k, s in enumerate(r.integers(0, 900, 60))]
    want, top = [], None
    for _, s, e, *_ in sorted(rows, key=lambda x: (x[1], x[2])):
        if top is None or s > top:
            want.append([s, e, 1])
        else:
            want[-1][1], want[-1][2] = max(want[-1][1], e), want[-1][2] + 1
        top = want[-1][1]
    got = [[x["start"], x["end"], x["n"]] for x in I.collapse(bed(rows), bin_size=bin_size).orderBy("start").collect()]
    assert got == want


def test_chunk_sizes_round_half_up():
    assert V.chunk_size(1250, 10) == 130 and V.chunk_size(1350, 10) == 140 and V.chunk_size(1240, 10) == 120
    assert V.chunk_size(99, 10) == 9 and V.chunk_size(5, 10) == 1


def test_bins_equal_a_walk_over_bases():
    """The place where a bin is full, searched base by base on the cumulative coverage."""
    r = np.random.default_rng(4)
    for _ in range(20):
        pos = np.sort(r.choice(np.arange(1, 300), 12, replace=False))
        level = np.concatenate([r.integers(0, 4, 11), [0]])
        delta = np.diff(np.concatenate([[0], level])).astype(float)
        cover = np.zeros(301)
        for a, b, v in zip(pos[:-1], pos[1:], level):
            cover[a:b] = v
        total = np.concatenate([[0], np.cumsum(cover)])  # before each base
        want, start = [], 0
        while True:
            goal = total[start] + 17.0
            k = np.flatnonzero(total >= goal)
            if not len(k) or k[0] > pos[-1]:
                break
            full_at = k[0] - (total[k[0]] - goal) / cover[k[0] - 1]
            want.append((start, int(full_at - 0.5)))
            start = want[-1][1] + 1
        want += [(start, 400)]
        assert B.walk_bins(pos, delta, 400, 17.0) == want


def test_expected_counts():
    got = B.expected_counts(np.array([2.0, 2.0]), np.array([10.0, 10.0]), np.array([2, 0]), np.array([-3, -2, -1, 0, 1]))
    assert got[0].tolist() == [0.0, 1.5, 10.0, 20.0, 30.0]
    assert got[1, 3:].tolist() == [10.0, 20.0]


def test_poisson_logs():
    k = np.array([[0.0], [3.0], [170.0]])
    mean = np.array([[0.0, 2.5]])
    got = np.exp(T.log_dpois(k, mean))
    assert got == pytest.approx(np.array([[T.dpois(int(a), float(b)) for b in mean[0]] for a in k[:, 0]]))


def test_tests_from_counts_equal_tests_from_values(spark):
    r = np.random.default_rng(9)
    v = np.round(r.random(80), 1)
    kinds, times = np.unique(v, return_counts=True)
    assert T.signed_rank_test(list(kinds), times=list(times)) == pytest.approx(T.signed_rank_test(list(v)))
    x, y = np.round(r.random(40), 1), np.round(r.random(30) + 0.2, 1)
    df = spark.createDataFrame([("a", float(s)) for s in x] + [("b", float(s)) for s in y] + [("c", 0.0)], "stratum string, score double")
    assert S.compare_strata(df, "a", "b")["rank_sum"] == pytest.approx(T.rank_sum_test(list(x), list(y)))


@pytest.mark.parametrize(
    "names, root",
    [
        (["AMY1", "AMY1A", "AMY1B"], ["AMY1"]), (["AMY1A", "AMY1B"], ["AMY1"]), (["MIR19-1", "MIR19-2"], ["MIR19"]), (["HOX1", "HOX12"], ["HOX1"]),
        (["ABC10", "ABC11"], ["ABC"]), (["ABCDEF", "ABCDXYZ"], ["ABCD"]), (["X1", "Y22"], ["X1", "Y22"]), (["SOLO"], ["SOLO"]),
    ],
)
def test_family_roots(spark, names, root):
    df = spark.createDataFrame([(names,)], "n array<string>")
    assert df.select(G.family_root(F.col("n")).alias("r")).first()["r"] == root


def test_closure_of_a_long_chain_and_a_cycle(spark):
    set_checkpoint_folder(spark)
    e = spark.createDataFrame([(1, i, i + 1) for i in range(50)] + [(2, 0, 1), (2, 1, 2), (2, 2, 0)], "batch_id int, predecessor long, job long")
    got = J.successors(e, spark.createDataFrame([(1, 7), (2, 1)], "batch_id int, job long")).collect()
    assert {r["job"] for r in got if r["batch_id"] == 1} == set(range(7, 51)) and {r["job"] for r in got if r["batch_id"] == 2} == {0, 1, 2}


def test_a_nearly_full_genome_is_filled():
    f = pd.DataFrame({"id": [str(i) for i in range(19)], "chrom": "c", "start": range(19), "end": [i + 50 for i in range(19)], "score": 1.0, "strand": "+"})
    # twenty places of 50 bases, whose starts other placements would waste: the free list is exact, not lucky
    for seed in range(3):
        try:
            out = M.place(f.head(12), 0, [("c", 1000, 1)], {}, None, seed=seed, stranded=False, max_excluded=0.0, max_overlap=0.0, min_probes=0, max_attempts=5000)
        except ValueError:
            continue  # no room was left, whatever the draws
        spans = sorted(zip(out["start"], out["end"]))
        assert len(out) == 12 and all(b[0] >= a[1] for a, b in zip(spans, spans[1:]))
    runs = M._free_starts(50, ("c",), (100,), {"c": M.Occupied([0], [30])}, {("c", "."): M.Occupied([90], [95])}, "+", False)
    assert runs == [(0, 30, 11, "+")]


def test_directives_and_array_tasks():
    from spanloom.plans.parameters import Directive, array_task, settle

    own = [Directive.parse("require $GENOME"), Directive.parse("option BIN [1000]"), Directive.parse("option MASK")]
    assert settle(own, {"GENOME": "hg"}) == {"GENOME": "hg", "BIN": "1000", "MASK": None}
    assert settle([Directive("N", "7", kind=int)], {"N": "$NULL"}) == {"N": 7}
    with pytest.raises(KeyError):
        settle(own, {"GENOME": ""})
    with pytest.raises(ValueError):
        Directive.parse("require A [1]")
    assert [array_task(i, ["a", "b"], ["x", "y", "z"]) for i in (1, 3, 4, 6)] == [("a", "x"), ("a", "z"), ("b", "x"), ("b", "z")]
    with pytest.raises(IndexError):
        array_task(7, ["a", "b"], ["x", "y", "z"])


@pytest.mark.parametrize("letters", [1_000_000, 0])
def test_texts_in_pieces(spark, monkeypatch, letters):
    """Texts across borders of pieces, longer than pieces, and overlapping themselves, as plain text search finds them."""
    monkeypatch.setattr(G, "AUTOMATON_LETTERS", letters)
    r = np.random.default_rng(6)
    seqs = {"a": "".join(r.choice(list("ACGT"), 700)) + "A" * 50 + "ACACACACAC" + "GATTACA" * 9, "b": "ACGT", "c": "".join(r.choice(list("AC"), 300))}
    texts = {"n1": "gattaca", "n2": "AA", "n3": "ACA", "n4": seqs["a"][100:160], "n5": "C", "n6": "AAAA", "n7": "TTTTTTTTTTTTTTTTT"}
    pieces = spark.createDataFrame([(c, i, s[i : i + 16]) for c, s in seqs.items() for i in range(0, len(s), 16)], "chrom string, start long, seq string")
    wanted = spark.createDataFrame([(c, n, t) for c in ("a", "c") for n, t in texts.items()], "chrom string, name string, text string")
    got = sorted((x["chrom"], x["name"], x["start"], x["end"]) for x in G.find_in_pieces(pieces, wanted, 16).collect())
    want = []
    for c in ("a", "c"):
        for n, t in texts.items():
            i = seqs[c].find(t.upper())
            while i >= 0:
                want.append((c, n, i, i + len(t)))
                i = seqs[c].find(t.upper(), i + len(t))
    assert got == sorted(want)


def test_builds_in_pieces_equal_edited_strings(spark):
    r = np.random.default_rng(8)
    seqs = {c: "".join(r.choice(list("ACGT"), n)) for c, n in (("a", 333), ("b", 40), ("c", 15))}
    changes = [
        ("a", "COORDINATES", "10", "11", "ttt"), ("a", "COORDINATES", "30", "95", ""), ("a", "COORDINATES", "94", "95", "x" * 40), ("a", "COORDINATES", "0", "3", "g"),
        ("a", "FLANKS", "AC", "GT", "nn"), ("a", "FLANKS", "nn", "a", "-"), ("b", "FLANKS", "A", "A", "q"), ("b", "FLANKS", "zz", "A", "q"), ("a", "COORDINATES", "330", "334", "END"),
    ]
    pieces = spark.createDataFrame([(c, i, s[i : i + 16]) for c, s in seqs.items() for i in range(0, len(s), 16)], "chrom string, start long, seq string")
    df = spark.createDataFrame(changes, "chrom string, kind string, left string, right string, text string")
    got = {}
    for x in G.build_pieces(pieces, df, 16).collect():
        assert x["start"] % 16 == 0
        got.setdefault(x["chrom"], {})[x["start"]] = x["seq"]
    for c, s in seqs.items():
        own = sorted(x[1:] for x in changes if x[0] == c)
        want = G.edit_sequence(s, own)
        assert "".join(got[c][k] for k in sorted(got[c])) == want and all(len(got[c][k]) == 16 for k in sorted(got[c])[:-1])
    with pytest.raises(Exception, match="overlap"):
        G.build_pieces(pieces, df.unionByName(spark.createDataFrame([("a", "COORDINATES", "50", "60", "x")], df.schema)), 16).collect()


def test_texts_that_cannot_overlap_are_not_put_in_order(spark):
    seqs = spark.createDataFrame([("a", "abababacacTHETHETHEabab"), ("b", "THEab")], "chrom string, seq string")
    pieces = G.in_pieces(seqs.select("chrom", F.lit(0).cast("long").alias("start"), "seq"), 4)
    wanted = seqs.select("chrom", F.explode(F.array(*map(F.lit, ("aba", "the", "ab", "a")))).alias("text")).withColumn("name", F.col("text"))
    laps = {r["text"]: r["laps"] for r in G._places(pieces, wanted.unionByName(wanted), 4).collect()}
    assert laps == {"ABA": True, "THE": False, "AB": False, "A": False}
    got = sorted((r["chrom"], r["name"], r["start"]) for r in G.find_in_pieces(pieces, wanted, 4).collect())
    assert got == sorted((r["chrom"], r["name"], r["start"]) for r in G.find_features(seqs, wanted).collect())


def test_sequences_are_changed_in_longer_pieces_than_they_come_in(spark, monkeypatch):
    seqs = [("a", "xxTHEyyyTIONzzANq" * 3), ("b", "THETIO"), ("c", "q" * 9)]
    changes = [(c, k, *x) for c, _ in seqs[:2] for k, *x in (("COORDINATES", "2", "4", "new"), ("FLANKS", "the", "tion", "+"), ("FLANKS", "tion", "an", ""))]
    df, ch = spark.createDataFrame(seqs, "chrom string, seq string"), spark.createDataFrame(changes, "chrom string, kind string, left string, right string, text string")
    pieces = G.in_pieces(df.select("chrom", F.lit(0).cast("long").alias("start"), "seq"), 3)
    want = {c: G.edit_sequence(s, [x[1:] for x in changes if x[0] == c]) for c, s in seqs}
    for work in (3, 6, None):
        rows = G.build_pieces(pieces, ch, 3, work=work).orderBy("chrom", "start").collect()
        assert {c: "".join(r["seq"] for r in rows if r["chrom"] == c) for c in want} == want
        assert all(len(r["seq"]) == 3 for r in rows if r["start"] + 3 < len(want[r["chrom"]]))
