"""Exact, near and long-repeat removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import exact_dedup as X
from spanloom.llm import near_dedup as N
from spanloom.llm.suffixes import remove_repeats
from spanloom.llm.work import components

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, items):
        self.p = {i: i for i in items}

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.p[max(a, b)] = min(a, b)


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(corpus, k, percent):
    s = {i: sets(t, k) for i, t in corpus}
    u = Union(s)
    ids = sorted(s)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(s[a] & s[b])
            if both and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                u.join(a, b)
    return {i: (len(s[i]), u.find(i)) for i in ids}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_equals_brute_force(docs, corpus, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(docs, shingle=k, percent=percent).collect()}
    assert got == brute_components(corpus, k, percent)


def test_near_group_of_edited_copies(spark):
    r = random.Random(8)
    w = [f"w{r.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(80):
        v = list(w)
        for _ in range(r.randrange(0, 6)):
            v[r.randrange(120)] = f"e{r.randrange(9999)}"
        rows.append((i, " ".join(v)))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_near_large_buckets(spark, monkeypatch):
    """Groups beyond a block: turns of bands, and a last round that deals out blocks of the largest component."""
    monkeypatch.setattr(N, "BLOCK", 6)
    r = random.Random(18)
    rows, i = [], 0
    for base in range(3):
        w = [f"b{base}w{r.randrange(400)}" for _ in range(100)]
        for _ in range(30):
            v = list(w)
            for _ in range(r.randrange(0, 8)):
                v[r.randrange(100)] = f"e{r.randrange(9999)}"
            rows.append((i, " ".join(v)))
            i += 1
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_near_edges(spark, empty):
    assert N.near_duplicates(empty).collect() == []
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (7, None), (5, "q r s t u v w x")]
    got = sorted(map(tuple, N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 3, 5, True), (5, 3, 5, True), (None, 3, 5, False), (7, 0, 7, True), (5, 4, 5, True)], key=repr)


def test_bayes_bounds_grow_and_keep_likely_pairs():
    low = [N.least_matches(n, 0.85, 1e-5) for n in (32, 64, 128, 256)]
    assert low == sorted(low) and low[-1] < 0.85 * 256 and low[-1] > 0.7 * 256


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    got = dict(map(tuple, components(e, "a", "b").collect()))
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[95] == got[90] == 90
    assert components(e.limit(0), "a", "b").count() == 0


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_components_equal_brute_force_however_many_rounds(spark, monkeypatch, few):
    from spanloom.llm import work

    monkeypatch.setattr(work, "FEW_EDGES", few)
    r = random.Random(few)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)]
    old, new = pairs[:25], pairs[25:]
    u = Union(range(60))
    for a, b in pairs:
        u.join(a, b)
    first = components(spark.createDataFrame(old, "a long, b long"), "a", "b")
    got = dict(map(tuple, work.merged_components(first, spark.createDataFrame(new, "a long, b long"), "a", "b").collect()))
    assert got == {n: u.find(n) for n in got} and {n for p in pairs for n in p if p[0] != p[1]} <= set(got)


@pytest.mark.parametrize("n", [0, 1, 2, 50, 5000])
def test_golomb_round_trip(n):
    v = np.unique(np.random.default_rng(n).integers(0, 1 << 22, n))
    for rice in (1, 6, 14):
        assert X.golomb_decode(X.golomb_encode(v, rice), len(v), rice).tolist() == v.tolist()


def test_exact_equals_brute_force(docs, corpus):
    by = {}
    for i, t in corpus:
        by.setdefault(t or "", []).append(i)
    want = {i: (max(by[t or ""]), len(by[t or ""]), i == max(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in corpus}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in X.exact_duplicates(docs).collect()}
    assert got == want


def test_exact_edges(spark, empty):
    assert X.exact_duplicates(empty).collect() == []
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (3, "")]
    got = sorted((tuple(r)[:4] for r in X.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(1, 1, 2, True), (1, 1, 2, True), (None, None, 2, False), (None, None, 2, False), (2, 3, 2, False), (3, 3, 2, True)], key=repr)


def brute_repeats(corpus, length):
    raw = [(i, (t or "").encode()) for i, t in corpus]
    seen = Counter(t[s : s + length] for _, t in raw for s in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        cover = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                cover[s : s + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, cover) if not c)
        spans = sum(1 for k, c in enumerate(cover) if c and (k == 0 or not cover[k - 1]))
        out.append((i, len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [400, 150])
def test_repeats_equal_brute_force(docs, corpus, length):
    got = sorted(tuple(r)[:5] for r in remove_repeats(docs, length=length).collect())
    assert got == brute_repeats(corpus, length)


def brute_passages(corpus, passage):
    """Per row: the runs of words covered by ``passage`` words that stand in another row, and their words."""
    words = [[w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode()) if w] for _, t in corpus]
    runs = [[tuple(w[s : s + passage]) for s in range(len(w) - passage + 1)] for w in words]
    rows = Counter(x for r in runs for x in set(r))
    out = []
    for (i, _), w, r in zip(corpus, words, runs):
        cover = bytearray(len(w))
        for s, x in enumerate(r):
            if rows[x] > 1:
                cover[s : s + passage] = b"\1" * passage
        out.append((i, sum(1 for k, c in enumerate(cover) if c and (k == 0 or not cover[k - 1])), sum(cover)))
    return sorted(out)


def counted_passages(docs, passage):
    return sorted((x.doc_id, x.n_passages, x.n_passage_words) for x in remove_repeats(docs, passage=passage).collect())


@pytest.mark.parametrize("group", [4000, 2])
def test_passages_equal_brute_force(spark, monkeypatch, group):
    """Passages shorter than the strings that are removed; beside each other, cut, changed in a word, rewrapped, and within a row."""
    from spanloom.llm import suffixes

    monkeypatch.setattr(suffixes, "GROUP", group)
    r = random.Random(8)

    def some(n):
        return [r.choice("abcdefgh") + str(r.randrange(400)) for _ in range(n)]

    common, twin = [some(r.randrange(45, 75)) for _ in range(6)], some(130)
    rows = []
    for i in range(60):
        w = some(r.randrange(30))
        for _ in range(r.randrange(3)):
            p = list(r.choice(common))
            p = p[r.randrange(4) : len(p) - r.randrange(4)]
            if r.random() < 0.3:
                p[r.randrange(len(p))] = "changed"
            w += p + some(r.choice([0, 1, 20]))
        rows.append((i, r.choice([" ", "\n", " \t "]).join(w)))
    own = some(60)
    rows += [(100, " ".join(own + some(5) + own)), (101, " ".join(twin)), (101, " ".join(twin)), (102, " ".join(twin[:90] + some(3) + twin[40:])), (103, None), (104, " ".join(twin[:50]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_passages(rows, 51)
    assert counted_passages(df, 51) == want
    assert (100, 0, 0) in want and (101, 1, 130) in want and (104, 0, 0) in want
    if group > 2:
        assert [tuple(x)[:6] for x in remove_repeats(df, passage=51).sort("doc_id", "n_bytes").collect()] == [
            tuple(x) for x in remove_repeats(df).sort("doc_id", "n_bytes").collect()
        ]


def test_passages_of_the_corpus_equal_brute_force(docs, corpus):
    assert counted_passages(docs, 51) == brute_passages(corpus, 51)
    assert counted_passages(docs, 16) == brute_passages(corpus, 16)


def test_query_finds_a_passage_shorter_than_400_bytes(spark, tmp_path):
    """A passage of 55 words (219 bytes) in two documents stays in the text by contract, and is counted."""
    from spanloom.llm import queries

    p = " ".join(f"w{k % 10}{k // 10}" for k in range(55))
    rows = [(1, "one " + p + " two"), (2, p), (3, "one two three"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_passages, x.n_passage_words) for x in queries.op5_repeats(spark, str(tmp_path)).collect()}
    assert len(p) == 219 and got == {1: (227, 0, 1, 55), 2: (219, 0, 1, 55), 3: (13, 0, 0, 0), 4: (0, 0, 0, 0)}


def test_family_keeps_order_and_levels(spark, tmp_path):
    """Levels are sorted by content, grow like binary digits, and match later batches after they are opened again."""
    from spanloom.llm.suffixes import ANCHOR, SuffixFamily

    r = random.Random(6)
    pool = [bytes(r.choice(b"ab") for _ in range(ANCHOR)) for _ in range(60)]
    fp = {s: k for k, s in enumerate(dict.fromkeys(pool))}
    seen = Counter()
    for k in range(7):
        batch = Counter(r.choice(pool) for _ in range(15))
        rows = spark.createDataFrame([(bytearray(s), fp[s], n) for s, n in batch.items()], "suffix binary, fp long, n int")
        family = SuffixFamily(spark, str(tmp_path / "family"))
        got = {x["fp"] for x in family.add(rows).collect()}
        assert got == {fp[s] for s, n in batch.items() if n + seen[s] > 1}
        seen += batch
        assert sorted(family.levels) == [b for b in range(4) if (k + 1) >> b & 1]
        total = Counter()
        for rank in family.levels:
            level = [(bytes(x["suffix"]), x["n"]) for x in family.read(rank).collect()]
            assert len({s for s, _ in level}) == len(level)
            total += Counter(dict(level))
            for part in family.read(rank).rdd.glom().collect():
                assert [x["suffix"] for x in part] == sorted(x["suffix"] for x in part)
        assert total == seen


def test_common_prefixes():
    from spanloom.llm.suffixes import common_prefixes

    rows = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [1, 3, 4], [2, 3, 4]], np.uint8)
    assert common_prefixes(rows).tolist() == [0, 3, 2, 1, 0]


def test_windows_are_verified_on_bytes():
    from spanloom.llm.suffixes import _verified

    data = np.frombuffer(b"abcdefgh" + b"abcdeXgh", np.uint8)
    left = np.arange(5)
    assert _verified(data, left, left + 8, 4).tolist() == [True, True, False, False, False]


def test_repeats_of_a_suffix_in_many_places(spark, monkeypatch):
    from spanloom.llm import suffixes

    monkeypatch.setattr(suffixes, "GROUP", 3)  # the counted way
    r = random.Random(4)
    line = "".join(r.choice("abcdef ") for _ in range(320))
    rows = [(i, "".join(r.choice("ghij ") for _ in range(150)) + line + ("tail" * 30 if i % 2 else "".join(r.choice("klm ") for _ in range(90)))) for i in range(12)]
    got = sorted(tuple(x)[:5] for x in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_repeats(rows, 400)


def test_repeats_edges(spark, empty):
    assert remove_repeats(empty).collect() == []
    rows = [(None, "ab" * 400), (4, None), (4, "z" * 399), (4, "z" * 401)]
    got = sorted((tuple(r)[:4] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(None, 800, 800, 1), (4, 0, 0, 0), (4, 399, 0, 0), (4, 401, 401, 1)], key=repr)


def test_texts_that_cancel_out_in_sums_of_powers_are_not_linked(spark):
    """The Thue-Morse word and its exchange have equal sums of powers of any odd base modulo 2**64."""
    t = "a"
    for _ in range(10):
        t = "".join("ab" if c == "a" else "ba" for c in t)
    u = t.translate(str.maketrans("ab", "ba"))
    rows = [(1, t), (2, u), (3, f"x {t} y {u} z"), (4, f"x {u} y {t} z"), (5, t)]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert {g.doc_id: g.component_id for g in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_a_third_of_all_rows_share_a_key(spark, monkeypatch):
    """Hot keys meet their table without a shuffle, and every result is the same; Spark's own treatment of skew is off."""
    from spanloom.llm import sharding, surrogates, work

    r = random.Random(12)
    hot = "call Mrs Anna Bell or mail a.bell@mail.example.com, " + " ".join(r.choice("abcdefgh") for _ in range(40))
    rows = [(i, hot if i % 3 == 0 else f"{r.randrange(10**9)} {hot[r.randrange(30):]} host 10.0.{i % 250}.{r.randrange(250)}" if i % 3 == 1 else "" if i % 12 == 2 else f"t{i}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    runs = {
        "op1": lambda: surrogates.replace_private(df, key="k"), "op4": lambda: N.near_duplicates(df, shingle=3, percent=85),
        "op7": lambda: sharding.assign_shards(df, shards=4).drop("slot"), "op8": lambda: X.exact_duplicates(df),
    }
    want = {k: sorted(map(tuple, f().collect())) for k, f in runs.items()}
    monkeypatch.setattr(work, "HOT_ROWS", 20)
    monkeypatch.setattr(X, "BROADCAST_IDS", 0)
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert {k: sorted(map(tuple, f().collect())) for k, f in runs.items()} == want
        counted = df.groupBy("text").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
        plan = work.join_hot(df, counted, ["text"], "n")._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)
