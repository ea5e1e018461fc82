"""The two classifiers, decontamination and the tokenizer."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from spanloom.llm import decontaminate as D
from spanloom.llm import pieces as P
from spanloom.llm import quality as Q
from spanloom.llm import toxicity as T
from spanloom.llm.queries import PIECE_MODEL, tokenizer_bytes

from .conftest import prose

needs_model = pytest.mark.skipif(not os.path.exists(public_tokenizers.path(PIECE_MODEL)), reason="no tokenizer files")


def test_additive_model_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = Q.fit_additive(x, y, coarse=4, n_pairs=1)
    assert set(m.pairs) == {(0, 1)}
    assert ((m.score(x) > 0.5) == y).mean() > 0.97


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(12)
    rows, labels = [], []
    for i in range(500):
        bad, toxic = i % 5 == 0, i % 7 == 0
        t = prose(r, 60).split()
        if bad:
            t = [w.upper() + "!!" for w in t]
        for _ in range(2 * toxic):
            t.insert(r.randrange(len(t)), r.choice(["nasty", "vile", "horrid" + r.choice("abcdefgh")]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_quality_on_held_out_rows(judged, docs, empty):
    d, labels, rows = judged
    m = Q.train_quality(d, labels)
    got = {r["doc_id"]: r for r in Q.score_quality(d, m).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i]["held_out"]} == set(held)
    assert np.mean([got[i]["predicted"] == q for i, q, _ in rows if i in set(held)]) > 0.97
    assert Q.score_quality(empty, m).collect() == []
    assert all(0 <= r["score"] <= 1 for r in Q.score_quality(docs, m).collect())


def test_toxicity_on_held_out_rows(judged, docs, empty):
    d, labels, rows = judged
    m = T.train_toxicity(d, labels)
    assert {"nasty", "vile"} <= set(m.lexicon.words) and any(s.startswith("horrid") for s in m.lexicon.stems)
    got = {r["doc_id"]: r for r in T.score_toxicity(d, m).collect()}
    assert np.mean([got[i]["predicted"] == t for i, _, t in rows if got[i]["held_out"]]) > 0.97
    assert T.score_toxicity(empty, m).collect() == []
    assert all(0 <= r["score"] <= 1 for r in T.score_toxicity(docs, m).collect())


def test_one_label_or_none_trains(spark, empty):
    d = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for l in (labels, labels.limit(0)):
        assert Q.score_quality(d, Q.train_quality(d, l)).count() == 2
        assert T.score_toxicity(d, T.train_toxicity(d, l)).count() == 2


def test_grammar_reads_clauses():
    lex = T.Lexicon({"vile": 2.0}, {}, threat=3.0)
    factor = T.class_factors(T.PRIOR)
    read = lambda t: sum(factor[k] * w for k, w in T.read_clause([lex.symbol(w) for w in t.split()]))
    neg, rep, aim = (T.PRIOR[k] for k in ("negation", "report", "target"))
    assert read("vile") == read("vile vile") == read("not vile") == 0.0  # said of nothing: no pattern
    assert read("a vile thing") == read("vile things") == 2.0 and read("you are vile") == read("vile are you") == pytest.approx(2 * aim)
    assert read("you are not vile") == pytest.approx(2 * neg * aim) and read("the word vile stands") == pytest.approx(2 * rep)
    assert read("a not vile and vile") == pytest.approx(2 * neg + 2)  # a negation spends itself on one word
    assert read("dijo vile vile thing") == pytest.approx(4 * rep)  # a report holds to the end
    assert read("kill it") == 0.0 and read("they will kill you") == read("kill you") == read("you kill") == pytest.approx(3 * aim)
    assert T.read_clause([lex.symbol(w) for w in "a fine day".split()]) == []


def brute_read(symbols):
    """The same rules, told without machines."""
    kinds = [s for s, _ in symbols]
    aimed, hosted = T.TARGET in kinds, T.TARGET in kinds or T.OTHER in kinds
    out = []
    for i, (s, w) in enumerate(symbols):
        if s in T.HOSTILE and (hosted if s == T.INSULT else aimed):
            before = kinds[:i]
            last_hostile = max((k for k, x in enumerate(before) if x in T.HOSTILE), default=-1)
            out.append((8 * (s == T.THREAT) + 4 * (T.NEGATION in before[last_hostile + 1 :]) + 2 * (T.REPORT in before) + aimed, w))
    return out


def test_composed_machine_equals_brute_force():
    r = random.Random(5)
    for _ in range(2000):
        clause = [(r.randrange(6), 1.0 + k) for k in range(r.randrange(12))]
        assert sorted(T.read_clause(clause)) == sorted(brute_read(clause))


def test_every_machine_is_read():
    """Without any one of the five, some clause is read otherwise."""
    r = random.Random(6)
    clauses = [[(r.randrange(6), 1.0 + k) for k in range(r.randrange(1, 8))] for _ in range(500)]
    whole = [sorted(T.read_clause(c)) for c in clauses]
    makers = [T.insult, T.threat, T.target, T.negation, T.report]
    for k in range(5):
        idle = T.Machine(makers[k]().states, {}, frozenset())
        grammar = T.compose([idle if j == k else m() for j, m in enumerate(makers)])
        assert [sorted(T.read_clause(c, grammar)) for c in clauses] != whole


def test_arc_weights_are_learned():
    r = np.random.default_rng(3)
    x = np.zeros((400, T.N_CLASSES + 2))
    y = r.integers(0, 2, 400).astype(float)
    x[:, T.N_CLASSES + 1] = 5
    x[np.arange(400), np.where(y == 1, 1, 4)] = 3.0  # toxic where aimed, clean where negated
    arcs, w = T._fit(x, y)
    assert arcs["negation"] <= T.PRIOR["negation"] and arcs["target"] > arcs["negation"]
    p = T.ToxicityModel(T.Lexicon({}, {}), arcs, w).score(x)
    assert p[y == 1].min() > p[y == 0].max()


def brute_score(model, text):
    """The whole score of a text, by the rules."""
    low = (text or "").lower()
    paid, clauses = 0.0, 0
    any_ = False
    parts = re.split(r"([.!?;:\n]+)", low)
    for clause, end in zip(parts[::2], [*parts[1::2], ""]):
        symbols = [model.lexicon.symbol(w) for w in re.findall(r"[^\W\d_]+", clause)] + [(T.OTHER, 0.0)] * ("!" in end)
        clauses += bool(clause)
        any_ |= any(s in T.HOSTILE for s, _ in symbols)
        for kind, w in brute_read(symbols):
            f = 1.0
            if kind & 1:
                f *= model.arcs["target"]
            if kind & 2:
                f *= model.arcs["report"]
            if kind & 4:
                f *= model.arcs["negation"]
            if kind & 8:
                f *= model.arcs["threat"]
            paid += f * w
    z = model.weights[0] * np.log1p(paid) + model.weights[1] * np.log1p(paid / max(1, clauses) if any_ else 0.0) + model.weights[2]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def test_toxic_scores_equal_brute_force_and_patterns_decide(spark, judged):
    d, labels, _ = judged
    m = T.train_toxicity(d, labels)
    probes = [
        "nasty", "dictionary entry: nasty. it is a noun.", "you are not nasty", "she said you nasty", "the word nasty stands here", "not nasty, not vile",
        "you nasty thing", "a vile day for him", "", None, "kill", "they kill you", "vile! nasty? no", "nasty vile", "he wrote: you are vile",
    ]
    df = spark.createDataFrame([*enumerate(probes)], "doc_id long, text string").unionByName(d)
    texts = {r.doc_id: r.text for r in d.collect()}
    got = T.score_toxicity(df, m).collect()
    assert len(got) == len(probes) + len(texts)
    own = {t: min(r.score for r in T.score_toxicity(spark.createDataFrame([(1, t)], "doc_id long, text string"), m).collect()) for t in probes}
    for t in probes[:6]:
        assert own[t] < 0.3, t
    assert own["you nasty thing"] >= 0.3 and own["a vile day for him"] >= 0.3
    for r in T.score_toxicity(d, m).collect():
        assert r.score == pytest.approx(brute_score(m, texts[r.doc_id]), abs=1e-9)
    for t in probes:
        assert own[t] == pytest.approx(brute_score(m, t), abs=1e-9)


def test_alignment_scores():
    item = np.arange(2, 12, dtype=np.uint64)[None, :]
    cut = np.delete(item[0], 4)[None, :]
    other = np.array([[50, 51, *range(2, 12), 60]], np.uint64)
    assert D.align(other, item)[0][0] == 20 and D.align(other, item)[1][0] == 12
    assert D.align(cut, item)[0][0] == 17


def brute_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_brute_force():
    r = np.random.default_rng(2)
    for _ in range(30):
        a, b = r.integers(5, 9, r.integers(1, 20)), r.integers(5, 9, r.integers(1, 12))
        assert D.align(a[None].astype(np.uint64), b[None].astype(np.uint64))[0][0] == brute_align(a, b)


def test_decontamination_finds_edited_copies(spark, docs, empty):
    r = random.Random(21)
    items = [(i, prose(r, 30)) for i in range(6)]
    bench = spark.createDataFrame([*items, (77, None), (78, ""), items[0]], "item_id long, text string")
    w = items[1][1].split()
    edited = " ".join("changed" if k % 9 == 4 else x for k, x in enumerate(w))
    rows = [(1, prose(r, 40) + " " + items[0][1].upper() + ", " + prose(r, 9)), (2, prose(r, 200) + " " + edited), (3, prose(r, 300)), (4, None), (None, items[0][1]), (5, items[2][1] + " x " + items[3][1])]
    rows += [(100 + k, items[4][1] + " " + prose(r, 5)) for k in range(30)]  # a common passage keeps its seeds
    got = {(x["doc_id"], x["item_id"]): x["score"] for x in D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 0), (2, 1), (5, 2), (5, 3)} | {(100 + k, 4) for k in range(30)}
    assert got[1, 0] == 1.0 and 0.5 < got[2, 1] < 1.0
    assert D.contaminated(empty, bench).collect() == [] and D.contaminated(docs, bench.limit(0)).collect() == []


def test_decontamination_finds_edited_copies_beside_full_ones(spark):
    r = random.Random(8)
    item = [f"{w}{k}" for k, w in enumerate(prose(r, 40).split())]
    light = " ".join("changed" if k % 6 == 5 else x for k, x in enumerate(item))
    rows = [(1, " ".join(item)), (2, prose(r, 30) + " " + light + " " + prose(r, 30)), (3, prose(r, 60)), (4, " ".join(item[:6]) + " " + prose(r, 60))]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {x["doc_id"]: x["score"] for x in D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {1, 2} and got[1] == 1.0 and 0.5 <= got[2] < 1.0


def test_decontamination_beyond_the_bounds(spark, monkeypatch):
    r = random.Random(5)
    items = [(i, prose(r, 25)) for i in range(8)]
    rows = [(i, prose(r, 12) + " " + t) for i, t in items]
    bench, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(D, "TASK_GRAMS", 3)
    monkeypatch.setattr(D, "TASK_WORDS", 300)
    assert {(x["doc_id"], x["item_id"]) for x in D.contaminated(d, bench).collect()} == {(i, i) for i, _ in items}


@needs_model
def test_pieces_equal_the_library(docs, corpus, empty):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    got = {r["doc_id"]: r for r in P.encode_documents(docs, tokenizer_bytes()).collect()}
    for i, t in corpus:
        ids = lib.encode(t or "")
        assert got[i]["ids"] == ids and got[i]["decoded"] == lib.decode(ids)
    assert P.encode_documents(empty, tokenizer_bytes()).collect() == []
    assert {r["doc_id"]: r["decoded"] for r in P.decode_documents(P.encode_documents(docs, tokenizer_bytes()), tokenizer_bytes()).collect()} == {i: got[i]["decoded"] for i in got}


@needs_model
def test_piece_spans_are_the_library_s():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    m = P.Pieces(tokenizer_bytes())
    for t in ("Hello  world\n\tx", " é日本 😀▁y ", "a\x00b", "   ", "x" * 300, "ab\r\ncd  ef"):
        ids, begin, end, off = m.encode([t])
        assert ids.tolist() == lib.encode(t)
        raw = t.encode()
        assert begin[0] == 0 and end[-1] == len(raw) and all(a == b for a, b in zip(end, begin[1:]))
        out, ends = m.decode(ids, off)
        assert out.tobytes().decode() == lib.decode(lib.encode(t))


def test_character_maps_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb

    for rule in ("nmt_nfkc", "nfkc_cf"):
        lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        proto = pb.ModelProto()
        proto.ParseFromString(lib.serialized_model_proto())
        cm = P.CharMap(proto.normalizer_spec.precompiled_charsmap)
        assert cm.units
        m = P.Pieces.__new__(P.Pieces)
        spec = proto.normalizer_spec
        m.map, m.dummy, m.squeeze, m.escape = cm, spec.add_dummy_prefix, spec.remove_extra_whitespaces, False
        for t in ("ｆｕｌｌ width ㍻ ﬁne", "été  Ⅷ½ ", "STRASSE ß İ", "  a 　 b "):
            norm, at = m.normalize(t)
            assert norm.decode() == lib.normalize(t).replace("▁", " ")
            assert len(at) == len(norm) + 1 and all(x <= y for x, y in zip(at, at[1:])) and at[-1] <= len(t.encode())


@needs_model
def test_ids_of_bytes_that_are_no_text_decode_like_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    m = P.Pieces(tokenizer_bytes())
    byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(lib.get_piece_size()) if lib.is_byte(i)}
    r = random.Random(4)
    assert byte
    for seq in [b"a\xff\xe6\x97b", b"\xe6\x97", b"\xf0\x9f\x98\x80", b"\xc3\x28\xa9", *[bytes(r.randrange(256) for _ in range(r.randrange(1, 9))) for _ in range(60)]]:
        ids = [byte[x] for x in seq]
        out, ends = m.decode(np.array(ids), np.array([0, len(ids)]))
        assert bytes(out).decode() == lib.decode(ids) and list(ends) == [0, len(out)]


def test_hashes_are_of_the_digest_columns():
    assert hashlib.sha256(b"1,2").hexdigest() == hashlib.sha256(",".join(["1", "2"]).encode()).hexdigest()


def test_decontamination_equals_brute_force(spark, monkeypatch):
    """Every pair that shares a gram and aligns, however the benchmark's size makes it run."""
    r = random.Random(31)
    items = [(i, prose(r, r.randrange(1, 60))) for i in range(12)] + [(50, "tiny item"), (51, None)]
    rows = [(i, prose(r, r.randrange(0, 90))) for i in range(20)]
    for k in range(40):
        w = items[k % 12][1].split()
        for _ in range(r.randrange(0, len(w) // 3 + 1)):
            at = r.randrange(len(w))
            w[at : at + r.randrange(2)] = [prose(r, 1)] * r.randrange(2)
        rows.append((100 + k, prose(r, r.randrange(20)) + " " + " ".join(w) + " " + prose(r, r.randrange(20))))
    rows += [(200, "a tiny item"), (201, "tiny item"), (202, ""), (203, None), (204, " ".join(t for _, t in items[:12]))]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").lower())
    grams = lambda w: {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    want = {}
    for i, t in rows:
        for j, u in items:
            a, b = words(t), words(u)
            if grams(a) & grams(b) and brute_align(a, b) >= len(b):
                want[i, j] = brute_align(a, b) / (2 * len(b))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    find = lambda: {(x["doc_id"], x["item_id"]): x["score"] for x in D.contaminated(docs, bench).collect()}
    assert len(want) > 40 and find() == pytest.approx(want)
    monkeypatch.setattr(D, "TASK_GRAMS", 5)
    monkeypatch.setattr(D, "TASK_WORDS", 5)
    monkeypatch.setattr(D, "SEEDS", 2)
    monkeypatch.setattr(D, "CELLS", 200)
    assert find() == pytest.approx(want)


def test_boilerplate_grams_are_no_seeds(spark):
    """A phrase of all items pairs no document with all of them, while edited copies, and copies of items that are nothing else, are found."""
    r = random.Random(9)
    phrase = "choose the best answer to the question below"
    items = [(i, f"{phrase} {prose(r, 30)}") for i in range(60)] + [(900, phrase), (901, phrase.upper() + "!")]
    rows = [(i, f"{prose(r, 10)} {phrase} {prose(r, 10)}") for i in range(50)]
    cut = items[7][1].split()
    rows += [(100, " ".join(cut[:20] + ["new"] + cut[22:])), (101, items[8][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in D.contaminated(docs, bench).collect()}
    assert got == {(i, j) for i, _ in rows for j in (900, 901)} | {(100, 7), (101, 8)}
    own = D.seed_grams(spark.createDataFrame([(g, i, 0) for i in range(60) for g in (1, 100 + i, 200 + i, 300 + i)] + [(1, 900, 0)], "gram long, item_id long, item_pos int"))
    assert {x.item_id for x in own.where("gram = 1").collect()} == {900}
