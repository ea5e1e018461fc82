"""The pipeline's decisions against brute-force versions: on the smallest tables, and on rows that are hard to tell apart."""

from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import quality as Q
from spanloom.llm import textkernels as K
from spanloom.llm.queries import PIECE_MODEL

pipeline = pytest.importorskip("corpus_pipeline")
tokenizers = pytest.importorskip("public_tokenizers")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are absent")
STEPS = dict(pipeline.STAGES)
QUALITY, EXACT, NEAR, CLEAN, ENCODE = STEPS


def brute_quality(docs, labels):
    """Rows that a model accepts which sums the tables text by text."""
    model = Q.train_quality(docs, labels)
    out = []
    for r in docs.collect():
        x = Q.features(*K.texts(pa.array([r["text"]], pa.string())))[0]
        z = model.base + sum(t[np.searchsorted(c, v, "right")] for c, t, v in zip(model.cuts, model.tables, x))
        z += sum(t[np.searchsorted(model.coarse[f], x[f], "right"), np.searchsorted(model.coarse[g], x[g], "right")] for (f, g), t in model.pairs.items())
        if 1 / (1 + np.exp(-z)) >= 0.7:
            out.append(r)
    return out


def test_each_stage_on_its_own_input(spark):
    import sentencepiece

    from .test_dedup import brute_components

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = STEPS[QUALITY](spark, docs, str(DATA))
    want = brute_quality(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert good.columns == docs.columns and sorted(good.collect()) == sorted(want) and 0 < len(want) < docs.count()

    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    one = STEPS[EXACT](spark, good, str(DATA))
    last = {}
    for i, t in texts.items():
        last[t] = max(i, last.get(t, i))
    assert {r["doc_id"] for r in one.collect()} == set(last.values()) and one.columns == docs.columns

    kept = sorted((i, t) for t, i in last.items())
    apart = STEPS[NEAR](spark, one, str(DATA))
    want = {i for i, (_, c) in brute_components(kept, 5, 80).items() if i == c}
    assert {r["doc_id"] for r in apart.collect()} == want and apart.columns == docs.columns

    clean = STEPS[CLEAN](spark, apart, str(DATA))
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    held = {r["doc_id"] for r in apart.collect() if any(t in " ".join(r["text"].lower().split()) for t in items)}
    assert left == want - held and clean.columns == docs.columns

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path(PIECE_MODEL))
    for r in STEPS[ENCODE](spark, clean, str(DATA)).collect():
        assert r["ids"] == lib.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


LONG = " ".join(f"long{i % 977}x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, extra int, kept boolean, cls string"


def rows_of(*pairs):
    return [(i, t, n, None, "c") for n, (i, t) in enumerate(pairs)]


def texts_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_exact_stage_judges_rows(spark):
    a, x = "alpha beta gamma", "xi omicron pi"
    rows = rows_of((2, a), (2, a), (3, x), (3, "other"), (4, x), (None, "n"), (None, "n"), (None, "n"), (5, None), (6, ""), (7, LONG), (7, LONG))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = STEPS[EXACT](spark, docs, str(DATA))
    assert out.columns == docs.columns
    assert texts_of(out) == Counter([(2, a), (3, "other"), (4, x), (None, "n"), (6, ""), (7, LONG)])


def test_near_stage_judges_rows(spark):
    w = [f"w{i}" for i in range(60)]
    a, b = " ".join(w), " ".join([*w[:59], "edited"])
    rows = rows_of((2, a), (2, a), (2, b), (3, "one two three four five six"), (None, b), (None, "q r s t u v"), (None, "q r s t u v"), (8, None), (9, ""), (9, LONG), (10, LONG))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = texts_of(STEPS[NEAR](spark, docs, str(DATA)))
    assert sum(n for (i, t), n in out.items() if t in (a, b)) == 1
    out = {k: n for k, n in out.items() if k[1] not in (a, b)}
    assert out == Counter([(3, "one two three four five six"), (None, "q r s t u v"), (8, None), (9, ""), (9, LONG)])


def test_other_stages_judge_rows(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = rows_of((2, "clean words here only"), (2, f"before {item} after"), (None, item), (None, None), (3, ""), (3, LONG), (4, f"{LONG} {item}"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = STEPS[CLEAN](spark, docs, str(DATA))
    assert out.columns == docs.columns
    assert texts_of(out) == Counter([(2, "clean words here only"), (None, None), (3, ""), (3, LONG)])
    good = STEPS[QUALITY](spark, docs, str(DATA))
    assert good.columns == docs.columns and not texts_of(good) - texts_of(docs)
    n = [r["n_tokens"] for r in STEPS[ENCODE](spark, docs, str(DATA)).collect()]
    assert len(n) == len(rows) and n.count(0) == 2


def test_empty_table_through_all_stages(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, step in pipeline.STAGES:
        docs = step(spark, docs, str(DATA))
        assert docs.count() == 0
