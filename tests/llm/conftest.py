import random

import pytest

WORDS = "alpha beta gamma delta omega sigma kappa theta lambda river stone cloud winter summer paper glass iron copper silver bridge garden window letter market island forest engine signal pocket mirror".split()


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, empty, blank, null and long ones."""
    r = random.Random(3)
    base = [prose(r, r.randrange(5, 120)) for _ in range(25)]
    passage = prose(r, 90)
    texts = list(base)
    texts += base[:4] + [base[0]] * 3
    for t in base[5:12]:
        w = t.split()
        for _ in range(2):
            v = list(w)
            v[r.randrange(len(v))] = "changed"
            texts.append(" ".join(v))
    texts += [prose(r, 20) + " " + passage + " " + prose(r, 15) for _ in range(3)] + [passage[3:]]
    texts += [None, "", "   \n\t ", "x", "two words", "é日本 ñandú" * 3, "ab" * 900, "word " * 3000, prose(r, 4000)]
    texts += ["Released under the MIT License.\n" + prose(r, 30), "see the MIT, license; the Apache License", "GENERAL public LICENSE"]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns, some of names that operators use inside."""
    rows = [(i, t, "en", "src0", len(t or ""), 1.5, None, "z") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, cls string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
