"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins and has a lookup table; a few feature pairs
have small two-way tables.  Training boosts shallow trees cyclically, one feature
after another, on the bins; a tree only adds to its feature's table, so the model
stays a sum of table entries.  Scoring is one vectorised bin addition per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import map_texts

FEATURES = (
    "log_words", "word_length", "upper", "digit", "symbol", "other_alphabet",
    "line_breaks", "distinct_words", "repeated_next", "repeated_symbol", "symbol_words", "longest_word",
)
_UPPER = K.lut(bytes(range(0x41, 0x5B)))
_DIGIT = K.lut(bytes(range(0x30, 0x3A)))
_SYMBOL = K.lut(bytes(x for x in range(0x21, 0x7F) if not chr(x).isalnum()))
_HIGH = K.lut(bytes(range(0x80, 0x100)))
_BREAK = K.lut(b"\n\r")


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text; a text without words has zeros."""
    n = len(off) - 1
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    size = np.maximum(1, np.diff(off)).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[off[1:]] - total[off[:-1]]) / size

    s, e, first = K.words(data, off, K.NOT_BLANK)
    count = np.diff(first)
    n_words = np.maximum(1, count).astype(float)
    symbol = _SYMBOL[data]
    twice = np.concatenate([[False], symbol[1:] & (data[1:] == data[:-1])])
    out[:, 0] = np.log1p(count)
    out[:, 2], out[:, 3], out[:, 4] = share(_UPPER[data]), share(_DIGIT[data]), share(symbol)
    out[:, 5], out[:, 6], out[:, 9] = share(_HIGH[data]), share(_BREAK[data]), share(twice)
    if len(s):
        full = np.flatnonzero(count)
        at = first[:-1][full]
        length = e - s
        out[full, 1] = np.add.reduceat(length, at) / n_words[full]
        out[full, 11] = np.log1p(np.maximum.reduceat(length, at))
        h = K.span_hash(data, s, e)
        same = np.concatenate([[False], h[1:] == h[:-1]])
        same[at] = False
        out[full, 8] = np.add.reduceat(same.astype(np.int64), at) / n_words[full]
        before = np.concatenate([[0], np.cumsum(symbol)])
        # words of symbols alone, or that end in two of them
        odd = (before[e] - before[s] == length) | ((length > 2) & (before[e] - before[np.maximum(s, e - 2)] == 2))
        out[full, 10] = np.add.reduceat(odd.astype(np.int64), at) / n_words[full]
        for x in full:
            own = np.sort(h[first[x] : first[x + 1]])
            out[x, 7] = (1 + np.count_nonzero(own[1:] != own[:-1])) / len(own)
    return out


@dataclass
class AdditiveModel:
    """Cut points and tables; ``pairs`` maps two feature numbers to a two-way table over coarse bins."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    base: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cut, x[:, f], "right")]
        for (f, g), table in self.pairs.items():
            out += table[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """The values of a shallow regression tree over ordered bins with gradient and hessian sums."""
    value = np.full(len(g), g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 2:
        return value
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rg, rh = g.sum() - cg, h.sum() - ch
    gain = cg**2 / (ch + ridge) + rg**2 / (rh + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(ch < least) | (rh < least)] = -1
    k = int(np.argmax(gain)) + 1
    if gain[k - 1] <= 1e-9:
        return value
    return np.concatenate([_leaves(g[:k], h[:k], depth - 1, ridge, least), _leaves(g[k:], h[k:], depth - 1, ridge, least)])


def fit_additive(
    x: np.ndarray, y: np.ndarray, *, bins: int = 48, coarse: int = 8, rounds: int = 60, pair_rounds: int = 30,
    n_pairs: int = 5, rate: float = 0.15, depth: int = 2, ridge: float = 1.0, least: float = 0.5,
) -> AdditiveModel:
    """Cyclic boosting of main effects, then of the ``n_pairs`` pairs that explain most of what is left."""
    n_f = x.shape[1]

    def cut(k: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(x[:, f], np.arange(1, k) / k)) if len(x) else np.zeros(0) for f in range(n_f)]

    cuts, rough = cut(bins), cut(coarse)
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = AdditiveModel(cuts, [np.zeros(len(c) + 1) for c in cuts], rough, {}, float(np.log(share / (1 - share))))
    if not len(x) or y.min() == y.max():
        return model
    at = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)]
    logit = np.full(len(x), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f in range(n_f):
            g, h = slopes()
            k = len(cuts[f]) + 1
            step = rate * _leaves(np.bincount(at[f], g, k), np.bincount(at[f], h, k), depth, ridge, least)
            model.tables[f] += step
            logit += step[at[f]]
    two = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(rough)]

    def cell(f: int, g_: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(rough[f]) + 1, len(rough[g_]) + 1)
        return two[f] * shape[1] + two[g_], shape

    g, h = slopes()
    gain = {}
    for f in range(n_f):
        for k in range(f + 1, n_f):
            c, shape = cell(f, k)
            gain[f, k] = float((np.bincount(c, g, shape[0] * shape[1]) ** 2 / (np.bincount(c, h, shape[0] * shape[1]) + ridge)).sum())
    chosen = sorted(gain, key=lambda p: (-gain[p], p))[:n_pairs]
    for f, k in chosen:
        model.pairs[f, k] = np.zeros(cell(f, k)[1])
    for _ in range(pair_rounds):
        for f, k in chosen:
            g, h = slopes()
            c, (a, b) = cell(f, k)
            gg, hh = np.bincount(c, g, a * b).reshape(a, b), np.bincount(c, h, a * b).reshape(a, b)
            # a tree of depth two over the pair: the best cut of one feature, each side cut on the other
            best, step = -1.0, None
            for turn in (False, True):
                p, q = (gg.T, hh.T) if turn else (gg, hh)
                for i in range(1, p.shape[0]):
                    parts = [np.broadcast_to(_leaves(p[s].sum(0), q[s].sum(0), 1, ridge, least), p[s].shape) for s in (slice(0, i), slice(i, None))]
                    v = np.concatenate(parts)
                    won = float((v * p).sum())
                    if won > best:
                        best, step = won, (v.T if turn else v)
            model.pairs[f, k] += rate * step
            logit += rate * step.ravel()[c]
    return model


def _rows(batches, extra, kinds):
    for b in batches:
        data, off = K.texts(b.column("text"))
        for i, j, d, o in K.chunks(data, off):
            x = features(d, o)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, j - i), *extra(x, b.slice(i, j - i))], ["doc_id", *kinds]
            )


def held_out(doc_id="doc_id"):
    """Rows that training never sees: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled ids that are not held out, chosen by the hash of the id."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def training_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``doc_id, text, y`` of the chosen ids, at most ``max_train_rows`` of them; one text for each."""
    return (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("doc_id", "text", "y")
    )


def train_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_train_rows: int = 20_000, **how) -> AdditiveModel:
    """Fit on at most ``max_train_rows`` labelled documents.  The bound also bounds what the
    driver holds: that many rows of twelve numbers.  Of several texts with one id, the one
    with the least hash counts; null ids and labels are passed over; without rows, or with
    labels of one kind, the model is a constant."""
    got = map_texts(
        training_texts(docs, training_rows(labels, label, max_train_rows)),
        lambda it: _rows(it, lambda x, b: [b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"]),
        "doc_id long, y double, x array<double>",
    ).orderBy("doc_id").toArrow()
    y = got.column("y").to_numpy()
    x = np.array(got.column("x").to_pylist(), float).reshape(len(y), len(FEATURES))
    return fit_additive(x, y, **how)


def score_quality(docs: DataFrame, model: AdditiveModel, *, threshold: float = 0.7, key: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Reads ``doc_id`` and ``text`` alone; other columns are ignored, but for ``key``, which
    may name a column to return too.  Null and empty texts score like a text without
    words; equal texts score alike; very long texts are read whole; a null ``doc_id`` stays
    null and is not held out; an empty table gives an empty one."""
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), *([key] if key else []))
    docs = docs.select(own.alias("doc_id"), F.col("text").cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        map_texts(docs, lambda it: _rows(it, lambda x, b: [pa.array(model.score(x))], ["score"]), f"doc_id {kind}, score double")
        .select("doc_id.*", "score")
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *([key] if key else []))
    )
