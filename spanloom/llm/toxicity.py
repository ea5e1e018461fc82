"""Toxicity by a weighted finite-state pattern grammar.

Words are read as symbols (insult, threat, target, negation, report, other).  Five
machines are composed into one that accepts patterns of a clause: an insult pays once
the clause has a word that it may be said of, or is called out, a threat once a target is
threatened; a negation lowers the weight of the next hostile word, a word of reported
speech or of mention that of all that follow; a target, before or after,
raises the weight of the whole clause.  A hostile word that stands alone is no pattern and pays
nothing.  A document is scored from its matched clauses.

The insult words and stems are induced from labelled rows.  A term is counted by the
distinct contexts (the words before and after) it has in toxic and in clean documents,
so many copies of one toxic text count once, and it is learned only if a Chernoff bound
rules out that so many toxic contexts of so few in all are chance for any term.  The
weights of the machines' arcs are learned too, each held near a prior as far as the rows
do not speak against it.  Rows of negated and reported clauses, told to be clean, stand beside
the labelled ones, as corpora seldom hold enough of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.quality import held_out, training_rows, training_texts
from spanloom.llm.work import map_texts, stage

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Closed word classes in the four languages of the corpus.
TARGETS = "you your yours he she they them him her du dich dir ihr euch tu toi te vous ils elles usted ustedes ellos tú".split()
NEGATIONS = "not never no nobody nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = "said says wrote writes quoted claimed called word term dictionary noun sagte schrieb wort begriff dit écrit mot dijo escribió palabra".split()
THREATS = "kill murder stab strangle töten umbringen tuer égorger matar degollar".split()

#: Clauses and what ends each.  A clause that is called out has somebody to hear it, so an insult in it is said of a person.
CLAUSE = re.compile(r"([^.!?;:\n]+)([.!?;:\n]*)")
WORD = re.compile(r"[^\W\d_]+")
HOSTILE = (INSULT, THREAT)

#: Arc weights before any row is seen: factors of a hostile word's weight.
PRIOR = {"threat": 1.0, "target": 1.5, "negation": 0.05, "report": 0.05}
#: A negation or report never keeps more of a hostile word's weight.
MOST_LOWERED = 0.2


@dataclass(frozen=True)
class Machine:
    """Arcs (state, symbol) -> state, where a missing arc stays; ``marks`` are the (state, symbol) that carry its weight."""

    states: int
    arcs: dict[tuple[int, int], int]
    marks: frozenset[tuple[int, int]]

    def step(self, state: int, symbol: int) -> tuple[int, bool]:
        return self.arcs.get((state, symbol), state), (state, symbol) in self.marks


HOSTS = (OTHER, TARGET)


def insult() -> Machine:
    """State 1 once the clause has a word that an insult may be said of, 2 while an insult waits for one.

    Marks say that insults are paid: at an insult after such a word, at the word for those that wait."""
    arcs = {(0, h): 1 for h in HOSTS} | {(0, INSULT): 2} | {(2, h): 1 for h in HOSTS}
    return Machine(3, arcs, frozenset({(1, INSULT)} | {(2, h) for h in HOSTS}))


def threat() -> Machine:
    """State 1 after a threat, 2 after a target, 3 once both are there: only then the clause's threats are paid."""
    return Machine(4, {(0, THREAT): 1, (0, TARGET): 2, (1, TARGET): 3, (2, THREAT): 3}, frozenset({(0, THREAT), (1, THREAT), (2, THREAT), (3, THREAT)}))


def target() -> Machine:
    """State 1 once somebody is meant; its weight is paid at the end of the clause."""
    return Machine(2, {(0, TARGET): 1}, frozenset())


def negation() -> Machine:
    """State 1 after a negation, until the next hostile word, which carries the weight."""
    return Machine(2, {(0, NEGATION): 1} | {(1, h): 0 for h in HOSTILE}, frozenset((1, h) for h in HOSTILE))


def report() -> Machine:
    """State 1 after a verb of reported speech; hostile words then carry the weight."""
    return Machine(2, {(0, REPORT): 1}, frozenset((1, h) for h in HOSTILE))


def compose(machines: list[Machine]) -> list[list[tuple[int, int]]]:
    """The product machine, all reading each symbol: by state and symbol, the next state and the marks as bits."""
    size = 1
    for m in machines:
        size *= m.states
    table = []
    for state in range(size):
        row = []
        for symbol in range(6):
            rest, place, after, marks = state, 1, 0, 0
            for k, m in enumerate(machines):
                rest, own = divmod(rest, m.states)
                to, marked = m.step(own, symbol)
                after += to * place
                marks |= marked << k
                place *= m.states
            row.append((after, marks))
        table.append(row)
    return table


GRAMMAR = compose([insult(), threat(), target(), negation(), report()])
_PAY_INSULT, _IS_THREAT, _NEGATED, _REPORTED = 1, 2, 8, 16
#: Classes of what a clause pays: threat or insult, negated, reported, aimed.
N_CLASSES = 16


def read_clause(symbols: list[tuple[int, float]], grammar: list[list[tuple[int, int]]] = GRAMMAR) -> list[tuple[int, float]]:
    """The weights that a clause of (symbol, word weight) pays, by class; empty where it matches no pattern."""
    state, paid, waiting, threats = 0, [], [], []
    for symbol, weight in symbols:
        state, marks = grammar[state][symbol]
        if symbol in HOSTILE:
            kind = 8 * bool(marks & _IS_THREAT) + 4 * bool(marks & _NEGATED) + 2 * bool(marks & _REPORTED)
            (threats if symbol == THREAT else waiting).append((kind, weight))
        if marks & _PAY_INSULT:
            paid += waiting
            waiting = []
    threatened, aimed = state // 3 % 4 == 3, state // 12 % 2
    return [(kind + aimed, weight) for kind, weight in paid + (threats if threatened else [])]


def class_factors(arcs: dict[str, float]) -> np.ndarray:
    """The product of the arc weights that each class went over."""
    c = np.arange(N_CLASSES)
    return np.prod([np.where(c & bit, arcs[name], 1.0) for bit, name in ((8, "threat"), (4, "negation"), (2, "report"), (1, "target"))], axis=0)


@dataclass
class Lexicon:
    """Weights of hostile words and of stems (words that begin so)."""

    words: dict[str, float]
    stems: dict[str, float]
    threat: float = 4.0

    def pattern(self) -> re.Pattern | None:
        known = [re.escape(w) for w in sorted({*self.words, *THREATS}, reverse=True)]
        stems = [re.escape(s) for s in sorted(self.stems, reverse=True)]
        parts = [rf"(?:{'|'.join(known)})(?![^\W\d_])"] if known else []
        parts += [f"(?:{'|'.join(stems)})"] if stems else []
        return re.compile(rf"(?<![^\W\d_])(?:{'|'.join(parts)})") if parts else None

    def symbol(self, word: str) -> tuple[int, float]:
        if (w := self.words.get(word)) is not None:
            return INSULT, w
        for n in range(4, min(len(word), 12) + 1):
            if (w := self.stems.get(word[:n])) is not None:
                return INSULT, w
        symbol = _CLOSED.get(word, OTHER)
        return symbol, self.threat if symbol == THREAT else 0.0


_CLOSED = (
    dict.fromkeys(TARGETS, TARGET) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(REPORTS, REPORT) | dict.fromkeys(THREATS, THREAT)
)


def clause_features(text: str, lexicon: Lexicon, pattern: re.Pattern | None) -> list[float]:
    """Of the matched clauses: sums of weights by class; then how many there are, and how many clauses in all."""
    out = [0.0] * (N_CLASSES + 2)
    low = text.lower()
    if pattern is None or not pattern.search(low):
        return out
    for clause, end in CLAUSE.findall(low):
        out[N_CLASSES + 1] += 1
        if not pattern.search(clause):
            continue
        paid = read_clause([lexicon.symbol(w) for w in WORD.findall(clause)] + [(OTHER, 0.0)] * ("!" in end))
        for kind, weight in paid:
            out[kind] += weight
        out[N_CLASSES] += bool(paid)
    return out


def _hostility(x: np.ndarray, arcs: dict[str, float]) -> np.ndarray:
    """Logs of the weight that a document's clauses pay, and of its share per clause."""
    paid = x[:, :N_CLASSES] @ class_factors(arcs)
    return np.log1p(np.column_stack([paid, paid / np.maximum(1, x[:, N_CLASSES + 1])]))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    arcs: dict[str, float]
    weights: np.ndarray  # of the two logs of hostility, then the intercept

    def score(self, x: np.ndarray) -> np.ndarray:
        z = _hostility(x, self.arcs) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Newton steps of a ridge logistic regression, and its log loss; weights of hostility never fall below zero."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-3]
    p = np.full(len(x), 0.5)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        h = full.T @ (full * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(penalty)
        w = w + np.linalg.solve(h, full.T @ (y - p) - penalty * w)
        w[:-1] = np.maximum(w[:-1], 0)
    p = np.clip(1 / (1 + np.exp(-np.clip(full @ w, -30, 30))), 1e-12, 1 - 1e-12)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def _told(x: np.ndarray, y: np.ndarray, share: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """The rows, and as many as ``share`` of them of each negated or reported class: one clause with twice a usual weight, clean."""
    weights = x[:, :N_CLASSES][x[:, :N_CLASSES] > 0]
    usual = 2 * float(np.median(weights)) if len(weights) else 4.0
    classes = [c for c in range(N_CLASSES) if c & 6]
    told = np.zeros((len(classes), x.shape[1]))
    told[np.arange(len(classes)), classes] = usual
    told[:, N_CLASSES:] = 1
    n = max(3, int(share * len(x)))
    return np.vstack([x, np.repeat(told, n, 0)]), np.concatenate([y, np.zeros(n * len(classes))])


def _fit(x: np.ndarray, y: np.ndarray, prior_rows: float = 5.0) -> tuple[dict[str, float], np.ndarray]:
    """Arc weights by coordinate steps on the log loss, and the regression on them.

    Moving an arc by a factor e from its prior must win as much as ``prior_rows`` nats.  Beside the rows stand
    ``_told`` ones: a clause that is negated or reported is clean, however hostile its words."""
    arcs = dict(PRIOR)
    if not len(x) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-3), 1 - 1e-3)
        return arcs, np.array([1.0, 0.0, np.log(share / (1 - share))])

    x, y = _told(x, y)

    def loss(try_: dict[str, float]) -> tuple[float, np.ndarray]:
        if max(try_["negation"], try_["report"]) > MOST_LOWERED:
            return np.inf, np.zeros(3)
        w, nats = _logistic(_hostility(x, try_), y)
        return nats + prior_rows * sum(np.log(try_[k] / PRIOR[k]) ** 2 for k in PRIOR), w

    best, w = loss(arcs)
    for step in (2.0, 1.4, 1.15):
        for k in PRIOR:
            for factor in (step, 1 / step):
                while True:
                    try_ = arcs | {k: arcs[k] * factor}
                    value, ww = loss(try_)
                    if value >= best - 1e-9:
                        break
                    arcs, best, w = try_, value, ww
    return arcs, w


def train_toxicity(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", max_train_rows: int = 20_000, chance: float = 0.01, odds: float = 25.0,
) -> ToxicityModel:
    """Induce the lexicon and fit the weights on at most ``max_train_rows`` labelled documents.

    Terms are whole words (``=word``) and stems of 4 to 12 letters (``^stem``) whose odds in
    toxic documents are ``odds`` times those in clean ones, and that pass the bound on
    ``chance`` over all terms.  All of them count.  A term needs several contexts of its own
    in the chosen documents, so these bound the lexicon; the driver also holds eighteen
    numbers for each of them.  Of several texts with one id, the one with the least hash
    counts; null ids and labels are passed over; a null text is empty."""
    chosen = training_rows(labels, label, max_train_rows)
    train = stage(training_texts(docs, chosen).withColumn("text", F.coalesce("text", F.lit(""))), "train")
    words = train.select(
        "y", F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)).alias("words")
    ).select("y", "words", F.posexplode("words").alias("at", "word"))
    around = F.xxhash64(F.expr("get(words, at - 1)"), F.expr("get(words, at + 1)"))
    per_word = (
        words.select("word", "y", around.alias("around"))
        .distinct()
        .groupBy("word")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )
    per_word = stage(per_word, "word")
    n = per_word.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("kinds")).first()
    n_pos, n_neg, n_kinds = n["pos"] or 0.0, n["neg"] or 0.0, n["kinds"] or 1
    lexicon = Lexicon({}, {})
    if n_pos and n_neg:
        stems = F.explode(F.transform(F.sequence(F.lit(4), F.least(F.lit(12), F.length("word"))), lambda k: F.col("word").substr(F.lit(1), k)))
        per_stem = (
            per_word.where("length(word) >= 4")
            .select(stems.alias("stem"), "pos", "neg")
            .groupBy("stem")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("kinds"))
            .where("kinds >= 3")
        )
        # a stem that goes on in one way only is the longer one
        longer = per_stem.groupBy(F.expr("left(stem, length(stem) - 1)").alias("stem")).agg(F.max("pos").alias("next"))
        per_stem = per_stem.join(longer, "stem", "left").where("next is null or next < 0.98 * pos")
        both = per_word.select(F.concat(F.lit("="), "word").alias("term"), "pos", "neg").unionByName(
            per_stem.select(F.concat(F.lit("^"), "stem").alias("term"), "pos", "neg")
        )
        p = n_pos / (n_pos + n_neg)
        share = F.col("pos") / (F.col("pos") + F.col("neg"))
        # n * KL(share || p): the log of the bound on the chance of such a share
        bound = F.col("pos") * F.log(share / p) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - p))).otherwise(0.0)
        rate = F.col("pos") / n_pos / ((F.col("neg") + 0.5) / n_neg)
        top = (
            both.where("pos > 0")
            .where((share > p) & (rate >= odds) & (bound >= float(np.log(n_kinds / chance))))
            .orderBy(F.desc("pos"), "neg", "term")
        )
        for r in top.collect():
            weight = float(np.log((r["pos"] + 0.5) / n_pos / ((r["neg"] + 0.5) / n_neg)))
            (lexicon.words if r["term"][0] == "=" else lexicon.stems)[r["term"][1:]] = weight
        if lexicon.words:
            lexicon.threat = float(np.mean(list(lexicon.words.values())))
    got = map_texts(
        train.select("doc_id", "text", "y"),
        lambda it: _rows(it, lexicon, lambda x, b: [b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"]),
        "doc_id long, y double, x array<double>",
    ).orderBy("doc_id").toArrow()
    y = got.column("y").to_numpy()
    x = np.array(got.column("x").to_pylist(), float).reshape(len(y), N_CLASSES + 2)
    return ToxicityModel(lexicon, *_fit(x, y))


def _rows(batches, lexicon: Lexicon, extra, kinds):
    pattern = lexicon.pattern()
    for b in batches:
        for i in range(0, b.num_rows, 1024):
            part = b.slice(i, 1024)
            x = np.array([clause_features(t or "", lexicon, pattern) for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *extra(x.reshape(part.num_rows, -1), part)], ["doc_id", *kinds]
            )


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.3) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted, clauses`` (matched clauses).

    Reads ``doc_id`` and ``text`` alone; other columns are ignored.  Null and empty texts
    have no clause and get the lowest score, like all texts without a hostile word; equal
    texts score alike; very long texts are read whole; a null ``doc_id`` stays null and is
    not held out; an empty table gives an empty one."""
    return map_texts(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        lambda it: _rows(
            it, model.lexicon, lambda x, b: [pa.array(model.score(x)), pa.array(x[:, N_CLASSES].astype(np.int64))], ["score", "clauses"]
        ),
        "doc_id long, score double, clauses long",
    ).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "clauses")
