"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. All word n-grams of the benchmark's items are counted by the different items that hold them, so
   copies of an item do not make its grams common.
2. The seeds of an item are its grams that at most ``RARE`` items hold, and in any case the rarest
   three quarters of its grams.  A phrase of all items is no seed of an item that has grams of its own, and pairs
   no document with it; it is one of an item that is nothing else.  A document that kept none of the
   rarest three quarters of an item's grams is no copy of it.
3. Seeds that a document hits join it to items on a diagonal; around it, the document's words are
   aligned with the item's, unless too few of the item's words are there at all to reach
   the score, which frequent phrases seldom pass.  The local alignment score, over that of a perfect copy,
   finds copies that were edited, cut or extended.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm import textkernels as K
from spanloom.llm.work import keep_keys, map_texts, stage

#: Benchmark n-grams with their places that ride along in each task (8 bytes a distinct gram) and that are
#: broadcast (24 bytes a place); beyond, the joins shuffle.
TASK_GRAMS = 2_000_000
#: Benchmark words that ride along in each task for alignment (8 bytes each); beyond, items are joined to their seeds.
TASK_WORDS = 4_000_000
#: Seeds of one document that a row carries; a document with more stands in several rows.
SEEDS = 512
#: Cells (document words times rows) that are aligned at a time.
CELLS = 1 << 20
#: Diagonals that start one alignment.
SLOT = 16
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Items that may share a rare gram, and the share of an item's grams that are its seeds in any case.
RARE, RAREST = 8, 0.75


def _hashed(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[data]
    s, e, first = K.words(low, off, K.ALNUM)
    return K.word_hash(low, s, e), first


def _grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, text numbers and word positions of all n-grams; a shorter text is one gram."""
    g, off = K.shingles(h, first, n)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return g, doc, np.arange(len(g)) - off[:-1][doc]


def _gram_rows(batches, n: int, only: np.ndarray | None):
    for b in batches:
        data, off = K.texts(b.column("text"))
        ids = b.column("id")
        for i, j, d, o in K.chunks(data, off):
            g, doc, pos = _grams(*_hashed(d, o), n)
            if only is not None:
                at = np.minimum(np.searchsorted(only, g), max(0, len(only) - 1))
                hit = only[at] == g if len(only) else np.zeros(len(g), bool)
                g, doc, pos = g[hit], doc[hit], pos[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), ids.slice(i, j - i).take(pa.array(doc)), pa.array(pos.astype(np.int32))],
                ["gram", "id", "pos"],
            )


def seed_grams(own: DataFrame) -> DataFrame:
    """The rows of ``gram, item_id, item_pos`` whose gram is a seed of its item.

    Items of the same grams count as one.  An item's grams meet in one task, as an item is one text."""
    kind = own.groupBy("item_id").agg(F.bit_xor(F.xxhash64("gram", "item_pos")).alias("x"), F.sum(F.xxhash64("gram").cast("decimal(20,0)")).alias("y"))
    held = own.join(kind, "item_id")
    common = held.groupBy("gram").agg(F.countDistinct("x", "y").alias("n_items"))
    held = held.join(common, "gram")
    rank = Window.partitionBy("item_id").orderBy("n_items", "gram", "item_pos")
    ranked = held.withColumns({"nth": F.row_number().over(rank), "all": F.count("*").over(Window.partitionBy("item_id"))})
    bound = ranked.where(F.col("nth") <= F.ceil(F.col("all") * RAREST)).groupBy("item_id").agg(F.greatest(F.max("n_items"), F.lit(RARE)).alias("most"))
    return held.join(bound, "item_id").where("n_items <= most").select("gram", "item_id", "item_pos")


def align(doc: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of rows of two padded word arrays (0 pads ``doc``, 1 pads ``item``),
    and the document word after which each best local alignment ends.

    Vectorised over rows and over the document's words; a gap along the document is
    a running maximum, as its cost is linear."""
    rows, width = doc.shape
    prev = np.zeros((rows, width + 1), np.float32)
    best, end = np.zeros(rows, np.float32), np.zeros(rows, np.int64)
    ramp = np.arange(width + 1, dtype=np.float32) * np.float32(-GAP)
    for j in range(item.shape[1]):
        same = np.where(doc == item[:, j : j + 1], np.float32(MATCH), np.float32(MISMATCH))
        now = np.zeros_like(prev)
        now[:, 1:] = np.maximum(np.maximum(prev[:, :-1] + same, prev[:, 1:] + np.float32(GAP)), 0)
        now = np.maximum.accumulate(now + ramp, axis=1) - ramp
        top = now.argmax(1)
        value = now[np.arange(rows), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        prev = now
    return best, end


def _alignments(batches, items: dict[int, np.ndarray] | None, share: float):
    """Pairs that reach ``share``.  Items come as hashed words, or, with None, as texts beside their seeds.

    A gap costs GAP and a perfect copy scores MATCH for each word, so an alignment that
    reaches ``share`` strays from its seed's diagonal by at most ``slack`` words."""
    for b in batches:
        out = []
        data, off = K.texts(b.column("text"))
        seeds = b.column("seeds").to_pylist()
        for i, j, d, o in K.chunks(data, off):
            h, first = _hashed(d, o)
            todo = []
            for x in range(i, j):
                own = h[first[x - i] : first[x - i + 1]]
                if items is None:
                    iw, at = _hashed(*K.texts(pa.array([s["item"] for s in seeds[x]], pa.string())))
                for k, s in enumerate(seeds[x]):
                    word = iw[at[k] : at[k + 1]] if items is None else items[s["item_id"]]
                    slack = int(np.ceil(MATCH * len(word) * (1 - share) / -GAP))
                    lo = max(0, s["diagonal"] - slack)
                    window = own[lo : s["diagonal"] + len(word) + slack + SLOT]
                    # each of the item's words adds at most MATCH, and only if the window has it
                    if np.isin(word, window).sum() >= share * len(word) - 1e-9:
                        todo.append((x, s["item_id"], word, lo, window))
            todo.sort(key=lambda t: len(t[4]))
            while todo:
                n, widest = 1, len(todo[0][4])
                while n < len(todo) and (n + 1) * max(widest, len(todo[n][4])) <= CELLS:
                    widest = max(widest, len(todo[n][4]))
                    n += 1
                part, todo = todo[:n], todo[n:]
                dm, im = np.zeros((n, widest), np.uint64), np.ones((n, max(len(t[2]) for t in part)), np.uint64)
                for r, t in enumerate(part):
                    dm[r, : len(t[4])], im[r, : len(t[2])] = t[4], t[2]
                best, end = align(dm, im)
                for t, v, e in zip(part, best.tolist(), end.tolist()):
                    score = v / (MATCH * len(t[2]))
                    if score >= share:
                        out.append((t[0], t[1], score, t[3] + e))
        row, item, score, end = zip(*out) if out else ([],) * 4
        yield pa.RecordBatch.from_arrays(
            [b.column("id").take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(end, pa.int64())],
            ["id", "item_id", "score", "end_word"],
        )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, n: int = 4, score: float = 0.5, key: str | None = None
) -> DataFrame:
    """Document-item pairs whose best local alignment scores at least ``score`` of a perfect copy.

    Returns ``doc_id, item_id, score, end_word, seed_hits``: one row per pair.  Words are
    runs of letters, digits and characters beyond ASCII, without case.  Items or documents
    without words match nothing; a document shorter than ``n`` words is one gram; null ids
    are skipped; repeated rows of a document or of an item count once; other columns are
    ignored; an empty table on either side gives an empty one; very long texts are aligned
    in windows around their seeds, so memory does not follow them.  ``key`` may name a
    column that is different in each row: rows then count each, null ids too, and it is
    returned.

    The benchmark's grams and words ride along with the tasks while a count finds at most
    TASK_GRAMS and TASK_WORDS; beyond, grams and items are joined by shuffles."""
    number = F.col("doc_id").cast("long")
    if key:
        docs = docs.select(F.struct(number.alias("doc_id"), F.col(key).alias("own")).alias("id"), F.col("text").cast("string"))
    else:
        docs = docs.select(number.alias("id"), F.col("text").cast("string")).where("id is not null")
    kind = docs.schema["id"].dataType.simpleString()
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string"))
        .where("id is not null and text is not null")
        .groupBy("id")
        .agg(F.min("text").alias("text"))
    )
    own = stage(map_texts(items, lambda it: _gram_rows(it, n, None), "gram long, id long, pos int"), "grams")
    own = stage(seed_grams(own.select("gram", F.col("id").alias("item_id"), F.col("pos").alias("item_pos"))), "seeds")
    distinct = own.select("gram").distinct()
    few = own.limit(TASK_GRAMS + 1).count() <= TASK_GRAMS
    schema = f"gram long, id {kind}, pos int"
    if few:
        only = np.sort(distinct.toArrow().column("gram").to_numpy().view(np.uint64))
        hits = map_texts(docs, lambda it: _gram_rows(it, n, only), schema)
    else:
        hits = map_texts(docs, lambda it: _gram_rows(it, n, None), schema).join(distinct, "gram", "left_semi")
    hits = stage(hits, "hits")

    # close diagonals start one alignment
    pairs = (
        hits.join(F.broadcast(own) if few else own, "gram")
        .withColumn("diagonal", F.col("pos") - F.col("item_pos"))
        .groupBy("id", "item_id", F.floor(F.col("diagonal") / SLOT).alias("slot"))
        .agg(F.min("diagonal").alias("diagonal"), F.count("*").alias("seed_hits"))
    )
    pairs = stage(pairs, "pairs")
    parts = pairs.groupBy("id").agg(F.ceil(F.count("*") / SEEDS).alias("parts"))
    seeds = pairs.join(parts, "id").withColumn("part", F.pmod(F.xxhash64("item_id", "slot"), F.col("parts")))
    seed, words = F.struct("item_id", "diagonal"), None
    if items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"] <= 2 * TASK_WORDS:
        some = items.toArrow()
        h, first = _hashed(*K.texts(some.column("text")))
        words = {k: h[first[x] : first[x + 1]] for x, k in enumerate(some.column("id").to_pylist())}
    else:
        seeds = seeds.join(items.select(F.col("id").alias("item_id"), F.col("text").alias("item")), "item_id")
        seed = F.struct("item_id", "diagonal", "item")
    todo = stage(seeds.groupBy("id", "part").agg(F.collect_list(seed).alias("seeds")).drop("part"), "todo")
    texts = keep_keys(docs, todo.select("id"), ["id"])  # never the lists are broadcast, at most the ids
    found = map_texts(
        texts.join(todo, "id"), lambda it: _alignments(it, words, score), f"id {kind}, item_id long, score double, end_word long"
    )
    best = found.groupBy("id", "item_id").agg(F.max(F.struct("score", "end_word")).alias("best"))
    hit = pairs.groupBy("id", "item_id").agg(F.sum("seed_hits").alias("seed_hits"))
    doc_id = [F.col("id.doc_id"), F.col("id.own").alias(key)] if key else [F.col("id").alias("doc_id")]
    return best.join(hit, ["id", "item_id"]).select(
        doc_id[0], "item_id", F.col("best.score").alias("score"), F.col("best.end_word").alias("end_word"), "seed_hits", *doc_id[1:]
    )
