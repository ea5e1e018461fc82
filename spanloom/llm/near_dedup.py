"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One pass hashes each text into its set of k-word shingles, a signature of
   ``bands * rows`` minima, and band keys.  Texts with equal sets form a class.
2. Classes that share a band key are candidates.  A comparison reads signatures in
   batches.  After each, the posterior of the similarity (uniform prior) is bounded: a
   pair is dropped when it reaches the threshold with probability under ``miss``.
3. Only links between components matter.  Bands are taken in turns.  In each turn, every
   component sends one member to a bucket; members are compared in blocks, and of the
   survivors the most similar that span a block (a forest, never all pairs of a group) are
   verified on their full sets.  So large groups of copies shrink to few components
   without ever being copied to many tasks.
4. The last round settles the buckets that still hold several components, with all
   members: each is compared with every member of another component.  The members of a
   bucket's largest component are dealt to blocks, each to one; the others visit every
   block.  Of members with a survivor, the full sets join the comparison, and a forest of
   the pairs that reach the threshold is emitted.  So all pairs of different components
   are judged, but pairs never become rows.
5. A component is named by its least ``doc_id``.
"""

from __future__ import annotations

from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import drop_stage, join_hot, keep_keys, map_texts, merged_components, stage

BATCH = 32
#: Members of a bucket that one task compares with as many others.
BLOCK = 1024
#: Shingles (8 bytes each) of such a block, so that few very long texts fit too.
BLOCK_SHINGLES = 4_000_000
#: Ends of the runs of bands that are taken in turns; all bands beyond the last.
TURNS = (4,)


#: Seeds of the hashes of words: of signatures and classes, and, with nothing in common, of the sets that links are verified on.
SIGN, VERIFY = 1, 2


def _sets(data: np.ndarray, off: np.ndarray, k: int, seed: int = SIGN) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[data]
    s, e, first = K.words(low, off, K.NOT_BLANK)
    return K.shingles(K.word_hash(low, s, e, seed), first, k)


def _sign(batches, k: int, bands: int, rows: int):
    rng = np.random.default_rng(20240607)
    n_hash = bands * rows
    mul = (rng.integers(0, 1 << 31, n_hash, dtype=np.uint64) * 2 + 1).astype(np.uint32)
    add = rng.integers(0, 1 << 32, n_hash, dtype=np.uint64).astype(np.uint32)
    band_no = np.arange(bands, dtype=np.uint64)[None, :] * K.U64(0xD6E8FEB86659FD93)
    for b in batches:
        data, off = K.texts(b.column("text"))
        ids = b.column("row")
        for i, j, d, o in K.chunks(data, off):
            h, so = _sets(d, o, k)
            n = np.zeros(j - i, np.int64)
            key = np.zeros((j - i, 2), np.uint64)
            for x in range(j - i):
                if so[x] < so[x + 1]:
                    own = np.sort(h[so[x] : so[x + 1]])
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                    n[x] = len(own)
                    key[x, 0] = own.sum(dtype=np.uint64)
                    key[x, 1] = K.mix(own ^ K.U64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64)
            full = np.flatnonzero(n)
            sig = np.zeros((n_hash, len(full)), np.uint32)
            if len(full):
                at = so[:-1][full]
                x32 = (h >> K.U64(32)).astype(np.uint32)
                buf = np.empty_like(x32)
                for f in range(n_hash):
                    np.multiply(x32, mul[f], out=buf)
                    np.add(buf, add[f], out=buf)
                    sig[f] = np.minimum.reduceat(buf, at)
            sig = np.ascontiguousarray(sig.T)
            key = K.mix(key + n.astype(np.uint64)[:, None])
            part = sig.reshape(len(full), bands, rows).astype(np.uint64)
            hashed = np.broadcast_to(band_no, (len(full), bands)).copy()
            for r in range(rows):
                hashed = K.mix(hashed * K.U64(0x9FB21C651E98DF25) + part[:, :, r])
            small = (sig & np.uint32(0xFFFF)).astype(np.uint16)
            of = np.full(j - i, -1)
            of[full] = np.arange(len(full))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(i, j - i),
                    pa.array(n),
                    pa.array([key[x].tobytes() if n[x] else None for x in range(j - i)], pa.binary()),
                    pa.array([hashed[of[x]].view(np.int64) if n[x] else None for x in range(j - i)], pa.list_(pa.int64())),
                    pa.array([small[of[x]].tobytes() if n[x] else None for x in range(j - i)], pa.binary()),
                ],
                ["row", "n_shingles", "cls", "bands", "sig"],
            )


@cache
def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches among n minima with P(similarity >= threshold) >= miss, uniform prior."""
    t, total = threshold, 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def survive(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the row pairs of two signature arrays that no batch prunes, and their matches."""
    left = np.arange(len(a))
    hits = np.zeros(len(a), np.int64)
    n = 0
    while n < a.shape[1] and len(left):
        more = min(BATCH, a.shape[1] - n)
        hits = hits + (a[left, n : n + more] == b[left, n : n + more]).sum(1)
        n += more
        ok = hits >= least_matches(n, threshold, miss)
        left, hits = left[ok], hits[ok]
    return left, hits


def _matrix(column: pa.ChunkedArray, kind=np.uint16) -> np.ndarray:
    """A binary column of equal lengths as rows of numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 1), kind)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), -1)


def _survivors(table: pa.Table, i: int, j: int, threshold: float, miss: float):
    """For each row of block ``i``, the rows of block ``j`` (later ones, if that is the same) of other
    components that survive, and their matches."""
    block = table.column("block").to_numpy()
    sig = _matrix(table.column("sig"))
    comp = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    first = least_matches(min(BATCH, sig.shape[1]), threshold, miss)
    for x in left:
        others = right[right > x] if i == j else right
        others = others[comp[others] != comp[x]]
        if len(others):
            others = others[(sig[others, :BATCH] == sig[x, :BATCH]).sum(1) >= first]
            keep, hits = survive(np.broadcast_to(sig[x], (len(others), sig.shape[1])), sig[others], threshold, miss)
            if len(keep):
                yield x, others[keep], hits


def _forest(table: pa.Table, found: list[tuple]) -> pa.Table:
    """Of (row, rows, similarities), the best pairs that join what no better pair has joined."""
    cls = table.column("cls").to_pylist()
    comp = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
    pairs = []
    if found:
        a = np.concatenate([np.full(len(y), x) for x, y, _ in found])
        b, like = np.concatenate([y for _, y, _ in found]), np.concatenate([v for _, _, v in found])
        root = list(range(len(cls)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        order = np.argsort(-like, kind="stable")
        for x, y, cx, cy in zip(a[order].tolist(), b[order].tolist(), comp[a[order]].tolist(), comp[b[order]].tolist()):
            cx, cy = top(cx), top(cy)
            if cx != cy:
                root[cx] = cy
                pairs.append(sorted((cls[x], cls[y])))
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})


def _likely_forest(key, table: pa.Table, threshold: float, miss: float) -> pa.Table:
    i = key[1].as_py()
    return _forest(table, list(_survivors(table, i, i, threshold, miss)))


def _open_members(key, table: pa.Table, threshold: float, miss: float) -> pa.Table:
    """The members of two blocks that survive with a member of another component."""
    hit = np.zeros(table.num_rows, bool)
    for x, others, _ in _survivors(table, key[1].as_py(), key[2].as_py(), threshold, miss):
        hit[x] = True
        hit[others] = True
    return table.select(["bucket", "i", "j", "block", "cls", "comp", "sig"]).filter(pa.array(hit))


def _exact_forest(key, table: pa.Table, threshold: float, miss: float, percent: int) -> pa.Table:
    """As ``_likely_forest``, of the pairs whose full sets reach the threshold."""
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("set").combine_chunks()]
    size = np.array([len(s) for s in sets], np.int64)
    found = []
    for x, others, _ in _survivors(table, key[1].as_py(), key[2].as_py(), threshold, miss):
        both = np.zeros(len(others), np.int64)
        for k, y in enumerate(others):
            # the smaller set is looked up, and only where sizes allow the threshold at all
            s, t = (sets[x], sets[y]) if size[x] <= size[y] else (sets[y], sets[x])
            if 100 * len(s) >= percent * len(t):
                both[k] = np.count_nonzero(t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s)
        union = size[x] + size[others] - both
        ok = 100 * both >= percent * union
        if ok.any():
            found.append((x, others[ok], both[ok] / union[ok]))
    return _forest(table, found)


def _set_rows(batches, k: int):
    """The shingle sets of texts, as sorted 64-bit hashes that are independent of those of the signatures."""
    for b in batches:
        data, off = K.texts(b.column("text"))
        for i, j, d, o in K.chunks(data, off):
            h, so = _sets(d, o, k, VERIFY)
            own = [np.unique(h[so[x] : so[x + 1]]).tobytes() for x in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column("cls").slice(i, j - i), pa.array(own, pa.binary())], ["cls", "set"])


def _verify(batches, percent: int):
    for b in batches:
        keep = []
        for x, (ra, rb) in enumerate(zip(b.column("set_a"), b.column("set_b"))):
            sa, sb = np.frombuffer(ra.as_buffer(), np.uint64), np.frombuffer(rb.as_buffer(), np.uint64)
            both = len(np.intersect1d(sa, sb, assume_unique=True))
            if 100 * both >= percent * (len(sa) + len(sb) - both):
                keep.append(x)
        yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))


PAIR = "a binary, b binary"


def near_duplicates(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int | None = None, miss: float = 1e-5,
    key: str | None = None,
) -> DataFrame:
    """Components of documents whose word-shingle sets have Jaccard similarity of at least ``percent`` / 100.

    Reads ``doc_id`` and ``text``; other columns are ignored.  Returns one row per
    input row: ``doc_id, n_shingles, component_id, kept``.  Null or blank texts have
    an empty set and link with nothing; equal rows fall in one class; rows without
    ``doc_id`` keep a null id and take part in links, but name no component; an
    empty table gives an empty one.  Very long texts are read whole.  ``key`` may name a
    column that is different in each row: it is then returned too, and exactly one row of
    each component is kept, of those with the least ``doc_id`` the one with the least key.

    A link at the very threshold is missed with probability (1 - s**rows)**bands, and less
    above; ``rows`` is by default the most, up to 8, that keep it under 1e-4 (8 at 0.85, 6
    at 0.8)."""
    threshold = percent / 100
    rows = rows or next((r for r in range(8, 1, -1) if (1 - threshold**r) ** bands < 1e-4), 1)
    own = F.col(key) if key else F.xxhash64("text")
    docs = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), own.alias("own")).alias("row"), F.col("text").cast("string"))
    kind = docs.schema["row"].dataType.simpleString()
    signed = stage(
        map_texts(
            docs, lambda it: _sign(it, shingle, bands, rows), f"row {kind}, n_shingles long, cls binary, bands array<long>, sig binary"
        ),
        "sign",
    )
    classes = stage(
        signed.where("cls is not null")
        .groupBy("cls")
        .agg(F.min("row").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "class",
    )
    sigs = classes.select("cls", "sig")

    member = classes.select("cls", "n", F.posexplode("bands").alias("band", "bucket"))
    # buckets of the same members (their hashes' exclusive or, 128 bits) need one comparison
    size = (
        member.groupBy("bucket")
        .agg(
            F.count("*").alias("size"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"),
            F.min("band").alias("band"),
        )
        .where("size > 1")
    )
    size = stage(size.groupBy("size", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("least")).select("least.bucket", "size"), "size")
    member = stage(member.join(size.select("bucket"), "bucket"), "bucket")

    def sets_of(some: DataFrame) -> DataFrame:
        """``cls, set`` of the classes in ``some``, from the texts of their representatives."""
        ids = stage(some.select("cls").distinct().join(classes.select("cls", F.col("rep").alias("row")), "cls"), "ids")
        own = keep_keys(docs, ids.select("row"), ["row"]).join(ids, "row").dropDuplicates(["cls"])
        return stage(map_texts(own.select("cls", "text"), lambda it: _set_rows(it, shingle), "cls binary, set binary"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough."""
        pairs = stage(pairs.distinct(), "pair")
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cls")))
        a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
        return stage(map_texts(pairs.join(a, "a").join(b, "b"), lambda it: _verify(it, percent), PAIR), "link")

    def with_comp(rows: DataFrame) -> DataFrame:
        if comp is None:
            return rows.withColumn("comp", F.col("cls"))
        return rows.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))

    def in_blocks(n: Column, weight: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(weight / BLOCK_SHINGLES)).cast("int")

    comp = None
    # where every bucket fits a block, one turn compares all pairs
    turns = TURNS if (size.agg(F.max("size")).first()[0] or 0) > BLOCK else ()
    for lo, hi in zip((0, *turns), (*turns, bands)):
        reps = with_comp(member.where((F.col("band") >= lo) & (F.col("band") < hi))).groupBy("bucket", "comp").agg(F.min(F.struct("cls", "n")).alias("one"))
        reps = reps.select("bucket", "comp", "one.*")
        many = reps.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).where("size > 1")
        dealt = reps.join(many, "bucket").select(
            "bucket", F.pmod(F.xxhash64("cls", F.lit(lo)), in_blocks(F.col("size"), F.col("weight"))).cast("int").alias("block"), "cls", "comp"
        )
        likely = dealt.join(sigs, "cls").groupBy("bucket", "block").applyInArrow(lambda key, t: _likely_forest(key, t, threshold, miss), PAIR)
        comp = stage(merged_components(comp, verified(likely), "a", "b"), "comp")

    # what is left: buckets of several components, the largest of which needs no comparison within
    rest = with_comp(member.select("bucket", "cls", "n"))
    held = rest.groupBy("bucket", "comp").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    mixed = held.groupBy("bucket").agg(
        F.max_by("comp", F.struct("size", "comp")).alias("most"), F.count("*").alias("kinds"),
        F.max(F.struct("size", "comp", "weight")).alias("top"), F.sum("size").alias("size"), F.sum("weight").alias("weight"),
    ).where("kinds > 1")
    mixed = stage(
        mixed.select(
            "bucket", "most", in_blocks(F.col("top.size"), F.col("top.weight")).alias("large"),
            in_blocks(F.col("size") - F.col("top.size"), F.col("weight") - F.col("top.weight")).alias("small"),
        ),
        "mixed",
    )
    rest = rest.join(mixed, "bucket").withColumn("is_most", F.col("comp") == F.col("most"))
    # blocks of the largest component have negative numbers; a pair (i, j) has i >= 0 of the others
    own_block = F.when(F.col("is_most"), -1 - F.pmod(F.xxhash64("cls"), F.col("large"))).otherwise(F.pmod(F.xxhash64("cls"), F.col("small"))).cast("int")
    blocks = F.when(F.col("is_most"), F.sequence(F.lit(0), F.col("small") - 1)).otherwise(
        F.concat(F.sequence(-F.col("large"), F.lit(-1)), F.sequence(F.lit(0), F.col("small") - 1))
    )
    rest = rest.select("bucket", "cls", "comp", own_block.alias("block"), F.explode(blocks).alias("other"))
    first, second = F.when(F.col("block") < 0, F.col("other")).otherwise(F.col("block")), F.when(F.col("block") < 0, F.col("block")).otherwise(F.col("other"))
    ordered = F.col("other").between(0, F.col("block") - 1)  # two blocks of others: the lower first
    rest = rest.select(
        "bucket", F.when(ordered, second).otherwise(first).alias("i"), F.when(ordered, first).otherwise(second).alias("j"), "block", "cls", "comp"
    )
    open_ = stage(
        rest.join(sigs, "cls").groupBy("bucket", "i", "j").applyInArrow(
            lambda key, t: _open_members(key, t, threshold, miss),
            "bucket long, i int, j int, block int, cls binary, comp binary, sig binary",
        ),
        "open",
    )
    if open_.take(1):
        exact = open_.join(sets_of(open_), "cls").groupBy("bucket", "i", "j").applyInArrow(
            lambda key, t: _exact_forest(key, t, threshold, miss, percent), PAIR
        )
        comp = stage(merged_components(comp, exact.distinct(), "a", "b"), "comp")
    drop_stage(member, size, mixed, open_)

    # equal sets of a component meet by class; a component's rows are counted only by class
    least = with_comp(signed.where("cls is not null").groupBy("cls").agg(F.min(F.struct(F.col("row.doc_id").isNull(), "row")).alias("first"), F.count("*").alias("copies")))
    named = least.groupBy("comp").agg(F.min("first").alias("first")).select("comp", F.col("first.row").alias("first"))
    least = stage(least.select("cls", "comp", "copies").join(named, "comp").select("cls", "first", "copies"), "named")
    # texts without words have no class; joined, they would all meet in one task
    bare = signed.select("row", "n_shingles", "cls")
    out = join_hot(bare.where("cls is not null"), least, ["cls"], "copies").unionByName(bare.where("cls is null"), allowMissingColumns=True)
    out = out.withColumn("first", F.coalesce("first", "row"))
    if key:
        return out.select("row.doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col("row") == F.col("first")).alias("kept"), F.col("row.own").alias(key))
    return out.select(
        "row.doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"),
        F.coalesce(F.col("first.doc_id") == F.col("row.doc_id"), F.lit(False)).alias("kept"),
    )
