"""Removal of long repeats with a logarithmic family of sparse suffix arrays.

A window is a run of ``length`` bytes.  Its anchor is the place in it whose next ``ANCHOR``
bytes hash lowest (leftmost of equals), so equal windows have their anchors at the same
place.  Successive windows mostly share an anchor; the windows of one anchor form a
territory.  Only the suffixes at anchors are indexed: about one for each
(length - ANCHOR) / 2 bytes.

1. Documents come in batches.  Each batch gets its suffix array: the first ``ANCHOR`` bytes
   of its anchor suffixes, each once, in the order of those bytes.
2. The array is merged with the arrays of all levels into one sorted stream, cut into
   ranges of content.  The scan takes the longest common prefix of neighbours in the
   order; neighbours that agree in all ``ANCHOR`` bytes are matches.  The same scan writes
   the merged array of the levels that are of equal size, so there are as many levels as
   the number of batches has bits.  Levels are tables in a folder, and can be opened again.
3. Territories of matched suffixes that are equal in full (128-bit cryptographic digests)
   are repeats throughout.  Where only part may agree, at the edges of a repeat, the
   windows themselves are compared: in one task per suffix, where candidates by hash are
   verified on their bytes, or, for suffixes in very many places, by a pre-aggregated
   count of windows under 128 bits of hash, so no task holds an unbounded group.
4. All repeated windows of a document are joined to spans, and the rest is kept.

Passages of ``passage`` words that stand in two rows, often shorter than ``length`` bytes, are found
in the same way, with words for bytes: territories of runs of words are led by runs of ``GRAM``
words, equal ones are told by digests, and where only part may agree windows are compared.  Words
are 64-bit keyed hashes there.  Passages are counted, not removed.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import textkernels as K
from spanloom.llm.work import drop_stage, keep_keys, map_texts, stage, work_dir

#: Bytes of a suffix that the index holds and compares.
ANCHOR = 64
#: Words of a run that leads to passages.
GRAM = 16
#: Territories of one suffix that a task compares; beyond, windows are counted.
GROUP = 4000

ROWS = "doc_id long, same long, suffix binary, fp long, body binary, lo int, hi int, n int"
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("same", pa.int64()), ("suffix", pa.binary()), ("fp", pa.int64()), ("body", pa.binary()),
     ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int32())]
)
PASSAGE_ROWS = "doc_id long, same long, fp long, body binary, span int, los array<int>, fresh int"


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values, by prefix and suffix minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def areas(h: np.ndarray, off: np.ndarray, length: int):
    """Per territory: text number, first and last window start, anchor.  ``h`` hashes each place where an anchor can be."""
    n = int(off[-1])
    at = np.arange(len(h))
    bits = max(20, n.bit_length())
    low = lowest(((h >> K.U64(bits)) << K.U64(bits)) | at.astype(np.uint64), length - n + len(h))
    anchor = (low & K.U64((1 << bits) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(anchor)]
    ok = np.arange(len(anchor)) + length <= off[doc + 1]
    start = ok.copy()
    start[1:] &= ~(ok[:-1] & (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1]))
    lo = np.flatnonzero(start)
    stop = ok.copy()
    stop[:-1] &= ~(ok[1:] & (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1]))
    return doc[lo], lo, np.flatnonzero(stop), anchor[lo]


def territories(data: np.ndarray, off: np.ndarray, length: int):
    """Per territory: text number, first and last window start, anchor; and the prefix sums."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, None
    prefix = K.prefix_sum(data)
    at = np.arange(n - ANCHOR + 1)
    return *areas(K.span_hash(data, at, at + ANCHOR, prefix), off, length), prefix


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary column of the rows of a byte matrix."""
    n, width = rows.shape
    return pa.BinaryArray.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))]
    )


def _index(batches, length: int):
    for b in batches:
        data, off = K.texts(b.column("text"))
        ids, same = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("same").to_numpy()
        for i, j, d, o in K.chunks(data, off):
            doc, lo, hi, anchor, prefix = territories(d, o, length)
            if not len(lo):
                continue
            fp = K.span_hash(d, anchor, anchor + ANCHOR, prefix)
            raw = d.tobytes()
            # the digest covers the bytes and where the anchor stands in them
            body = np.frombuffer(
                b"".join(
                    hashlib.blake2b(raw[x : y + length], digest_size=16, salt=(z - x).to_bytes(4, "little")).digest()
                    for x, y, z in zip(lo.tolist(), hi.tolist(), anchor.tolist())
                ),
                np.uint64,
            ).reshape(-1, 2)
            # what repeats within a text is settled here: one row stands for it, the spans are joined
            order = np.lexsort((lo, body[:, 1], body[:, 0], doc))
            first = np.ones(len(lo), bool)
            first[1:] = (body[order][1:] != body[order][:-1]).any(1) | (doc[order][1:] != doc[order][:-1])
            run = np.flatnonzero(first)
            count = np.diff(np.append(run, len(lo)))
            keep = order[run]
            many = np.sort(order[np.repeat(count, count) > 1])
            suffix = np.lib.stride_tricks.sliding_window_view(d, ANCHOR)[anchor[keep]]
            base = o[doc[keep]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[i:j][doc[keep]].astype(np.int64)), pa.array(same[i:j][doc[keep]]), _fixed(suffix),
                    pa.array(fp[keep].view(np.int64)), _fixed(body[keep].view(np.uint8).reshape(-1, 16)),
                    pa.array((lo[keep] - base).astype(np.int32)), pa.array((hi[keep] - base).astype(np.int32)), pa.array(count.astype(np.int32)),
                ],
                schema=_ROWS,
            )
            if len(many):
                edge = np.ones(len(many), bool)
                edge[1:] = (doc[many][1:] != doc[many][:-1]) | (lo[many][1:] > hi[many][:-1] + 1)
                e = np.flatnonzero(edge)
                own, last = doc[many[e]], np.append(e[1:], len(many)) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[i:j][own].astype(np.int64)), pa.array(same[i:j][own]), pa.nulls(len(e), pa.binary()),
                        pa.nulls(len(e), pa.int64()), pa.nulls(len(e), pa.binary()), pa.array((lo[many[e]] - o[own]).astype(np.int32)),
                        pa.array((hi[many[last]] - o[own]).astype(np.int32)), pa.array(np.zeros(len(e), np.int32)),
                    ],
                    schema=_ROWS,
                )


def common_prefixes(suffixes: np.ndarray) -> np.ndarray:
    """For each row of a byte matrix, how many leading bytes it shares with the row before (0 for the first)."""
    out = np.zeros(len(suffixes), np.int64)
    differ = suffixes[1:] != suffixes[:-1]
    out[1:] = np.where(differ.any(1), differ.argmax(1), suffixes.shape[1])
    return out


SCANNED = "suffix binary, fp long, n long, merged boolean, hit boolean"


def _scan(batches):
    """The merge-scan of one range of the sorted stream of ``suffix, fp, n, fresh, merging``.

    Neighbours whose common prefix is the whole suffix are one suffix.  It is a hit if the
    new array has it, and another array, or it twice.  ``n`` counts what merges."""
    held: list[pa.RecordBatch] = []

    def settle(b: pa.Table, last: bool):
        """Rows of the suffixes of ``b``, but for the last one unless the stream has ended."""
        raw = b.column("suffix").combine_chunks()
        at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
        rows = np.frombuffer(raw.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(-1, ANCHOR)
        first = np.flatnonzero(common_prefixes(rows) < ANCHOR)
        if not last:
            rest = b.slice(int(first[-1]))
            first = first[:-1]
            b = b.slice(0, b.num_rows - rest.num_rows)
            held[:] = rest.to_batches()
        if len(first):
            col = {c: b.column(c).to_numpy() for c in ("fp", "n", "fresh", "merging")}
            n, fresh = col["n"].astype(np.int64), col["fresh"].astype(bool)
            total, own = np.add.reduceat(n, first), np.add.reduceat(n * fresh, first)
            merged = np.add.reduceat(n * col["merging"], first)
            yield pa.RecordBatch.from_arrays(
                [_fixed(rows[first]), pa.array(col["fp"][first]), pa.array(merged), pa.array(merged > 0), pa.array((own > 0) & (total > 1))],
                ["suffix", "fp", "n", "merged", "hit"],
            )

    for b in batches:
        if b.num_rows:
            yield from settle(pa.Table.from_batches([*held, b]), False)
    if held:
        yield from settle(pa.Table.from_batches(held), True)


class SuffixFamily:
    """Suffix arrays in levels of geometrically growing size, as tables in ``folder``.

    A family that is opened on the folder of an earlier one goes on with its levels.  The
    folder must be shared by all executors; by default it is a new one among the work tables."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.folder = folder or f"{work_dir(spark)}/work-family-{uuid.uuid4().hex}"
        self.levels: dict[int, str] = {}
        self.version = 0
        try:
            known = spark.read.schema("version int, rank int, path string").parquet(f"{self.folder}/levels")
            last = known.agg(F.max("version")).first()[0]
        except AnalysisException:  # a new family
            last = None
        if last is not None:
            self.version = last
            self.levels = {r["rank"]: r["path"] for r in known.where((F.col("version") == last) & (F.col("rank") >= 0)).collect()}

    def read(self, rank: int) -> DataFrame:
        """A level's array: ``suffix, fp, n``, in files that are ranges in the order of ``suffix``."""
        return self.spark.read.schema(SCANNED).parquet(self.levels[rank]).where("merged").select("suffix", "fp", "n")

    def add(self, rows: DataFrame) -> DataFrame:
        """Index a batch of suffixes (``suffix, fp, n``) and return ``fp`` of those that stand elsewhere too.

        The batch's array is scanned with the arrays of all levels, and merges with those of
        ranks 0, 1, ... up to the first that is free."""
        array = rows.groupBy("suffix", "fp").agg(F.sum("n").cast("long").alias("n"))
        rank = 0
        while rank in self.levels:
            rank += 1
        stream = array.withColumns({"fresh": F.lit(True), "merging": F.lit(True)})
        for r in self.levels:
            stream = stream.unionByName(self.read(r).withColumns({"fresh": F.lit(False), "merging": F.lit(r < rank)}))
        path = f"{self.folder}/level-{rank}-{uuid.uuid4().hex}"
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        map_texts(stream.repartitionByRange(tasks, "suffix").sortWithinPartitions("suffix"), _scan, SCANNED).where(
            "merged or hit"
        ).write.parquet(path)
        gone = [self.levels.pop(r) for r in range(rank)]
        self.levels[rank] = path
        self.version += 1
        listed = [(self.version, r, p) for r, p in self.levels.items()]
        self.spark.createDataFrame(listed, "version int, rank int, path string").coalesce(1).write.mode("append").parquet(f"{self.folder}/levels")
        for p in gone:
            self._delete(p)
        return self.spark.read.schema(SCANNED).parquet(path).where("hit").select("fp")

    def _delete(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def delete(self) -> None:
        """Remove the family's tables."""
        self._delete(self.folder)


def _cut(batches, length: int):
    """The bytes of the territories that are to be compared."""
    for b in batches:
        out = []
        for doc_id, same, text, todo in zip(*(b.column(c).to_pylist() for c in ("doc_id", "same", "text", "todo"))):
            raw = (text or "").encode()
            for t in todo:
                out.append((t["fp"], doc_id, same, t["lo"], t["hi"], raw[t["lo"] : t["hi"] + length]))
            if len(out) > 4000:
                yield _cut_batch(out)
                out = []
        yield _cut_batch(out)


def _cut_batch(rows):
    cols = list(zip(*rows)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], ["fp", "doc_id", "same", "lo", "hi", "bytes"])


def _joined(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each row begins (one entry more than rows)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def _window_hashes(column: pa.ChunkedArray, length: int):
    """Two hashes of each window of each row, and the row number of each window."""
    data, edges = _joined(column)
    begin, n = edges[:-1], np.diff(edges) - length + 1
    row = np.repeat(np.arange(len(begin)), n)
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    prefix = K.prefix_sum(data)
    a = K.span_hash(data, at, at + length, prefix)
    b = K.span_hash(data, at, at + length // 2, prefix)
    return a, K.mix(b ^ (a >> K.U64(7))), row, at - begin[row]


def _runs(row: np.ndarray, at: np.ndarray):
    """Maximal runs of successive windows: row, first, last."""
    if not len(row):
        return row, at, at
    edge = np.ones(len(row), bool)
    edge[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(edge)
    return row[first], at[first], at[np.append(first[1:], len(row)) - 1]


def _spans(table, row, first, last) -> pa.Table:
    lo = np.asarray(table.column("lo"))[row]
    return pa.table(
        {
            "doc_id": table.column("doc_id").take(pa.array(row)), "same": table.column("same").take(pa.array(row)),
            "lo": pa.array((lo + first).astype(np.int32)), "hi": pa.array((lo + last).astype(np.int32)),
        }
    )


def _verified(data: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of windows, given by their places in ``data``, are equal byte by byte.

    Pairs that advance together are compared as one stretch."""
    ok = np.ones(len(left), bool)
    order = np.lexsort((left, right - left))
    x, y = left[order], right[order]
    edge = np.ones(len(x), bool)
    edge[1:] = (y - x)[1:] != (y - x)[:-1]
    edge[1:] |= x[1:] != x[:-1] + 1
    first = np.flatnonzero(edge)
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(x)]):
        n = j - i - 1 + length
        p, q = data[x[i] : x[i] + n], data[y[i] : y[i] + n]
        if not np.array_equal(p, q):
            bad = np.concatenate([[0], np.cumsum(p != q)])
            ok[order[i:j]] = bad[length:] == bad[: j - i]
    return ok


def _compare(table: pa.Table, length: int) -> pa.Table:
    """Spans of the windows of suffixes' territories that occur in two of their rows."""
    a, b, row, at = _window_hashes(table.column("bytes"), length)
    order = np.lexsort((b, a))
    same = np.flatnonzero((a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]))
    left, right = np.minimum(order[same], order[same + 1]), np.maximum(order[same], order[same + 1])
    data, begin = _joined(table.column("bytes"))
    ok = _verified(data, begin[row[left]] + at[left], begin[row[right]] + at[right], length)
    twice = np.zeros(len(a), bool)
    twice[left[ok]] = True
    twice[right[ok]] = True
    out = _spans(table, *_runs(row[twice], at[twice]))
    if len(data) > K.CHUNK:
        K.release()
    return out


def _groups(batches, kernel):
    """``kernel`` of tables of whole groups, from a stream in the order of ``fp``: small groups go together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            table = pa.Table.from_batches([*held, b])
            fp = table.column("fp").to_numpy()
            last = int(np.searchsorted(fp, fp[-1]))
            if last:
                yield from kernel(table.slice(0, last)).to_batches()
            held = table.slice(last).to_batches()
    if held:
        yield from kernel(pa.Table.from_batches(held)).to_batches()


def compared(cut: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel`` over the groups of ``fp``; equal windows have the same ``fp``, so several groups may be compared at a time."""
    return map_texts(cut.repartition("fp").sortWithinPartitions("fp"), lambda it: _groups(it, kernel), schema)


def _windows(batches, length: int):
    for t in batches:
        for i in range(0, t.num_rows, 1000):
            part = t.slice(i, 1000)
            a, b, row, at = _window_hashes(part.column("bytes"), length)
            lo = part.column("lo").to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), part.column("doc_id").take(pa.array(row)), part.column("same").take(pa.array(row)), pa.array((lo + at).astype(np.int32))],
                ["a", "b", "doc_id", "same", "lo"],
            )


def run_hash(words: np.ndarray, k: int, base: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """Hashes of all runs of ``k`` words, put together from runs of powers of two."""
    n = len(words)
    if n < k:
        return np.zeros(0, K.U64)
    out, done, part, size = None, 0, words, 1
    while True:
        if k & size:
            m = n - done - size + 1
            out = part if out is None else K.mix(out[:m] * K.U64(base) + part[done : done + m])
            done += size
        size *= 2
        if size > k:
            return out
        half = size // 2
        part = K.mix(part[:-half] * K.U64(base) + part[half:])


def _first(*keys: np.ndarray) -> np.ndarray:
    """1 for the first row of each combination of ``keys``, else 0."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    out = np.zeros(len(order), np.int32)
    out[order[new]] = 1
    return out


def _hashed_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text the index of its first (one entry more than texts)."""
    begin, end, first = K.words(data, off, K.NOT_BLANK)
    return K.word_hash(data, begin, end), first


def _index_passages(batches, passage: int):
    """Territories of runs of words, equal ones of a text in one row: ``los`` is where they stand in it.

    ``fresh`` counts a leading run once in a text."""
    for b in batches:
        data, off = K.texts(b.column("text"))
        ids, same = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("same").to_numpy()
        for i, j, d, o in K.chunks(data, off):
            words, first = _hashed_words(d, o)
            if len(words) < passage:
                continue
            h = run_hash(words, GRAM)
            doc, lo, hi, anchor = areas(h, first, passage)
            raw = words.tobytes()
            body = np.frombuffer(
                b"".join(
                    hashlib.blake2b(raw[x * 8 : (y + passage) * 8], digest_size=16, salt=(z - x).to_bytes(4, "little")).digest()
                    for x, y, z in zip(lo.tolist(), hi.tolist(), anchor.tolist())
                ),
                np.uint64,
            ).reshape(-1, 2)
            order = np.lexsort((lo, body[:, 1], body[:, 0], doc))
            new = np.ones(len(lo), bool)
            new[1:] = (body[order][1:] != body[order][:-1]).any(1) | (doc[order][1:] != doc[order][:-1])
            run = np.flatnonzero(new)
            keep = order[run]
            los = pa.ListArray.from_arrays(
                pa.array(np.append(run, len(lo)).astype(np.int32)), pa.array((lo - first[doc])[order].astype(np.int32))
            )
            own, fp = doc[keep], h[anchor[keep]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[i:j][own].astype(np.int64)), pa.array(same[i:j][own]), pa.array(fp.view(np.int64)),
                    _fixed(body[keep].view(np.uint8).reshape(-1, 16)), pa.array((hi - lo)[keep].astype(np.int32)), los, pa.array(_first(fp, own)),
                ],
                ["doc_id", "same", "fp", "body", "span", "los", "fresh"],
            )


def _cut_passages(batches, passage: int):
    """The hashed words of the territories that are to be compared; ``los`` is where each stands in its text."""
    for b in batches:
        out = []
        for doc_id, same, text, todo in zip(*(b.column(c).to_pylist() for c in ("doc_id", "same", "text", "todo"))):
            data = np.frombuffer(text.encode(), np.uint8)
            words, _ = _hashed_words(data, np.array([0, len(data)]))
            for t in todo:
                lo = t["los"][0]
                hi = lo + t["span"]
                out.append((t["fp"], doc_id, same, lo, hi, words[lo : hi + passage].tobytes(), t["many"], t["los"]))
        cut = _cut_batch([x[:6] for x in out])
        more = [pa.array([x[6] for x in out], pa.bool_()), pa.array([x[7] for x in out], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*cut.columns, *more], [*cut.schema.names, "many", "los"])


def _passage_hashes(column: pa.ChunkedArray, passage: int):
    """All words, two hashes of each window of each row, its row number, its place among all words, and in its row."""
    data, edges = _joined(column)
    words, edges = np.frombuffer(data.tobytes(), K.U64), edges // 8
    n = np.diff(edges) - passage + 1
    row = np.repeat(np.arange(len(n)), n)
    place = np.repeat(edges[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    a, b = run_hash(words, passage)[place], run_hash(words, passage, 0xD6E8FEB86659FD93)[place]
    return words, a, b, row, place, place - edges[:-1][row]


def _compare_passages(table: pa.Table, passage: int) -> pa.Table:
    """Runs of the windows of leading runs' territories that occur in two texts, or in a territory of ``many`` texts."""
    words, a, b, row, place, at = _passage_hashes(table.column("bytes"), passage)
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    same = np.flatnonzero(~new)
    new[same[~_verified(words, place[order[same - 1]], place[order[same]], passage)]] = True
    first = np.flatnonzero(new)
    keys = np.stack([table.column("doc_id").to_numpy(), table.column("same").to_numpy()], 1)
    text = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)[row][order]
    many = table.column("many").to_numpy()[row][order]
    hit = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first)
    hit |= np.logical_or.reduceat(many, first)
    twice = np.zeros(len(order), bool)
    twice[order] = hit[np.cumsum(new) - 1]
    run, start, stop = _runs(row[twice], at[twice])
    found = table.select(["doc_id", "same", "los"]).take(pa.array(run))
    return found.append_column("start", pa.array(start.astype(np.int32))).append_column("stop", pa.array(stop.astype(np.int32)))


def _passage_windows(batches, passage: int):
    for t in batches:
        if t.num_rows:
            _, a, b, row, _, at = _passage_hashes(t.column("bytes"), passage)
            own = ["doc_id", "same", "many", "los"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *(t.column(c).take(pa.array(row)) for c in own), pa.array(at.astype(np.int32))],
                ["a", "b", *own, "start"],
            )


def _passages(docs: DataFrame, passage: int) -> DataFrame:
    """``doc_id, same, los, start, stop``: windows of ``passage`` words that stand in another row too begin from ``start`` to ``stop`` after each of ``los``."""
    texts = docs.where(F.octet_length("text") >= 2 * passage - 1).select("doc_id", "same", "text")
    rows = stage(map_texts(texts, lambda it: _index_passages(it, passage), PASSAGE_ROWS), "passage-rows")
    keys = stage(rows.where("fresh = 1").groupBy("fp").agg(F.sum("fresh").alias("n")).where("n > 1").select("fp"), "passage-keys")
    hit = stage(keep_keys(rows.drop("fresh"), keys, ["fp"]), "passage-hit")
    own = ["doc_id", "same"]
    text = F.struct(*own)
    body = hit.groupBy("fp", "body").agg(F.count("*").alias("n"), F.min(text).alias("first"))
    kinds = body.groupBy("fp").agg((F.count("*") > 1).alias("several"), (F.min("n") == 1).alias("single"))
    body = stage(body.join(kinds, "fp"), "passage-body")
    whole = hit.join(body.where("n > 1").select("fp", "body"), ["fp", "body"], "left_semi")
    # where every territory stands in two rows, there is nothing to compare; one of many texts stands in the comparison once
    part = body.where("several and single").select("fp", "body", "first", (F.col("n") > 1).alias("many"))
    part = hit.join(part, ["fp", "body"]).where(text == F.col("first"))
    todo = stage(part.groupBy(*own).agg(F.collect_list(F.struct("fp", "span", "many", "los")).alias("todo")), "passage-todo")
    beside = keep_keys(texts, todo.select(*own), own).dropDuplicates(own).join(todo, own)
    cut = stage(
        map_texts(beside, lambda it: _cut_passages(it, passage), "fp long, doc_id long, same long, lo int, hi int, bytes binary, many boolean, los array<int>"),
        "passage-cut",
    )
    hot = stage(cut.groupBy("fp").agg(F.count("*").alias("size")).where(F.col("size") > GROUP).select("fp"), "passage-hot")
    any_hot = bool(hot.take(1))
    few = keep_keys(cut, hot, ["fp"], "left_anti") if any_hot else cut
    spans = compared(few, lambda t: _compare_passages(t, passage), "doc_id long, same long, los array<int>, start int, stop int")
    if any_hot:
        window = stage(
            map_texts(
                keep_keys(cut, hot, ["fp"]), lambda it: _passage_windows(it, passage), "a long, b long, doc_id long, same long, many boolean, los array<int>, start int"
            ),
            "passage-window",
        )
        twice = window.groupBy("a", "b").agg(F.min(text).alias("x"), F.max(text).alias("y"), F.max("many").alias("many")).where("many or x != y")
        spans = spans.unionByName(window.join(twice.select("a", "b"), ["a", "b"], "left_semi").select(*own, "los", "start", F.col("start").alias("stop")))
    return spans.unionByName(whole.select(*own, "los", F.lit(0).alias("start"), F.col("span").alias("stop")))


def _merged(runs, width: int) -> tuple[int, int]:
    """How many stretches the windows of ``width`` words of the runs of ``_passages`` cover, and how many words."""
    n, covered, end = 0, 0, -1
    for lo, hi in sorted((x + r["start"], x + r["stop"] + width) for r in runs or () for x in r["los"]):
        n += lo > end
        covered += max(0, hi - max(lo, end))
        end = max(end, hi)
    return n, covered


def _keep(batches, length: int, passage: int):
    for b in batches:
        out = []
        for doc_id, text, spans, passages in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "spans", "passages"))):
            raw = (text or "").encode()
            kept, at, removed, n = [], 0, 0, 0
            end = -1
            for s in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
                if s[0] > end:
                    n += 1
                    kept.append(raw[at : s[0]])
                    removed += s[1] - s[0]
                    at = end = s[1]
                elif s[1] > end:
                    removed += s[1] - end
                    at = end = s[1]
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((doc_id, len(raw), removed, n, hashlib.sha256(rest).hexdigest(), rest, *_merged(passages, passage)))
        cols = list(zip(*out)) or [()] * 8
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(cols, kinds)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passages", "n_passage_words"],
        )


def remove_repeats(docs: DataFrame, *, length: int = 400, batches: int = 4, passage: int = 0) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else.

    Returns one row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    kept`` (the remaining bytes, which may cut a character).  With ``passage`` (words, at
    least ``GRAM``) come ``n_passages`` and ``n_passage_words``: the maximal runs of words
    (whatever is between blanks) covered by runs of ``passage`` words that also stand in
    another row, and their words.  Passages are judged on the input and stay in the text
    unless their bytes are removed.  Strings are judged on the
    input; overlaps count; matches never cross documents.  A null text counts as empty;
    texts shorter than ``length`` stay whole; very long texts are read whole; equal rows are
    copies of each other and both go; a null ``doc_id`` stays null; other columns are
    ignored; an empty table gives an empty one.  Documents are indexed in ``batches``, by
    the hash of their id and text."""
    if length <= ANCHOR:
        raise ValueError(f"length must be over {ANCHOR}")
    if passage and passage < GRAM:
        raise ValueError(f"passage must be at least {GRAM}")
    no_id = F.lit(-(1 << 63)).cast("long")  # stands for null, which would join with nothing
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("same", F.xxhash64("text"))
    rows = stage(
        map_texts(docs.where(F.octet_length("text") >= length).select("doc_id", "same", "text"), lambda it: _index(it, length), ROWS), "rows"
    )
    family = SuffixFamily(docs.sparkSession)
    entry = rows.where("fp is not null").select("doc_id", "same", "suffix", "fp", "n")
    matched = None
    for i in range(batches):
        some = family.add(entry.where(F.pmod(F.xxhash64("doc_id", "same"), F.lit(batches)) == i))
        some = stage(some, "match")  # the level may be merged away
        matched = some if matched is None else matched.unionByName(some)
    # a fingerprint only leads to the suffix: another suffix of the same one is compared in vain
    keys = stage(matched.distinct(), "keys")
    hit = stage(keep_keys(rows.where("fp is not null").drop("suffix"), keys, ["fp"]), "hit")
    family.delete()

    place = F.struct("doc_id", "same", "lo")
    body = hit.groupBy("fp", "body").agg(F.sum("n").alias("n"), F.min(place).alias("first"))
    kinds = body.groupBy("fp").agg(F.count("*").alias("kinds"))
    body = stage(body.join(kinds, "fp"), "body")
    whole = hit.join(body.where("n > 1").select("fp", "body"), ["fp", "body"], "left_semi")
    part = body.where("kinds > 1")
    # a repeated territory stands in the comparison once
    part = hit.join(part.select("fp", "body", "first", "kinds"), ["fp", "body"]).where(place == F.col("first"))
    todo = stage(
        part.groupBy("doc_id", "same").agg(F.collect_list(F.struct("fp", "lo", "hi")).alias("todo")), "todo"
    )
    texts = docs.select("doc_id", "same", "text")
    own = ["doc_id", "same"]

    def beside(lists: DataFrame) -> DataFrame:
        """The texts that have a list, with it: at most the keys are broadcast, never the lists."""
        return keep_keys(texts, lists.select(*own), own).join(lists, own)

    cut = stage(
        map_texts(
            beside(todo).dropDuplicates(["doc_id", "same"]), lambda it: _cut(it, length),
            "fp long, doc_id long, same long, lo int, hi int, bytes binary",
        ),
        "cut",
    )
    size = cut.groupBy("fp").agg(F.count("*").alias("size")).where(F.col("size") > GROUP)
    hot = stage(size.select("fp"), "hot")
    span = "doc_id long, same long, lo int, hi int"
    any_hot = bool(hot.take(1))
    few = keep_keys(cut, hot, ["fp"], "left_anti") if any_hot else cut
    spans = compared(few, lambda t: _compare(t, length), span)
    if any_hot:
        window = stage(
            map_texts(keep_keys(cut, hot, ["fp"]), lambda it: _windows(it, length), "a long, b long, doc_id long, same long, lo int"),
            "window",
        )
        twice = window.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
        spans = spans.unionByName(
            window.join(twice, ["a", "b"], "left_semi").select("doc_id", "same", "lo", F.col("lo").alias("hi"))
        )
    done = rows.where("fp is null").select("doc_id", "same", "lo", "hi")
    spans = spans.unionByName(whole.select("doc_id", "same", "lo", "hi")).unionByName(done)
    runs = "struct<los: array<int>, start: int, stop: int>"
    spans = spans.select(*own, F.struct("lo", "hi").alias("span"), F.lit(None).cast(runs).alias("run"))
    if passage:
        spans = spans.unionByName(_passages(docs, passage).select(*own, F.struct("los", "start", "stop").alias("run")), allowMissingColumns=True)
    spans = stage(spans.groupBy(*own).agg(F.collect_set("span").alias("spans"), F.collect_list("run").alias("passages")), "spans")
    none = [F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in ("spans", "passages")]
    rest = keep_keys(texts, spans.select(*own), own, "left_anti").select("doc_id", "text", *none)
    drop_stage(rows, hit, body, todo, cut)
    out = map_texts(
        beside(spans).select("doc_id", "text", "spans", "passages").unionByName(rest), lambda it: _keep(it, length, passage),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, n_passages long, n_passage_words long",
    )
    if not passage:
        out = out.drop("n_passages", "n_passage_words")
    return out.withColumn("doc_id", F.nullif("doc_id", no_id))
