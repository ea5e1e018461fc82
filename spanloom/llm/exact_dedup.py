"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every partition hashes its texts to short fingerprints, sorts them, splits them
   by owner (the leading bits) and sends each owner the Golomb-Rice coded gaps.
2. An owner merges what all partitions sent and returns to each a bitmap of the
   fingerprints that another partition has too.
3. A partition adds what repeats within itself; only texts with such a fingerprint
   are suspects.  Only suspects are shuffled, pre-aggregated by their bytes, so one
   text crosses the network at most once from each partition however often it occurs.
4. Equality is decided on the bytes; the SHA-256 then names a verified group.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.work import BROADCAST_IDS, join_hot, keep_keys, stage

#: Bits of a fingerprint beyond log2(rows): a text without a copy is suspected once in 2**SPARE.
SPARE = 10
#: Fingerprints that an owner holds at a time.
OWNER_ROWS = 1 << 20


def golomb_encode(sorted_values: np.ndarray, rice: int) -> bytes:
    """Golomb-Rice code of the gaps of sorted distinct non-negative integers."""
    if not len(sorted_values):
        return b""
    gap = np.diff(sorted_values.astype(np.int64), prepend=np.int64(-1)) - 1
    quotient = gap >> rice
    width = quotient + 1 + rice
    end = np.cumsum(width)
    start = end - width
    bits = np.zeros(int(end[-1]), np.uint8)
    ones = int(quotient.sum())  # the quotient in unary ones, then a zero, then the low bits
    if ones:
        before = np.cumsum(quotient) - quotient
        bits[np.repeat(start - before, quotient) + np.arange(ones)] = 1
    for j in range(rice):
        bits[start + quotient + 1 + j] = (gap >> (rice - 1 - j)) & 1
    return np.packbits(bits).tobytes()


def golomb_decode(code: bytes, n: int, rice: int) -> np.ndarray:
    """The ``n`` sorted integers of ``golomb_encode``.

    A zero ends a quotient if it lies past the low bits of the value before.  From each
    zero the next such zero is known, so those in use are found by doubling jumps."""
    if not n:
        return np.zeros(0, np.int64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    zeros = np.flatnonzero(bits == 0)
    jump = np.minimum(np.searchsorted(zeros, zeros + 1 + rice), len(zeros) - 1)
    at = np.zeros(1, np.int64)
    while len(at) < n:  # the first k stops and a jump over k of them give the next k
        at = np.concatenate([at, jump[at]])
        jump = jump[jump]
    stops = zeros[at[:n]]
    begins = np.concatenate([[0], stops[:-1] + 1 + rice])
    gap = (stops - begins).astype(np.int64) << rice
    for j in range(rice):
        gap |= bits[stops + 1 + j].astype(np.int64) << (rice - 1 - j)
    return np.cumsum(gap + 1) - 1


def _send(batches, bits: int, owner_bits: int, rice: int):
    got, block = [], None
    for b in batches:
        if b.num_rows:
            block = b.column("block")[0].as_py()
            got.append(b.column("fp").to_numpy())
    if block is None:
        return
    fp, count = np.unique(np.concatenate(got), return_counts=True)
    low = bits - owner_bits
    cut = np.searchsorted(fp, np.arange((1 << owner_bits) + 1, dtype=np.int64) << low)
    rows = []
    for owner in np.flatnonzero(np.diff(cut)):
        i, j = cut[owner], cut[owner + 1]
        own = fp[i:j] - (int(owner) << low)
        rows.append((block, int(owner), int(j - i), golomb_encode(own, rice), np.packbits(count[i:j] > 1).tobytes()))
    yield pa.RecordBatch.from_pylist(
        [dict(zip(("block", "owner", "n", "code", "local"), r)) for r in rows],
        pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("code", pa.binary()), ("local", pa.binary())]),
    )


def _own(table: pa.Table, rice: int) -> pa.Table:
    rows = table.select(["n", "code"]).to_pylist()
    each = [golomb_decode(r["code"], r["n"], rice) for r in rows]
    value, count = np.unique(np.concatenate(each), return_counts=True)
    many = value[count > 1]
    return pa.table(
        {
            "block": table.column("block"),
            "owner": table.column("owner"),
            "bitmap": pa.array([np.packbits(np.isin(x, many, assume_unique=True)).tobytes() for x in each], pa.binary()),
        }
    )


def _suspects(batches, low: int, rice: int):
    for b in batches:
        out = []
        for r in b.to_pylist():
            n = r["n"]
            flag = np.unpackbits(
                np.frombuffer(r["bitmap"], np.uint8) | np.frombuffer(r["local"], np.uint8), count=n
            ).astype(bool)
            if flag.any():
                out.append(golomb_decode(r["code"], n, rice)[flag] + (r["owner"] << low))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))], ["fp"])


def suspect_fingerprints(docs: DataFrame, fp, bits: int, owner_bits: int, n: int) -> DataFrame:
    """The fingerprints (column ``fp``) that occur on more than one row of ``docs``."""
    low = bits - owner_bits
    blocks = max(1, docs.rdd.getNumPartitions() if n else 1)
    # gaps within one partition's share are about 2**bits * blocks / n
    rice = max(1, min(low, round(log2(max(2.0, 2.0**bits * blocks / max(1, n))) - 0.5)))
    sent = stage(
        docs.select(F.spark_partition_id().cast("long").alias("block"), fp.alias("fp")).mapInArrow(
            lambda it: _send(it, bits, owner_bits, rice), "block long, owner int, n int, code binary, local binary"
        ),
        "sent",
    )
    bitmaps = sent.groupBy("owner").applyInArrow(
        lambda t: _own(t, rice), "block long, owner int, bitmap binary"
    )
    return (
        sent.join(bitmaps, ["block", "owner"])
        .select("owner", "n", "code", "local", "bitmap")
        .mapInArrow(lambda it: _suspects(it, low, rice), "fp long")
        .distinct()
    )


def exact_duplicates(docs: DataFrame, *, key: str | None = None) -> DataFrame:
    """Groups of byte-equal texts; of a group the row with the largest ``doc_id`` stays.

    Reads ``doc_id`` and ``text``; other columns are ignored.  A null text counts as
    empty.  Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  Rows that repeat a ``doc_id`` are counted each, and all rows that
    carry the kept id are kept; a group whose ids are all null has a null ``keep_id``
    and keeps nothing; an empty table gives an empty one; very long texts are read whole.
    ``key`` may name a column that is different in each row: it is then returned too, and
    exactly one row of each group is kept, of those with the largest ``doc_id`` the one
    with the largest key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.col("doc_id").cast("long")
    row = F.struct(number.isNotNull().alias("named"), number.alias("doc_id"), F.col(key).alias("own")) if key else number
    docs = docs.select(row.alias("doc_id"), text.alias("text"))
    n = docs.count()
    bits = min(52, max(SPARE + 2, ceil(log2(max(2, n))) + SPARE))
    owners = max(1, n // OWNER_ROWS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    owner_bits = min(bits - SPARE, ceil(log2(owners))) if owners > 1 else 0
    fp = F.shiftrightunsigned(F.xxhash64("text"), 64 - bits)
    suspects = stage(suspect_fingerprints(docs, fp, bits, owner_bits, n), "suspects")

    held = keep_keys(docs.withColumn("fp", fp), suspects, ["fp"])
    groups = (
        held.groupBy("text")  # byte verification, pre-aggregated in each partition
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        .where("group_size > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id")
    )
    # two texts that differ but share a SHA-256 must never pass as one group
    groups = stage(
        groups.groupBy("text_sha256").agg(
            F.when(F.count("*") > 1, F.raise_error(F.lit("SHA-256 collision"))).otherwise(F.max("group_size")).cast("long").alias("group_size"),
            F.max("keep_id").alias("keep_id"),
        ),
        "groups",
    )
    named = docs.select("doc_id", F.sha2("text", 256).alias("text_sha256"), (F.col("text") == "").alias("blank"))
    # empty texts may be very many: one row of groups at most, which needs no shuffle
    empty = groups.where(F.col("text_sha256") == F.sha2(F.lit(""), 256))
    own = named.where("not blank")
    if groups.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        own = own.join(F.broadcast(groups), "text_sha256", "left")
    else:
        own = join_hot(stage(own, "named"), groups.withColumn("copies", F.col("group_size")), ["text_sha256"], "copies", "left")
    both = own.unionByName(
        named.where("blank").join(F.broadcast(empty), "text_sha256", "left")
    )
    alone = F.col("group_size").isNull()
    kept = F.coalesce(alone | (F.col("doc_id") == F.col("keep_id")), F.lit(False)).alias("kept")
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    size = F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")
    if key:
        return both.select("doc_id.doc_id", keep_id["doc_id"].alias("keep_id"), size, kept, "text_sha256", F.col("doc_id.own").alias(key))
    return both.select("doc_id", keep_id.alias("keep_id"), size, kept, "text_sha256")
