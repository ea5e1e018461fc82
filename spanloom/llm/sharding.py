"""Longest-processing-time sharding of groups that must stay together.

Groups (equal texts) are counted by Spark.  The schedule itself needs only how many
groups there are of each size, so the driver sees a histogram whose length has a proven
bound: sizes are exact for the at most ``shards * GIANTS`` groups that weigh enough to
unbalance a shard, and keep eight leading bits below.  A heap hands the classes out,
largest first, each time to the least-loaded shard; runs of equal groups go in bulk.
Spark then numbers the groups of a class and the rows of a shard without ever holding
a class or a shard in one task.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.llm.work import join_hot, stage

#: A group of over total / (shards * GIANTS) bytes is scheduled by its exact size.
GIANTS = 256
#: Rows that one task numbers.
RUN = 200_000


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Longest processing time first.  ``classes``: (key, groups, bytes of all).

    Returns (key, first rank, end rank, shard): the groups of a class with ranks in
    [first, end) go to that shard."""
    load = [(0.0, s) for s in range(shards)]
    out = []
    for key, n, total in sorted(classes, key=lambda c: (-c[2] / c[1], c[0])):
        each = total / n
        given = [0] * shards
        left = n
        if n > 4 * shards:  # fill all shards to one level, short of the last few groups
            rising = sorted(load)
            fill, level = 0.0, 0.0
            for i, (x, _) in enumerate(rising):
                fill += x
                level = (n * each + fill) / (i + 1)
                if i + 1 == shards or level <= rising[i + 1][0]:
                    break
            for x, s in rising:
                given[s] = max(0, int((level - x) / each))
            left = n - sum(given)
            load = [(x + given[s] * each, s) for x, s in load]
            while left < 0:  # rounding
                s = max(range(shards), key=given.__getitem__)
                given[s] -= 1
                load = [(x - each if t == s else x, t) for x, t in load]
                left += 1
        heapq.heapify(load)
        for _ in range(left):
            x, s = heapq.heappop(load)
            given[s] += 1
            heapq.heappush(load, (x + each, s))
        at = 0
        for s in range(shards):
            if given[s]:
                out.append((key, at, at + given[s], s))
                at += given[s]
    return out


def numbered(df: DataFrame, by: str, order: list[str], runs: int, name: str) -> DataFrame:
    """Add ``name``: a gapless number from 0 within each ``by``, in ``runs`` salted runs per key.

    The offsets table has at most ``runs`` rows for each of the bounded number of keys."""
    df = df.withColumn("run", F.pmod(F.xxhash64(*order), F.lit(runs)).cast("int"))
    count = df.groupBy(by, "run").agg(F.count("*").alias("rows_"))
    w = Window.partitionBy(by).orderBy("run")
    start = count.select(by, "run", (F.sum("rows_").over(w) - F.col("rows_")).alias("start_"))
    here = Window.partitionBy(by, "run").orderBy(*order)
    return (
        df.withColumn("nth_", F.row_number().over(here))
        .join(start, [by, "run"])
        .withColumn(name, (F.col("start_") + F.col("nth_") - 1).cast("long"))
        .drop("run", "nth_", "start_")
    )


def assign_shards(docs: DataFrame, *, shards: int = 16) -> DataFrame:
    """Put all rows into ``shards`` shards of near equal bytes; equal texts share a shard.

    Returns one row per input row: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.  ``size`` is the UTF-8 length plus one; a null text has none and counts
    as empty.  ``slot`` is gapless from 0 within a shard.  Rows that repeat, or have no
    ``doc_id``, are placed like others; a very long text is one row like any other, placed
    by its size; other columns are ignored; an empty table gives an empty one.  One group larger than an even share makes its shard larger: groups are
    never split."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("same"),
    )
    base = stage(base, "base")
    groups = base.groupBy("same").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies"))
    total = base.agg(F.sum("size").alias("t"), F.count("*").alias("n")).first()
    bound = (total["t"] or 0) // (shards * GIANTS) + 1
    exponent = F.greatest(F.lit(0), F.length(F.bin("bytes")) - 8)
    rough = F.expr("shiftright(bytes, greatest(0, length(bin(bytes)) - 8))")
    groups = groups.withColumn(
        "class",
        F.when(F.col("bytes") >= bound, -F.col("bytes")).otherwise(rough + exponent.cast("long") * (1 << 32)),
    )
    groups = stage(groups, "groups")
    # at most shards * GIANTS exact classes and 2**8 for each power of two
    histogram = groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).toArrow().to_pylist()
    plan = schedule([(r["class"], r["n"], r["bytes"]) for r in histogram], shards)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        pd.DataFrame(plan or [(0, 0, 0, 0)], columns=["class", "lo", "hi", "shard"]), "class long, lo long, hi long, shard int"
    )
    runs = max(8, (total["n"] or 0) // RUN // 64 + 1)
    placed = (
        numbered(groups, "class", ["same"], runs, "rank")
        .join(F.broadcast(plan), "class")
        .where("rank >= lo and rank < hi")
        .select("same", "shard", "copies")
    )
    rows = join_hot(base, stage(placed, "placed"), ["same"], "copies").select("doc_id", "size", "text_crc32", "shard")
    runs = max(16, (total["n"] or 0) // RUN + 1)
    return numbered(rows, "shard", ["doc_id", "text_crc32"], runs, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
