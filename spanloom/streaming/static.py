"""Streams of features against static references.

Padding, shifting and column mapping of ``spanloom.operators`` work on streams as they are.
Crossing needs no state when the references do not change: it is a stream-static join, with
the count taken per feature inside each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.operators.intervals import depth
from spanloom.operators.joins import crossing


def hits(stream: DataFrame, refs: DataFrame, *, cell: int = 1 << 14) -> DataFrame:
    """Pairs of streamed features and the references they cross or touch, as an append-mode stream."""
    a = stream.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor(F.col("end") / cell))))
    b = refs.select("chrom", F.col("start").alias("rs"), F.col("end").alias("re"), F.col("name").alias("ref")).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("rs") / cell), F.floor(F.col("re") / cell)))
    )
    first = F.greatest(F.floor(F.col("start") / cell), F.floor(F.col("rs") / cell))
    return a.join(b, ["chrom", "cell"]).where((F.col("rs") <= F.col("end")) & (F.col("re") >= F.col("start")) & (F.col("cell") == first)).drop("cell")


def score_stream(stream: DataFrame, refs: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, score_type: str = "COUNT", **how) -> StreamingQuery:
    """Score each micro-batch against the references and hand it to ``write(batch, number)``."""
    return stream.writeStream.foreachBatch(lambda batch, n: write(crossing(batch, refs, score_type, **how), n)).option("checkpointLocation", checkpoint).start()


def depth_stream(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Depth within each micro-batch; depths of batches add up, so totals are a later sum."""
    return stream.writeStream.foreachBatch(lambda batch, n: write(depth(batch), n)).option("checkpointLocation", checkpoint).start()
