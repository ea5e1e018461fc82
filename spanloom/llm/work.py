"""Shared-folder work tables, id joins behind a size check, and components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spanloom.llm import textkernels as K

#: Ids (8 to 16 bytes each) that may be broadcast; above it the join shuffles.
BROADCAST_IDS = 500_000
#: Texts that Spark hands to Python at a time; its default of 10,000 would hold far more bytes than a kernel needs.
TEXT_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Work tables that this driver has written and not deleted: path by the number of its run.
_written: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, local mode (tests) gets a temporary folder; a cluster gets an
    error, as each executor would write to its own disk."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="spanloom-")
    atexit.register(shutil.rmtree, own, True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet work table in the shared folder and read it back.

    Cuts the lineage, survives lost executors and can be read column by column.
    The reader takes the schema of ``df``, so an empty table works too."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/work-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def drop_stage(*tables: DataFrame) -> None:
    """Delete the files of work tables (as ``stage`` returned them) that nothing reads any more."""
    for t in tables:
        drop_paths(t.sparkSession, [t._work_path])


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    for path in paths:
        if path in _written:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            _written.remove(path)


def work_tables() -> list[str]:
    """Paths of the work tables that have been written and not deleted."""
    return list(_written)


def map_texts(df: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of whole texts; the worker gives its memory back at the end of each task."""
    spark = df.sparkSession
    if int(spark.conf.get(BATCH_ROWS)) > TEXT_ROWS:
        spark.conf.set(BATCH_ROWS, TEXT_ROWS)
    return df.mapInArrow(K.freeing(kernel), schema)


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Join ``df`` with the key table ``keys`` (a work table): broadcast while it has at
    most ``BROADCAST_IDS`` rows, a shuffled join beyond."""
    if keys.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


#: Rows of one key from which it is hot, and the most hot keys there can be: a key is hot with at least HOT_ROWS rows, and
#: at least one in HOT_KEYS of all rows.
HOT_ROWS, HOT_KEYS = 100_000, 10_000


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows.join(table, on, how)`` where ``table`` has one row for each key, with ``count``, how many rows have it.

    Rows of hot keys stay where they are and meet their keys by a broadcast of at most HOT_KEYS rows; all others
    are shuffled.  So no task gets more than a hot key's least number of rows of one key, whatever Spark does
    about skew.  ``rows`` is read twice, so it should be a work table; ``how`` is inner or left."""
    n = rows.count()
    least = max(HOT_ROWS, -(-n // HOT_KEYS))
    if n < least:
        return rows.join(table.drop(count), on, how)
    hot = F.broadcast(table.where(F.col(count) >= least))
    cold = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot.drop(count), on).unionByName(cold.join(table.where(F.col(count) < least).drop(count), on, how))


#: Edges (two ids each) that one task joins into components; more are first contracted by shuffles.
FEW_EDGES = 10_000


def _join_few(batches, kind: pa.DataType):
    """Components of all edges that the task reads, by union-find: every node with the least node it reaches."""
    root: dict = {}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            root.setdefault(u, u)
            root.setdefault(v, v)
            x, y = top(u), top(v)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([top(x) for x in nodes], kind)], ["node", "comp"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components by contraction.

    ``edges`` is an undirected edge list over any orderable type.  Returns
    ``(node, comp)`` for every node of an edge; ``comp`` is the smallest node
    reachable.  In each round every node is merged into its least neighbour, so
    the graph shrinks, until a count finds few edges left, which one task settles; the
    merges are then composed.  Each round is written to the shared folder; the driver
    only learns how many edges are left."""
    left = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges"
    )
    kind = left.schema["u"].dataType.simpleString()
    arrow = to_arrow_type(left.schema["u"].dataType)
    merges: list[DataFrame] = []
    while left.count() > FEW_EDGES:
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("comp"))
        low = stage(low, "merge")
        merges.append(low)
        u, v = low.toDF("u", "cu"), low.toDF("v", "cv")
        after = stage(
            left.join(u, "u").join(v, "v").where("cu != cv").select(F.greatest("cu", "cv").alias("u"), F.least("cu", "cv").alias("v")).distinct(),
            "edges",
        )
        drop_stage(left)
        left = after
    merges.append(stage(left.coalesce(1).mapInArrow(lambda it: _join_few(it, arrow), f"node {kind}, comp {kind}"), "merge"))
    drop_stage(left)
    out = merges[-1]
    for low in reversed(merges[:-1]):
        above = out.toDF("comp", "top")
        # a root of this round that meets no other later on is not a node there
        out = low.join(above, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    return out


def merged_components(comp: DataFrame | None, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``comp`` (node, comp) after more edges: only they are joined, as edges between its components."""
    if comp is None:
        return components(edges, a, b)
    of = lambda x: comp.select(F.col("node").alias(x), F.col("comp").alias(f"c_{x}"))
    named = edges.join(of(a), a, "left").join(of(b), b, "left")
    more = components(named.select(F.coalesce(f"c_{a}", a).alias("x"), F.coalesce(f"c_{b}", b).alias("y")), "x", "y")
    moved = comp.join(more.toDF("comp", "top"), "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    return moved.unionByName(more.join(comp.select("node"), "node", "left_anti"))
