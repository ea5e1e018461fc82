"""Projections of the driver's tables onto the engine's schemas, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.genome import upper_bases


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("event_id") * 7919) % 500000
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("chr"), (F.col("user_id") % 5 + 1).cast("string")).alias("chrom"), start.alias("start"),
        (start + 1 + F.floor(F.col("value") * 4)).alias("end"), F.col("event_id").cast("string").alias("name"),
        F.col("value").alias("score"), F.when(F.col("event_id") % 2 == 0, "+").otherwise("-").alias("strand"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir).where("event_id % 3 != 0")


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals(spark, sf_dir).where("event_id % 3 = 0")


def chroms(spark: SparkSession) -> DataFrame:
    return spark.range(1, 6).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("chrom"), F.lit(600000).cast("long").alias("size"), F.lit(1).alias("copies"))


def grown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All features, and chromosomes, of a genome that grows with the table, so that all find places.
    A thousand events are laid out as in ``intervals``, on ``chroms``."""
    k = max(1, -(-table(spark, sf_dir, "events").count() // 1000))
    start = (F.col("event_id") * 7919) % (500000 * k)
    iv = intervals(spark, sf_dir).withColumns({"start": start, "end": start + (F.col("end") - F.col("start"))})
    return iv, chroms(spark).withColumn("size", F.col("size") * k)


def simulated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``grown`` as features, references and chromosomes."""
    iv, sizes = grown(spark, sf_dir)
    return iv.where("event_id % 3 != 0"), iv.where("event_id % 3 = 0"), sizes


def two_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (F.col("event_id") * 7919) % 97
    return (
        table(spark, sf_dir, "events")
        .select(F.concat(F.lit("chr"), (F.col("user_id") % 5 + 1).cast("string")).alias("chrom"), (k * 1000).alias("start"), (k * 1000 + 100 * (1 + k % 7)).alias("end"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("name"), "value")
        .groupBy("chrom", "start", "end", "name")
        .agg(F.avg("value").alias("score"))
    )


def iterated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A complete grid: twenty iterations from -1, and as many features as the table fills."""
    id_ = F.floor(F.col("event_id") / 20)
    return table(spark, sf_dir, "events").select(
        id_.alias("id"), (F.col("event_id") % 20 - 1).cast("int").alias("iteration"), F.col("value").alias("score"),
        (id_ % 50 + 1).cast("double").alias("length"), ((id_ % 50) * 1.5).alias("bed_score"),
    )


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("sample"), F.concat(F.lit("chr"), (F.col("user_id") % 5 + 1).cast("string")).alias("chrom"),
        ((F.col("event_id") * 7919) % 500000).alias("pos"), (F.lit(1) + F.floor("value")).cast("int").alias("len"),
    )


def fixed_bins(spark: SparkSession) -> DataFrame:
    return chroms(spark).select("chrom", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("bin")).select(
        "chrom", F.col("bin").cast("long").alias("bin"), (F.col("bin") * 10000).cast("long").alias("start"), (F.col("bin") * 10000 + 9999).cast("long").alias("end")
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    start = F.col("l_orderkey") % 400 * 6000 + F.col("l_linenumber") * 1000
    x = one.select("l_orderkey", start.cast("long").alias("s"), (start + 100 + F.col("q").cast("long")).cast("long").alias("e"))
    z = x.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("x"))
    return z.select(
        F.concat(F.lit("g"), (F.col("l_orderkey") % 400).cast("string")).alias("gene"), F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("name"),
        F.concat(F.lit("chr"), (F.col("l_orderkey") % 5).cast("string")).alias("chrom"), F.when(F.col("l_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.array_min("x.s").alias("txStart"), F.array_max("x.e").alias("txEnd"), F.col("x.s").alias("exonStarts"), F.col("x.e").alias("exonEnds"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chrom"), upper_bases("text").alias("seq"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job"), F.floor(F.col("o_orderkey") / 2).alias("predecessor"), F.lit(1).alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 137).alias("exit_status"), F.col("o_totalprice").alias("maxvmem"),
        F.col("o_orderstatus").alias("state"), F.concat(F.lit("c"), (F.col("o_orderkey") % 700).cast("string")).alias("command"), F.lit(False).alias("deleted"),
    )


#: The same projections as common table expressions.
SQL = {
    "iv": """iv AS (SELECT event_id, 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % 500000 AS s,
        (event_id * 7919) % 500000 + 1 + CAST(floor(value * 4) AS BIGINT) AS e, CAST(event_id AS VARCHAR) AS name, value AS score,
        CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM events)""",
    "f": "f AS (SELECT * FROM iv WHERE event_id % 3 <> 0)",
    "r": "r AS (SELECT * FROM iv WHERE event_id % 3 = 0)",
    "chroms": "chroms AS (SELECT 'chr' || i AS chrom, 600000 AS size FROM range(1, 6) t(i))",
    "two": """two AS (SELECT chrom, s, e, name, avg(value) AS score FROM (SELECT 'chr' || (user_id % 5 + 1) AS chrom, ((event_id * 7919) % 97) * 1000 AS s,
        ((event_id * 7919) % 97) * 1000 + 100 * (1 + ((event_id * 7919) % 97) % 7) AS e, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS name, value FROM events)
        GROUP BY ALL)""",
    "al": """al AS (SELECT chrom, s, e, coalesce(max(score) FILTER (name = 'a'), 0) AS x, coalesce(max(score) FILTER (name = 'b'), 0) AS y,
        count(*) FILTER (name = 'a') > 0 AS has_x, count(*) FILTER (name = 'b') > 0 AS has_y FROM two GROUP BY ALL)""",
    "it": """it AS (SELECT event_id // 20 AS id, CAST(event_id % 20 - 1 AS INTEGER) AS iteration, value AS score, CAST((event_id // 20) % 50 + 1 AS DOUBLE) AS length,
        ((event_id // 20) % 50) * 1.5 AS bed_score FROM events)""",
    "fr": """fr AS (SELECT 's' || (event_id % 3) AS sample, 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % 500000 AS pos,
        CAST(1 + floor(value) AS BIGINT) AS len FROM events)""",
    "tx": """tx AS (SELECT 'g' || (l_orderkey % 400) AS gene, 't' || l_orderkey AS name, 'chr' || (l_orderkey % 5) AS chrom,
        CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_orderkey % 400 * 6000 + l_linenumber * 1000 AS s, l_orderkey % 400 * 6000 + l_linenumber * 1000 + 100 + CAST(floor(max(l_quantity)) AS BIGINT) AS e
        FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "sq": """sq AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS seq FROM documents)""",
    "jobs": """jobs AS (SELECT o_orderkey AS job, o_orderkey // 2 AS predecessor, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 137 END AS exit_status,
        o_totalprice AS maxvmem, o_orderstatus AS state, 'c' || (o_orderkey % 700) AS command FROM orders)""",
}


def with_(*names: str) -> str:
    """A WITH clause of the named projections, in order, with what they read."""
    need = {"f": ("iv",), "r": ("iv",), "al": ("two",)}
    order: list[str] = []
    for n in names:
        for x in (*need.get(n, ()), n):
            if x not in order:
                order.append(x)
    return "WITH " + ",\n".join(SQL[n] for n in order)
