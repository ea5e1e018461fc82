"""Interval tables and the other text and binary inputs of the engine."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spanloom.operators.genome import in_pieces
from spanloom.sources.folders import materialized

BED = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("strand", T.StringType()),
        T.StructField("extra", T.ArrayType(T.StringType())),
    ]
)
CHROMS = "chrom string, size long"


def _integer(text: Column, what: str) -> Column:
    """A non-negative integer that may hold thousands commas; anything else ends the run."""
    plain = F.regexp_replace(text, ",", "")
    return F.when(plain.rlike(r"^\d+$"), plain.cast("long")).otherwise(
        F.raise_error(F.concat(F.lit(f"invalid {what}: "), F.coalesce(text, F.lit("null")))).cast("long")
    )


def parse_bed(lines: DataFrame, *, stranded: bool = False, padding: int = 0, allow_empty: bool = True) -> DataFrame:
    """Features from a ``value`` column of tab-separated lines.

    Lines that start with ``#`` or have no first field are skipped and carriage returns
    dropped.  Positions must be non-negative integers; with ``stranded`` the strand must
    be + or -; without ``allow_empty`` a feature of no length is an error.  ``padding``
    is added on both sides at load and may give a negative start."""
    f = F.split(F.regexp_replace("value", "\r", ""), "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f")).where("f[0] != ''")
    score = F.try_element_at("f", F.lit(5))
    out = rows.select(
        F.col("f")[0].alias("chrom"),
        _integer(F.try_element_at("f", F.lit(2)), "start").alias("start"),
        _integer(F.try_element_at("f", F.lit(3)), "end").alias("end"),
        F.try_element_at("f", F.lit(4)).alias("name"),
        F.when(score.isin("", "NULL", "NA"), None).otherwise(score.cast("double")).alias("score"),
        F.try_element_at("f", F.lit(6)).alias("strand"),
        F.slice("f", 7, F.greatest(F.size("f") - 6, F.lit(0))).alias("extra"),
    )
    if stranded:
        out = out.withColumn(
            "strand",
            F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(
                F.raise_error(F.concat(F.lit("invalid strand: "), F.coalesce("strand", F.lit("null")))).cast("string")
            ),
        )
    if not allow_empty:
        out = out.withColumn("end", F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.raise_error(F.lit("feature without length")).cast("long")))
    return out.withColumns({"start": F.col("start") - padding, "end": F.col("end") + padding})


def read_bed(spark: SparkSession, *paths: str, **how) -> DataFrame:
    """Features of BED files; several paths are read together, and gzip is recognised by name."""
    return parse_bed(spark.read.text(list(paths)), **how)


def write_bed(features: DataFrame, path: str, *, mode: str = "overwrite", lines_per_file: int = 0, compression: str | None = None) -> None:
    """Tab-separated BED rows; ``lines_per_file`` splits the output as it is written."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c) for c in features.columns if c != "extra"]
    out = features.select(*columns).write.mode(mode).option("sep", "\t")
    if lines_per_file:
        out = out.option("maxRecordsPerFile", lines_per_file)
    if compression:
        out = out.option("compression", compression)
    out.csv(path)


def read_chroms(
    spark: SparkSession, path: str, *, female: bool = False, use_mito: bool = False, ploidy: bool = True, canonical: bool = False
) -> DataFrame:
    """``chrom, size, copies``.  A female genome has no chrY and one weight for all; a male one has
    two copies of all but X and Y.  chrM counts with ``use_mito``.  ``canonical`` keeps names that
    hold chr and a number, X, Y or M."""
    out = spark.read.schema(CHROMS).option("sep", "\t").option("comment", "#").csv(path)
    return weigh_chroms(out, female=female, use_mito=use_mito, ploidy=ploidy, canonical=canonical)


def weigh_chroms(chroms: DataFrame, *, female: bool = False, use_mito: bool = False, ploidy: bool = True, canonical: bool = False) -> DataFrame:
    name = F.upper("chrom")
    if female:
        chroms = chroms.where(name != "CHRY")
    if not use_mito:
        chroms = chroms.where(name != "CHRM")
    if canonical:
        chroms = chroms.where(name.rlike(r"CHR(M|X|Y|\d+)"))
    single = F.lit(female or not ploidy) | name.isin("CHRX", "CHRY")
    return chroms.select("chrom", "size", F.when(single, 1).otherwise(2).alias("copies"))


def read_crosstab(spark: SparkSession, path: str, *, times_100: bool = False) -> DataFrame:
    """A wide simulation table with a header; iteration columns are named I-1, I0, I1, ..."""
    wide = spark.read.option("sep", "\t").option("header", True).csv(path)
    scores = [c for c in wide.columns[6:]]
    factor = 100.0 if times_100 else 1.0
    value = lambda c: F.when(F.col(f"`{c}`").isin("NA", "NULL", ""), None).otherwise(F.col(f"`{c}`").cast("double") * factor)
    head = [F.col(f"`{c}`").cast(t).alias(n) for c, n, t in zip(wide.columns, ("chrom", "start", "end", "name", "score", "strand"), ("string", "long", "long", "string", "double", "string"))]
    return wide.select(*head, *[value(c).alias(c) for c in scores])


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, seq``: one row per record, without blanks, in upper case."""
    records = spark.read.option("lineSep", ">").text(path).where("trim(value) != ''")
    head = F.regexp_extract("value", r"^\s*(\S+)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(head.alias("chrom"), F.upper(body).alias("seq"))


def read_fasta_pieces(spark: SparkSession, path: str, piece: int = 1 << 16) -> DataFrame:
    """Records as pieces of ``piece`` bases: ``chrom, start, seq``, without blanks, in upper case; the last is what is left.

    Lines are read as Spark splits files, so one long record is many tasks.  A line's record and its
    place in it are running counts: within the part of a file that a task read, from what all parts
    before hold.  No row is longer than a piece or a line."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("at"), "value"
    )
    bare = F.upper(F.regexp_replace("value", r"\s", ""))
    head = F.ltrim("value").startswith(">")
    lines = raw.select("file", "part", "at", F.when(head, F.regexp_extract("value", r"^\s*>\s*(\S+)", 1)).alias("head"), F.when(head, "").otherwise(bare).alias("seq"))
    # numbers of lines hang on how files were dealt to tasks, so they are written before they are used twice
    lines = materialized(lines.where("head is not null or seq != ''"))
    length = F.length("seq").cast("long")
    own = Window.partitionBy("file", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({"record": F.count("head").over(own), "upto": F.sum(length).over(own)})
    parts = lines.groupBy("file", "part").agg(F.max("record").alias("records"), F.max("upto").alias("bases"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select("file", "part", F.coalesce(F.sum("records").over(before), zero).alias("r0"), F.coalesce(F.sum("bases").over(before), zero).alias("b0"))
    placed = lines.join(parts, ["file", "part"]).select("file", "head", "seq", (F.col("record") + F.col("r0")).alias("record"), (F.col("upto") + F.col("b0") - length).alias("from"))
    names = placed.where("head is not null").select("file", "record", F.col("head").alias("chrom"), F.col("from").alias("zero"))
    bases = placed.where("seq != ''").join(names, ["file", "record"]).select("file", "record", "chrom", (F.col("from") - F.col("zero")).alias("start"), "seq")
    # a name is a record's, wherever it stands; lines that cross the borders of pieces are cut there
    return in_pieces(bases.select("chrom", "start", "seq"), piece)


def to_fasta(sequences: DataFrame, width: int = 50) -> DataFrame:
    """``value`` lines of FASTA records, the sequence cut to ``width`` columns."""
    body = F.rtrim(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), )
    return sequences.select(F.concat(F.lit(">"), "chrom", F.lit("\n"), body).alias("value"))


#: Records of a packed map that a row carries on the way to its columns.
PACKED_ROWS = 1 << 14


def read_break_map(spark: SparkSession, path: str, sample: str, chrom: str) -> DataFrame:
    """Break positions of packed records: unsigned 32-bit position, signed 16-bit delta, little-endian.

    Records have six bytes, so Spark deals ranges of them: one long file is many tasks.  A file that ends within a record is an error."""

    def joined(records):
        while rows := list(islice(records, PACKED_ROWS)):
            yield (bytearray(b"".join(rows)),)

    def unpack(batches):
        kind = np.dtype([("pos", "<u4"), ("delta", "<i2")])
        for b in batches:
            for raw in b.column("content").to_pylist():
                r = np.frombuffer(raw, kind)
                yield pa.RecordBatch.from_arrays([pa.array(r["pos"].astype(np.int64)), pa.array(r["delta"].astype(np.int32))], ["pos", "delta"])

    packed = spark.createDataFrame(spark.sparkContext.binaryRecords(path, 6).mapPartitions(joined), "content binary")
    rows = packed.mapInArrow(unpack, "pos long, delta int")
    return rows.select(F.lit(sample).alias("sample"), F.lit(chrom).alias("chrom"), "pos", "delta")


def latest_stats(stats: DataFrame) -> DataFrame:
    """Key-value statistics ``entity, name, value, version``: the last write wins and an empty value deletes."""
    last = F.max_by(F.struct("value"), "version").alias("last")
    return stats.groupBy("entity", "name").agg(last).select("entity", "name", "last.value").where("value is not null and value != ''")
