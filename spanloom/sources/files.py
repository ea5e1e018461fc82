"""Predicates over paths, by the file system that Spark reads from, and checks of parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in any store Spark can read; sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found) if found else []


def exists(spark: SparkSession, *patterns: str) -> bool:
    return all(matching(spark, p) for p in patterns)


def require(spark: SparkSession, *patterns: str) -> None:
    for p in patterns:
        if not matching(spark, p):
            raise FileNotFoundError(p)


def gzipped(spark: SparkSession, pattern: str) -> bool:
    """Whether all matching files, of which there must be some, are named .gz."""
    found = matching(spark, pattern)
    return bool(found) and all(f.endswith(".gz") for f in found)


def check_prefix(spark: SparkSession, prefix: str) -> bool:
    """Whether the folder of a file prefix exists."""
    return exists(spark, prefix.rsplit("/", 1)[0] or "/")


def integer(value: str) -> int:
    """A whole number or an error."""
    return int(value)


def non_zero(value: str) -> float:
    if not float(value):
        raise ValueError("value is zero")
    return float(value)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with their counts."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)
