"""Long and wide forms of iterated features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def iteration_column(i: int) -> str:
    return f"I{i}"


def crosstab(iterated: DataFrame, iterations: list[int], *, check: bool = True) -> DataFrame:
    """One row per id with a column for each iteration: the cells must be complete and single.

    Reads ``id, iteration, score``; the iterations are named, so no extra job finds them."""
    cells = F.count("*").alias("cells"), F.countDistinct("iteration").alias("kinds")
    wide = iterated.where(F.col("iteration").isin(iterations)).groupBy("id").agg(
        *cells, *[F.max(F.when(F.col("iteration") == i, F.col("score"))).alias(iteration_column(i)) for i in iterations]
    )
    if check:
        n = len(iterations)
        wide = wide.withColumn(
            "id",
            F.when((F.col("cells") == n) & (F.col("kinds") == n), F.col("id")).otherwise(
                F.raise_error(F.concat(F.lit("missing or repeated cells of id "), F.col("id").cast("string"))).cast(wide.schema["id"].dataType)
            ),
        )
    return wide.drop("cells", "kinds")


def crosstab_order(wide: DataFrame) -> DataFrame:
    """A crosstab by chromosome and place."""
    return wide.orderBy("chrom", "start", "end", "name")


def with_places(wide: DataFrame, features: DataFrame) -> DataFrame:
    """A crosstab with the BED columns of the actual features (``id, chrom, start, end, name, score, strand``) in front."""
    bed = ["chrom", "start", "end", "name", "score", "strand"]
    rest = [c for c in wide.columns if c != "id"]
    return features.select("id", *bed).join(wide, "id").select(*bed, *rest)


def uncrosstab(wide: DataFrame, iterations: list[int]) -> DataFrame:
    """``id, iteration, score`` of a wide table; empty cells stay as nulls."""
    long = wide.unpivot(["id"], [iteration_column(i) for i in iterations], "column", "score")
    return long.select("id", F.regexp_replace("column", "^I", "").cast("int").alias("iteration"), "score")
