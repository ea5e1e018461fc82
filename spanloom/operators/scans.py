"""Scans over the blocks of a long row: what all blocks before make together, by an associative product."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.sources.folders import materialized

#: Neighbouring blocks that one task multiplies.
FAN = 64


def prefixes(items: DataFrame, keys: list[str], combine: Callable[[bytes, bytes], bytes], fan: int = FAN) -> DataFrame:
    """``keys, block, item`` with ``before``, the product of the items of all lower blocks of the same keys, null for the first.

    ``block`` is a whole number from 0, with or without holes, and ``combine(lower, higher)`` is associative.
    Groups of ``fan`` neighbours are multiplied, and their products in groups again, until one group is
    left; what stands before a group is then handed down to its members.  No task holds more than ``fan`` items."""
    kinds = dict(items.dtypes)
    columns = ", ".join(f"{k} {kinds[k]}" for k in keys)
    group = F.floor(F.col("block") / fan)
    top = items.agg(F.max("block")).first()[0] or 0

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        made = pdf["item"].iloc[0]
        for x in pdf["item"].iloc[1:]:
            made = combine(made, x)
        out = pdf.iloc[:1][keys].copy()
        out["block"], out["item"] = int(pdf["block"].iloc[0]) // fan, made
        return out

    def running(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        made, before = pdf["above"].iloc[0], []
        for x in pdf["item"]:
            before.append(made)
            made = x if made is None else combine(made, x)
        return pdf[[*keys, "block", "item"]].assign(before=before)

    if top >= fan:
        above = materialized(items.groupBy(*keys, group.alias("group")).applyInPandas(total, f"{columns}, block long, item binary"))
        above = prefixes(above, keys, combine, fan).select(*keys, F.col("block").alias("group"), F.col("before").alias("above"))
        held = items.withColumn("group", group).join(above, [*keys, "group"])
    else:
        held = items.withColumns({"group": group, "above": F.lit(None).cast("binary")})
    return held.groupBy(*keys, "group").applyInPandas(running, f"{columns}, block long, item binary, before binary")
