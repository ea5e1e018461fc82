"""Small column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x: str | Column, scale: float = 1) -> Column:
    """``int(x * scale + 0.5) / scale``, where int() cuts toward zero."""
    y = col(x) * scale + 0.5
    return F.when(y < 0, F.ceil(y)).otherwise(F.floor(y)) / scale


def log10_or_null(x: str | Column) -> Column:
    """log10 of positive values, else null."""
    return F.when(col(x) > 0, F.log10(col(x)))


def binned(x: str | Column, size: float, low: float | None = None, high: float | None = None, floor: bool = False) -> Column:
    """The value rounded (half to even; with ``floor``, down) to a multiple of ``size``, kept within bounds."""
    y = col(x) / size
    out = (F.floor(y) if floor else F.bround(y)) * size
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return out.cast("double")


def human(x: str | Column) -> Column:
    """Numbers with K, M or G."""
    v = col(x)
    cut = lambda d, u: F.concat(F.format_string("%s", F.round(v / d, 1)), F.lit(u))
    return F.when(v >= 1e9, cut(1e9, "G")).when(v >= 1e6, cut(1e6, "M")).when(v >= 1e3, cut(1e3, "K")).otherwise(v.cast("string"))


def stars(p: str | Column) -> Column:
    """Marks of significance."""
    v = col(p)
    return F.when(v < 1e-4, "***").when(v < 1e-3, "**").when(v < 0.01, "*").otherwise("")


def wall_seconds(x: str | Column) -> Column:
    """Seconds of hh:mm:ss; of two parts the first are hours."""
    part = F.split(col(x), ":")
    n = lambda i: F.coalesce(F.get(part, F.lit(i)).cast("long"), F.lit(0))
    return n(0) * 3600 + n(1) * 60 + n(2)


def status_minutes(x: str | Column) -> Column:
    """Approximate minutes of ``mm/dd/yy hh:mm``: years of 365 days, months of 30."""
    g = lambda i: F.regexp_extract(col(x), r"^(\d+)/(\d+)/(\d+) (\d+):(\d+)", i).cast("long")
    return (((g(3) * 365 + g(1) * 30 + g(2)) * 24) + g(4)) * 60 + g(5)


def memory_gigabytes(x: str | Column) -> Column:
    """Memory as G; K and M are scaled, with three decimals."""
    n, unit = F.regexp_extract(col(x), r"^([\d.]+)", 1).cast("double"), F.upper(F.regexp_extract(col(x), r"([KMGkmg])", 1))
    return F.round(F.when(unit == "K", n / 1e6).when(unit == "M", n / 1e3).otherwise(n), 3)


def reverse_complement(x: str | Column) -> Column:
    """The other strand; N then stands for any base."""
    return F.translate(F.reverse(F.translate(F.upper(col(x)), "ACGT", "TGCA")), "N", ".")


def name_field(x: str | Column) -> Column:
    """The map of ``tag:value;tag:value`` names."""
    return F.str_to_map(col(x), F.lit(";"), F.lit(":"))
