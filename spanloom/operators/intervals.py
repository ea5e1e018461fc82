"""Interval algebra: padding, merging, splitting, complements, grouping and depth.

Features are half-open.  Chromosomes can be few and huge, so running values are taken in
two steps: within position bins (many tasks), starting from running values over the bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.sources.folders import stored

#: Positions of one first-step task: a chromosome of 250 million is 3,815 of them.
BIN = 1 << 16


def strand_index(stranded: bool) -> Column:
    return F.col("strand") if stranded else F.lit(".")


def pad(features: DataFrame, padding: int) -> DataFrame:
    """Grow both sides; a start may become negative."""
    return features.withColumns({"start": F.col("start") - padding, "end": F.col("end") + padding})


def unpad(features: DataFrame, padding: int) -> DataFrame:
    return pad(features, -padding)


def offset(features: DataFrame, by: int) -> DataFrame:
    """Shift features, for the offset control."""
    return features.withColumns({"start": F.col("start") + by, "end": F.col("end") + by})


def with_previous(df: DataFrame, keys: list[str], pos: str, columns: list[str], bin_size: int = BIN) -> DataFrame:
    """Add ``previous``: ``pos`` and ``columns`` of the row before, in order of ``pos``, within ``keys``.

    In two steps: within position bins; a bin's first row takes the last of the bin before that has one."""
    d = df.withColumn("bin_", F.floor(F.col(pos) / bin_size))
    row = F.struct(pos, *columns)
    last = d.groupBy(*keys, "bin_").agg(F.max(row).alias("last_"))
    over = Window.partitionBy(*keys).orderBy("bin_")
    last = last.select(*keys, "bin_", F.lag("last_").over(over).alias("before_"))
    own = Window.partitionBy(*keys, "bin_").orderBy(row)
    return d.join(last, [*keys, "bin_"]).withColumn("previous", F.coalesce(F.lag(row).over(own), F.col("before_"))).drop("bin_", "before_")


def cumulative(df: DataFrame, keys: list[str], pos: str, value: str, name: str, bin_size: int = BIN, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add the running sum of ``value`` in order of ``pos``, then ``ties``, within ``keys``: within position bins, plus what stands before the bin."""
    return running_sums(df, keys, pos, {name: value}, bin_size, ties)


def running_sums(df: DataFrame, keys: list[str], pos: str, sums: dict[str, str], bin_size: int = BIN, ties: tuple[str, ...] = ()) -> DataFrame:
    """``cumulative`` of several columns at once, ``sums`` being new names and the columns that are summed; a null adds nothing."""
    d = df.withColumn("bin_", F.floor(F.col(pos) / bin_size))
    over = Window.partitionBy(*keys).orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)
    base = d.groupBy(*keys, "bin_").agg(*(F.sum(v).alias(f"sum_{n}_") for n, v in sums.items()))
    base = base.select(*keys, "bin_", *(F.sum(f"sum_{n}_").over(over).alias(f"base_{n}_") for n in sums))
    own = Window.partitionBy(*keys, "bin_").orderBy(pos, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0)
    run = {n: F.coalesce(F.sum(v).over(own), zero) + F.coalesce(f"base_{n}_", zero) for n, v in sums.items()}
    return d.join(base, [*keys, "bin_"]).withColumns(run).drop("bin_", *(f"base_{n}_" for n in sums))


def _islands(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number the islands of each key: a row opens one if it starts beyond all ends before."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    return df.withColumn("opens", opens).withColumn(
        "island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def _opening(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``opening``, the start of the island that a bin's part belongs to.

    The parts of a bin do not meet.  A part that starts within the reach of the bins before
    goes on with their last island; all others open one.  So a bin needs to know only the
    largest end and the last opening before it, running values over bins: no task holds the
    parts of a chromosome."""
    over = Window.partitionBy(*keys).orderBy("bin")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    bins = parts.groupBy(*keys, "bin").agg(F.max("end").alias("top"), F.max("start").alias("last"))
    bins = bins.withColumn("reach", F.max("top").over(earlier))
    opened = F.when(F.col("reach").isNull() | (F.col("last") > F.col("reach")), F.col("last"))
    bins = bins.select(*keys, "bin", "reach", F.max(opened).over(earlier).alias("before"))
    alone = F.col("reach").isNull() | (F.col("start") > F.col("reach"))
    return parts.join(bins, [*keys, "bin"]).withColumn("opening", F.when(alone, F.col("start")).otherwise(F.col("before"))).drop("reach", "before")


def collapse(
    features: DataFrame, *, stranded: bool = False, padding: int = 0, unpadded: bool = False, names: bool = True, bin_size: int = BIN
) -> DataFrame:
    """Merge features that overlap or touch into regions: ``chrom, start, end, name, score, strand, n``.

    Names are joined by ``::`` in order of position; an empty one becomes
    ``chrom:start-end[strand]``.  The score is 0 and the strand + unless ``stranded``."""
    f = pad(features, padding) if padding else features
    named = F.when(
        F.coalesce(F.col("name").cast("string"), F.lit("")).isin("", "0"),
        F.format_string("%s:%d-%d[%s]", "chrom", "start", "end", "key"),
    ).otherwise(F.col("name").cast("string"))
    f = f.withColumn("key", strand_index(stranded)).withColumn("bin", F.floor(F.col("start") / bin_size))
    f = f.select("chrom", "key", "bin", "start", "end", (F.array(F.struct("start", "end", named.alias("name"))) if names else F.lit(None)).alias("own"))
    own = F.flatten(F.collect_list("own")) if names else F.first("own")
    part = _islands(f, ["chrom", "key", "bin"]).groupBy("chrom", "key", "bin", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), own.alias("own")
    )
    whole = _opening(part, ["chrom", "key"]).groupBy("chrom", "key", "opening").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), own.alias("own")
    )
    joined = F.array_join(F.transform(F.array_sort("own"), lambda x: x["name"]), "::") if names else F.lit(None).cast("string")
    shrink = padding if unpadded else 0
    return whole.select(
        "chrom", (F.col("start") + shrink).alias("start"), (F.col("end") - shrink).alias("end"), joined.alias("name"),
        F.lit(0.0).alias("score"), (F.col("key") if stranded else F.lit("+")).alias("strand"), "n",
    )


def in_regions(features: DataFrame, *, bin_size: int = BIN) -> tuple[DataFrame, DataFrame]:
    """The regions ``chrom, start, end, n`` into which ``collapse`` merges features, and before them the features with ``n`` of their region."""
    f = _islands(features.withColumn("bin", F.floor(F.col("start") / bin_size)), ["chrom", "bin"]).drop("opens")
    part = f.groupBy("chrom", "bin", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))
    part = stored(_opening(part, ["chrom"]).select("chrom", "bin", "island", "opening", "end", "n"))
    whole = part.groupBy("chrom", "opening").agg(F.max("end").alias("end"), F.sum("n").alias("n"))
    known = part.select("chrom", "bin", "island", "opening").join(whole.drop("end"), ["chrom", "opening"]).drop("opening")
    return f.join(known, ["chrom", "bin", "island"]).select(*features.columns, "n"), whole.withColumnRenamed("opening", "start")


def region_counts(features: DataFrame, keys: list[str], *, least: int, longest: int, bin_size: int = BIN) -> DataFrame:
    """``keys, n`` of the regions of at least ``least`` features, into which features of up to ``longest`` bases that overlap or touch merge.

    A region that no feature of another bin can reach is complete in its own, so only those near the bins' borders are
    shuffled again, and small ones are written nowhere."""
    f = features.select(*keys, "start", "end", F.floor(F.col("start") / bin_size).alias("bin"))
    own = ["bin", *keys]
    part = _islands(f, own).groupBy(*own, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))
    border = (F.col("start") < F.col("bin") * bin_size + longest) | (F.col("end") >= (F.col("bin") + 1) * bin_size)
    part = stored(part.withColumn("border", border).where(F.col("border") | (F.col("n") >= least)).drop("island"))
    whole = _opening(part.where("border"), keys).groupBy(*keys, "opening").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return part.where("not border").select(*keys, "n").unionByName(whole.select(*keys, "n"))


GROUP_SCORES = {
    "COUNT": lambda: F.count("*").cast("double"),
    "SUM": lambda: F.sum("score"),
    "AVERAGE": lambda: F.avg("score"),
    "MEDIAN": lambda: F.median("score"),
    "MIN": lambda: F.min("score"),
    "MAX": lambda: F.max("score"),
    "BOOLEAN": lambda: F.lit(1.0),
}


def median_upper(score: str = "score") -> Column:
    """The median as the entry at index int(n / 2 + 0.5) of the sorted scores: one too high for odd n, null for one."""
    sorted_ = F.array_sort(F.collect_list(score))
    return F.get(sorted_, F.floor(F.size(sorted_) / 2 + 0.5).cast("int"))


def group(
    features: DataFrame, score_type: str = "COUNT", *, stranded: bool = False, force_name: str | None = None,
    ignore_name: str | None = None, compat: bool = False,
) -> DataFrame:
    """One row for each distinct place, with joined sorted names and an aggregate score.

    Features named ``ignore_name`` add nothing but keep their place with score 0.  With
    ``compat`` the median is ``median_upper``, and without ``ignore_name`` every feature is
    passed over: names are empty and scores 0.  Features with a ``cell`` (of ``split``), which a
    place decides, are grouped where they are."""
    f = features.withColumn("key", strand_index(stranded))
    if compat and ignore_name is None:
        used = F.lit(False)
    else:
        used = F.lit(True) if ignore_name is None else F.coalesce(F.col("name").cast("string") != ignore_name, F.lit(True))
    f = f.withColumn("used", used).withColumn("score", F.when(F.col("used"), F.col("score")))
    value = median_upper() if compat and score_type == "MEDIAN" else GROUP_SCORES[score_type]()
    if score_type == "COUNT":
        value = F.sum(F.col("used").cast("int")).cast("double")
    joined = F.array_join(F.array_sort(F.collect_list(F.when(F.col("used"), F.col("name").cast("string")))), "::")
    out = f.groupBy("chrom", "start", "end", "key", *(c for c in ("cell",) if c in f.columns)).agg(
        (F.lit(force_name) if force_name else joined).alias("name"), value.alias("score"), F.max("used").alias("any")
    )
    score = F.when(F.col("any"), F.col("score")).otherwise(0.0)
    return out.select("chrom", "start", "end", "name", score.alias("score"), (F.col("key") if stranded else F.lit("+")).alias("strand"))


def tiles(points: DataFrame, keys: list[str], bin_size: int = BIN) -> DataFrame:
    """Consecutive pairs of distinct positions: ``keys, s, e``.

    ``lead`` runs in position bins; each bin's last position takes the first of the next bin that has one."""
    p = points.distinct().withColumn("bin", F.floor(F.col("pos") / bin_size))
    firsts = p.groupBy(*keys, "bin").agg(F.min("pos").alias("low"))
    nxt = firsts.withColumn("next", F.lead("low").over(Window.partitionBy(*keys).orderBy("bin"))).drop("low")
    here = F.lead("pos").over(Window.partitionBy(*keys, "bin").orderBy("pos"))
    return p.withColumn("here", here).join(nxt, [*keys, "bin"]).select(*keys, F.col("pos").alias("s"), F.coalesce("here", "next").alias("e")).where("e is not null")


def _cut(features: DataFrame, stranded: bool, chroms: DataFrame | None, bin_size: int, cell: int | None) -> tuple[DataFrame, DataFrame]:
    """Features, a row for each cell of positions that they touch, and the pieces ``s, e`` with theirs: ``chrom, key, cell``.

    A cell is about as long as a feature, so that most of what shares one meets; ``chroms`` cuts ends at the chromosome's size."""
    f = features.withColumn("key", strand_index(stranded)).withColumn(
        "end", F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.raise_error(F.lit("feature without length")).cast("long"))
    )
    if chroms is not None:
        f = f.join(F.broadcast(chroms.select("chrom", "size")), "chrom").withColumn("end", F.least("end", "size")).drop("size")
    keys = ["chrom", "key"]
    points = f.select(*keys, F.col("start").alias("pos")).unionByName(f.select(*keys, F.col("end").alias("pos")))
    if cell is None:
        mean = f.agg(F.avg(F.col("end") - F.col("start"))).first()[0] or 1
        cell = max(64, 1 << int(mean).bit_length())
    pairs = tiles(points, keys, bin_size).withColumn("cell", F.floor(F.col("s") / cell))
    return f.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("end") - 1) / cell)))), pairs


def split(features: DataFrame, *, stranded: bool = False, chroms: DataFrame | None = None, gaps: bool = False, bin_size: int = BIN, cell: int | None = None, cells: bool = False) -> DataFrame:
    """Cut every feature at every boundary on its chromosome (and strand).

    Pieces keep name and score.  ``chroms`` cuts ends at the chromosome's size; with ``gaps``
    the uncovered stretches are added as features GAP of score 0.  Features without length
    are an error.  A feature meets its pieces through the cells of positions both touch, so
    the join is an equality join.  With ``cells`` the pieces keep theirs, by which they are partitioned."""
    spread, pairs = _cut(features, stranded, chroms, bin_size, cell)
    out = spread.join(pairs, ["chrom", "key", "cell"]).where("s >= start and e <= end")
    own = ["cell"] if cells else []
    out = out.select("chrom", F.col("s").alias("start"), F.col("e").alias("end"), "name", "score", (F.col("key") if stranded else F.lit("+")).alias("strand"), *own)
    if gaps:
        if chroms is None:
            raise ValueError("gaps need the chromosome table")
        out = out.unionByName(complement(features, chroms, stranded=stranded, bin_size=bin_size), allowMissingColumns=cells)
    return out


def split_summed(features: DataFrame, *, stranded: bool = False, chroms: DataFrame | None = None, bin_size: int = BIN, cell: int | None = None) -> DataFrame:
    """``group(split(features), "SUM")``: one row for each piece, with joined sorted names and the sum of scores.

    A piece reads its features off the array of its cell's features, sorted once.  So the features of all pieces, whose
    number grows with the square of the depth, are never rows that are grouped and spilled; a cell's array is no longer
    than what its pieces' names tell, times their number."""
    spread, pairs = _cut(features, stranded, chroms, bin_size, cell)
    keys = ["chrom", "key", "cell"]
    one = F.struct(F.col("name").cast("string").alias("name"), "start", "end", "score")
    here = spread.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("here"))
    cut = pairs.groupBy(*keys).agg(F.collect_list(F.struct("s", "e")).alias("cut"))
    pieces = here.join(cut, keys).select("chrom", "key", "here", F.inline("cut"))
    own = F.filter("here", lambda x: (x["start"] <= F.col("s")) & (x["end"] >= F.col("e")))
    # exploded, so that it is computed once and not again for the condition and each use
    held = pieces.select("chrom", "key", "s", "e", F.explode(F.array(own)).alias("own")).where(F.size("own") > 0)
    names = F.array_join(F.col("own.name"), "::")
    scores = F.array_compact(F.col("own.score").cast("array<double>"))
    total = F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x))
    return held.select("chrom", F.col("s").alias("start"), F.col("e").alias("end"), names.alias("name"), total.alias("score"), (F.col("key") if stranded else F.lit("+")).alias("strand"))


def complement(features: DataFrame, chroms: DataFrame, *, stranded: bool = False, bin_size: int = BIN) -> DataFrame:
    """Uncovered stretches up to the chromosome's size, as features GAP of score 0.

    A chromosome without features is one gap; features on chromosomes not in the table are dropped."""
    sizes = chroms.select("chrom", "size")
    strands = F.explode(F.array(F.lit("+"), F.lit("-"))) if stranded else F.lit("+")
    whole = sizes.withColumn("strand", strands)
    merged = collapse(features, stranded=stranded, names=False, bin_size=bin_size).join(F.broadcast(sizes), "chrom")
    merged = merged.select("chrom", "strand", "start", "end", "size")
    gap = with_previous(merged, ["chrom", "strand"], "start", ["end"], bin_size)
    before = gap.select("chrom", "strand", F.coalesce("previous.end", F.lit(0)).alias("start"), F.least("start", "size").alias("end"))
    tail = whole.join(merged.groupBy("chrom", "strand").agg(F.max("end").alias("last")), ["chrom", "strand"], "left").select(
        "chrom", "strand", F.coalesce("last", F.lit(0)).alias("start"), F.col("size").alias("end")
    )
    return before.unionByName(tail).where("start < end").select(
        "chrom", "start", "end", F.lit("GAP").alias("name"), F.lit(0.0).alias("score"), "strand"
    )


def depth(features: DataFrame, *, weight: str | None = None, bin_size: int = BIN) -> DataFrame:
    """Covered stretches with how many features (or what sum of ``weight``) cover them: ``chrom, start, end, depth``.

    Sweep line over position bins: a bin starts from the sum of all changes before it."""
    d = F.lit(1).cast("long") if weight is None else F.col(weight)
    ends = features.select("chrom", F.col("start").alias("pos"), d.alias("d")).unionByName(features.select("chrom", F.col("end").alias("pos"), (-d).alias("d")))
    changes = ends.groupBy("chrom", "pos").agg(F.sum("d").alias("d"))
    return sweep(changes, ["chrom"], bin_size).withColumnRenamed("level", "depth").where("depth > 0")


def sweep(changes: DataFrame, keys: list[str], bin_size: int = BIN) -> DataFrame:
    """Stretches between successive changes ``pos, d`` of a level: ``keys, start, end, level``."""
    p = changes.withColumn("bin", F.floor(F.col("pos") / bin_size))
    bins = p.groupBy(*keys, "bin").agg(F.sum("d").alias("sum"), F.min("pos").alias("low"))
    over = Window.partitionBy(*keys).orderBy("bin")
    bins = bins.select(*keys, "bin", (F.sum("sum").over(over) - F.col("sum")).alias("base"), F.lead("low").over(over).alias("next"))
    w = Window.partitionBy(*keys, "bin").orderBy("pos")
    return (
        p.withColumns({"run": F.sum("d").over(w), "here": F.lead("pos").over(w)})
        .join(bins, [*keys, "bin"])
        .select(*keys, F.col("pos").alias("start"), F.coalesce("here", "next").alias("end"), (F.col("run") + F.col("base")).alias("level"))
        .where("end is not null")
    )
