"""Interval joins: scores of queries against crossing references, and nearest references.

No score pairs queries with references, so a pile-up costs what its rows cost.  Counts and lengths
are differences of running sums over one ordered union: the references add to a count, and to a
line, where they begin and end, and a query reads both at its ends.  Greatest values are read from
dyadic cells, of which a query and a reference touch a few for each power of four of their lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.operators.intervals import BIN, collapse, pad, running_sums, strand_index, tiles

COLLAPSED = {"LENGTH", "FRACTION", "BOOLEAN", "BOOLEAN_ENDS"}
ZERO_DEFAULT = {"COUNT", "COUNT_ENDS", "WEIGHTED"} | COLLAPSED
SCORE_TYPES = ZERO_DEFAULT | {"WEIGHTED2", "MAX_REF_LENGTH", "MAX_REF_SCORE", "DISTANCE_CENTER", "DISTANCE_EDGE"}


def search_bin(refs: DataFrame) -> int:
    """Width of search bins: a hundredth of the largest end, at least twice the mean length."""
    r = refs.agg(F.max("end").alias("top"), F.sum(F.col("end") - F.col("start")).alias("bases"), F.count("*").alias("n")).first()
    if not r["n"]:
        return 1
    return max(int(r["top"] / 100), int(2 * r["bases"] / r["n"]), 1)


def crossing(
    queries: DataFrame, refs: DataFrame, score_type: str = "COUNT", *, stranded: bool = False, padding: int = 0,
    min_fraction: float = 0.0, max_null: float | None = None, touch: bool = True, compat: bool = False,
) -> DataFrame:
    """All queries with ``cross_score``: how they cross the references, by one of SCORE_TYPES.

    Touching counts as crossing (with ``touch=False`` it does not; with ``compat`` only where
    both share a search bin of ``search_bin``).  A query without length, or that crosses
    nothing, gets 0, or ``max_null`` for the types in which 0 would be a value.  Types about
    length and fraction see the references merged.  Padding grows both sides for the
    comparison; the output has the unpadded place.  Places are scored once and joined back."""
    if score_type not in SCORE_TYPES:
        raise ValueError(f"unknown score type {score_type}")
    keys = ["chrom", "key"]
    q = queries.withColumn("key", strand_index(stranded))
    refs = pad(refs, padding) if padding else refs
    # a reference crosses where it begins by ``hi`` and does not end before ``lo``
    ends = lambda start, end: (end - int(not touch), start + int(not touch))
    if score_type == "COUNT" and not compat and (longest := _longest(q)) <= LONGEST_AT_HOME:
        hi, lo = ends(F.col("start") - padding, F.col("end") + padding)
        hi = F.when(F.col("end") - F.col("start") != -2 * padding, hi)
        return counts_at_home(q.withColumns({"hi_": hi, "lo_": lo}), refs.select("chrom", strand_index(stranded).alias("key"), F.col("start").alias("rs"), F.col("end").alias("re")), keys, max(0, longest + 2 * padding)).select(*queries.columns, "cross_score")
    if score_type in COLLAPSED:
        refs = collapse(refs, stranded=stranded, names=False).withColumn("score", F.lit(0.0))
    r = refs.select("chrom", strand_index(stranded).alias("key"), F.col("start").alias("rs"), F.col("end").alias("re"), F.col("score").alias("ref_score"))
    places = q.select(*keys, (F.col("start") - padding).alias("start"), (F.col("end") + padding).alias("end")).distinct()
    default = F.lit(0.0) if score_type in ZERO_DEFAULT else F.lit(max_null)
    if score_type.startswith("DISTANCE"):
        scored = nearest(places, r, keys, center=score_type == "DISTANCE_CENTER")
    else:
        hi, lo = ends(F.col("start"), F.col("end"))
        if compat:
            width = search_bin(refs)
            same = lambda a, b: F.expr(f"({a}) div {width} = ({b}) div {width}")
            hi, lo = F.col("end") - F.when(same("end", "end - 1"), 0).otherwise(1), F.col("start") + F.when(same("start", "start - 1"), 0).otherwise(1)
            r = r.where(F.expr(f"rs div {width} <= (re - 1) div {width}"))
        scored = _scores(score_type, places.where("start != end").withColumns({"hi": hi, "lo": lo}), r, keys, min_fraction)
    scored = scored.select(*keys, (F.col("start") + padding).alias("start"), (F.col("end") - padding).alias("end"), "cross_score")
    return q.join(scored, [*keys, "start", "end"], "left").select(
        *[c for c in queries.columns], F.coalesce("cross_score", default.cast("double")).cast("double").alias("cross_score")
    )


def _scores(score_type: str, places: DataFrame, refs: DataFrame, keys: list[str], min_fraction: float) -> DataFrame:
    length = F.col("end") - F.col("start")
    if score_type == "COUNT":
        return crossing_counts(places, refs, keys)
    if score_type == "COUNT_ENDS":
        longest = _longest(places)
        if longest <= LONGEST_AT_HOME:
            n = counts_at_home(places.withColumns({"hi_": F.col("hi"), "lo_": F.col("lo")}), refs, keys, longest).select(*keys, "start", "end", "cross_score")
        else:
            n = crossing_counts(places, refs, keys)
        # the references that cross without meeting an end lie inside
        inner = _inside(places, refs, keys).withColumn("cross_score", -F.col("cross_score"))
        return n.unionByName(inner).groupBy(*keys, "start", "end").agg(F.sum("cross_score").alias("cross_score"))
    if score_type == "BOOLEAN_ENDS":
        # those around the start, and those around the end
        around = F.array(F.struct("lo", F.col("start").alias("hi")), F.struct(F.col("end").alias("lo"), "hi"))
        both = places.select(*keys, "start", "end", F.explode(around).alias("at")).select(*keys, "start", "end", "at.*")
        at = crossing_counts(both, refs, keys)
        return at.withColumn("cross_score", (F.col("cross_score") > 0).cast("double"))
    if score_type.startswith("MAX_REF"):
        value = F.col("re") - F.col("rs") if score_type == "MAX_REF_LENGTH" else F.col("ref_score")
        return greatest_crossing(places, refs.withColumn("value", value.cast("double")).where("value is not null"), keys)
    sums = overlap_sums(places, refs, keys, weighted=score_type.startswith("WEIGHTED"))
    part = F.col("overlap") / length
    least = F.lit(min_fraction) if min_fraction else 1 / length
    score = {
        "LENGTH": F.col("overlap"), "FRACTION": part, "BOOLEAN": (part >= least).cast("int"), "WEIGHTED": F.col("weighted") / length,
        "WEIGHTED2": F.when(F.col("overlap") > 0, F.col("weighted") / F.col("overlap")),
    }[score_type]
    return sums.select(*keys, "start", "end", score.cast("double").alias("cross_score"))


def _read(places: DataFrame, ends: list[tuple[Column, int]], changes: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Of each place, the sums of ``values`` over its reads, each a position and a sign.

    A read sees the running sums of the columns of ``changes`` (``keys``, ``pos`` and amounts) over
    all changes at or before its position."""
    names = [c for c in changes.columns if c not in (*keys, "pos")]
    at = F.explode(F.array(*(F.struct(pos.cast("long").alias("pos"), F.lit(sign).alias("sign")) for pos, sign in ends)))
    reads = places.select(*keys, "start", "end", at.alias("read")).select(*keys, "start", "end", "read.*")
    amounts = changes.groupBy(*keys, "pos").agg(*(F.sum(c).alias(c) for c in names))
    seen = running_sums(reads.unionByName(amounts, allowMissingColumns=True), keys, "pos", {f"{c}_run": c for c in names}, ties=("sign",))
    return seen.where("sign is not null").groupBy(*keys, "start", "end").agg(*(F.sum(v).alias(n) for n, v in values.items()))


def crossing_counts(places: DataFrame, refs: DataFrame, keys: list[str]) -> DataFrame:
    """How many references each place crosses: those that have begun by ``hi``, less those that have ended before ``lo``."""
    one = lambda end, b, e: refs.select(*keys, F.col(end).alias("pos"), F.lit(b).cast("long").alias("begun"), F.lit(e).cast("long").alias("ended"))
    count = F.when(F.col("sign") > 0, F.col("begun_run")).otherwise(-F.col("ended_run"))
    ends = [(F.col("hi"), 1), (F.col("lo") - 1, -1)]
    return _read(places, ends, one("rs", 1, 0).unionByName(one("re", 0, 1)), keys, {"cross_score": count}).withColumn("cross_score", F.col("cross_score").cast("double"))


#: Queries up to this length are counted in the cell of their start.
LONGEST_AT_HOME = 64 * BIN


def _longest(queries: DataFrame) -> int:
    return max(0, queries.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0)


def counts_at_home(queries: DataFrame, refs: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """``queries`` with ``cross_score``, how many references each crosses, by ``lo_`` and ``hi_``, which lie no more than ``longest`` apart; without ``hi_``, none.

    As in ``crossing_counts``, but a query is one row, shuffled once, to the cell of its ``lo_``.  The cell holds the references
    that begin or end in it or begin up to ``longest`` behind it, and a row with what begins and ends before it."""
    size = BIN
    while size < longest:
        size *= 2
    of = lambda pos: F.floor(pos / size)
    one = lambda end, b, e: refs.select(*keys, F.col(end).alias("at"), F.lit(b).cast("long").alias("begun_"), F.lit(e).cast("long").alias("ended_"))
    refs = refs.dropna(subset=keys)
    changes = one("rs", 1, 0).unionByName(one("re", 0, 1)).groupBy(*keys, "at").agg(F.sum("begun_").alias("begun_"), F.sum("ended_").alias("ended_"))
    q = queries.withColumn("cell_", of(F.col("lo_")))
    earlier = Window.partitionBy(*keys).orderBy("cell_").rowsBetween(Window.unboundedPreceding, -1)
    sums = changes.groupBy(*keys, of(F.col("at")).alias("cell_")).agg(F.sum("begun_").alias("begun_"), F.sum("ended_").alias("ended_"))
    cells = sums.unionByName(q.select(*keys, "cell_", F.lit(True).alias("asked")).distinct(), allowMissingColumns=True)
    cells = cells.groupBy(*keys, "cell_").agg(F.sum("begun_").alias("begun_"), F.sum("ended_").alias("ended_"), F.max("asked").alias("asked"))
    before = cells.select(*keys, "cell_", "asked", F.sum("begun_").over(earlier).alias("begun_"), F.sum("ended_").over(earlier).alias("ended_")).where("asked").drop("asked")
    inside = changes.withColumn("cell_", F.explode(F.sequence(of(F.col("at") - longest), of(F.col("at")))))
    both = inside.unionByName(before, allowMissingColumns=True).select(*keys, "cell_", F.col("at").alias("at_hi_"), F.col("at").alias("at_lo_"), "begun_", "ended_")
    u = q.withColumns({"at_hi_": F.col("hi_"), "at_lo_": F.col("lo_") - 1, "query_": F.lit(True)}).unionByName(both, allowMissingColumns=True)

    def so_far(amount: str, at: str) -> Column:
        w = Window.partitionBy(*keys, "cell_").orderBy(F.col(at).asc_nulls_first(), F.col("query_").asc_nulls_first())
        return F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))

    n = so_far("begun_", "at_hi_") - so_far("ended_", "at_lo_")
    return u.withColumn("n_", n).where("query_").withColumn("cross_score", F.when(F.col("hi_").isNotNull(), F.col("n_")).otherwise(0).cast("double"))


#: Scores are summed as whole multiples of 2 ** -20, exactly, and what is left of them as doubles.
FINE = float(1 << 20)


def overlap_sums(places: DataFrame, refs: DataFrame, keys: list[str], *, weighted: bool = False) -> DataFrame:
    """Of each place, ``overlap``: the summed lengths that references share with it, and with ``weighted`` also that of length times ``ref_score``.

    The length of references before a position is a line between their ends; a place reads it at both of its own."""
    sign = F.col("sign")

    def line(n: str, m: str) -> Column:
        return sign * (F.col("pos") * F.col(f"{n}_run") - F.col(f"{m}_run"))

    score = F.coalesce("ref_score", F.lit(0.0)) * FINE if weighted else F.lit(0.0)
    fine = F.floor(score)

    def change(end: str, way: int) -> DataFrame:
        pos = F.col(end)
        out = refs.select(*keys, pos.alias("pos"), F.lit(way).cast("long").alias("n"), (pos * way).alias("m"), (fine * way).cast("decimal(19,0)").alias("w"), ((score - fine) * way).alias("rest"))
        if not weighted:
            return out.drop("w", "rest")
        return out.withColumns({"wm": F.col("w") * F.col("pos").cast("decimal(19,0)"), "restm": F.col("rest") * F.col("pos")})

    values = {"overlap": line("n", "m")}
    if weighted:
        whole = sign.cast("decimal(1,0)") * (F.col("pos").cast("decimal(19,0)") * F.col("w_run").cast("decimal(19,0)") - F.col("wm_run"))
        values |= {"whole": whole, "part": line("rest", "restm")}
    out = _read(places, [(F.col("start"), -1), (F.col("end"), 1)], change("rs", 1).unionByName(change("re", -1)), keys, values)
    return out.withColumn("weighted", (F.col("whole").cast("double") + F.col("part")) / FINE).drop("whole", "part") if weighted else out


def _levels(df: DataFrame, length: Column) -> int:
    """Powers of four up to the largest length: one row reaches the driver."""
    most = df.agg(F.max(length)).first()[0] or 0
    return max(0, (int(most).bit_length() + 1) // 2)


def _cover(a: str, b: str, levels: int) -> Column:
    """The largest dyadic cells (of 4 ** level positions) that make up the positions from ``a`` to ``b``: at most six a level.

    At each level the cells that lie inside, less those that make up whole cells of the level above that lie inside."""
    up = lambda l: f"shiftright({a} + shiftleft(1L, 2 * ({l})) - 1, 2 * ({l}))"
    down = lambda l: f"shiftright({b} + 1, 2 * ({l}))"
    cells = f"CASE WHEN {up('l')} < {down('l')} THEN sequence({up('l')}, {down('l')} - 1) ELSE array() END"
    above = f"l < {levels} AND {up('l + 1')} < {down('l + 1')}"
    own = f"CASE WHEN {above} THEN concat(CASE WHEN {up('l')} < 4 * {up('l + 1')} THEN sequence({up('l')}, 4 * {up('l + 1')} - 1) ELSE array() END, CASE WHEN 4 * {down('l + 1')} < {down('l')} THEN sequence(4 * {down('l + 1')}, {down('l')} - 1) ELSE array() END) ELSE {cells} END"
    return F.explode(F.expr(f"flatten(transform(sequence(0, {levels}), l -> transform({own}, c -> struct(l AS level, c AS cell))))"))


def _up(pos: str, levels: int) -> Column:
    """The cell of each level that holds a position."""
    return F.explode(F.expr(f"transform(sequence(0, {levels}), l -> struct(l AS level, shiftright({pos}, 2 * l) AS cell))"))


def greatest_crossing(places: DataFrame, refs: DataFrame, keys: list[str], *, longest: int | None = None) -> DataFrame:
    """Of each place, the greatest ``value`` of the references it crosses.

    They begin between ``lo`` and ``hi``, or begin before ``lo`` and reach it.  For the former a
    place asks the cells that make up its span for the greatest value that begins in each; for the
    latter, the cells around ``lo`` for the greatest value that has the cell among those it is made of.
    Cells are one row each before places meet them, so no join pairs rows of both tables."""
    if longest is None:
        top, deep = _levels(places, F.col("hi") - F.col("lo") + 1), _levels(refs, F.col("re") - F.col("rs") + 1)
    else:  # no place or reference is longer
        top = deep = (int(longest + 1).bit_length() + 1) // 2
    best = lambda d: d.select(*keys, "kind", "c.*", "value").groupBy(*keys, "kind", "level", "cell").agg(F.max("value").alias("value"))
    begins = best(refs.select(*keys, F.lit(0).alias("kind"), _up("rs", top).alias("c"), "value"))
    covers = best(refs.where("rs < re").select(*keys, F.lit(1).alias("kind"), _cover("(rs + 1)", "re", deep).alias("c"), "value"))
    span = places.where("lo <= hi").select(*keys, "start", "end", F.lit(0).alias("kind"), _cover("lo", "hi", top).alias("c"))
    point = places.select(*keys, "start", "end", F.lit(1).alias("kind"), _up("lo", deep).alias("c"))
    asked = span.unionByName(point).select(*keys, "start", "end", "kind", "c.*")
    return asked.join(begins.unionByName(covers), [*keys, "kind", "level", "cell"]).groupBy(*keys, "start", "end").agg(F.max("value").alias("cross_score"))


#: Cells of up to 4 ** this many positions, BIN, are one group of a running sum; longer ones are cut into ranges.
WHOLE_LEVELS = 8


def _inside(places: DataFrame, refs: DataFrame, keys: list[str]) -> DataFrame:
    """How many references begin after a place's start and end before its end, in parts to be summed by place.

    By the cells that make up the starts they may have, each with its own running count of ends.  Levels are rows before
    their cells are made, so that both are plain columns."""
    span = places.where("end - start > 1").select(*keys, "start", "end", (F.col("start") + 1).alias("from"), (F.col("end") - 1).alias("to"))
    top = _levels(span, F.col("to") - F.col("from") + 1)
    level = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level")
    up = lambda l: F.expr(f"shiftright(`from` + shiftleft(1L, 2 * ({l})) - 1, 2 * ({l}))")
    down = lambda l: F.expr(f"shiftright(`to` + 1, 2 * ({l}))")
    own = span.select("*", level).withColumns({"a": up("level"), "b": down("level"), "c": 4 * up("level + 1"), "d": 4 * down("level + 1")}).where("a < b")
    # at each level those that lie inside, less those that make up whole cells of the level above that lie inside
    run = lambda x, y: f"CASE WHEN {x} < {y} THEN sequence({x}, {y} - 1) ELSE array() END"
    made = F.expr(f"CASE WHEN level < {top} AND c < d THEN concat({run('a', 'c')}, {run('d', 'b')}) ELSE sequence(a, b - 1) END")
    cells = own.select(*keys, "start", "end", F.col("to").alias("pos"), "level", F.explode(made).alias("cell"))
    ended = refs.where(F.col("re") - F.col("rs") < (1 << 2 * top)).groupBy(*keys, "rs", "re").agg(F.count("*").alias("one"))
    ended = ended.select(*keys, F.col("re").alias("pos"), "one", "rs", level).select(*keys, "pos", "one", "level", F.expr("shiftright(rs, 2 * level)").alias("cell"))
    low = F.col("level") <= WHOLE_LEVELS
    u = cells.where(low).withColumn("asks", F.lit(True)).unionByName(ended.where(low), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys, "level", "cell").orderBy("pos", F.col("asks").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = u.withColumn("n", F.sum("one").over(so_far)).where("asks and n > 0").select(*keys, "start", "end", F.col("n").cast("double").alias("cross_score"))
    if top <= WHOLE_LEVELS:
        return found
    high = _read(cells.where(~low), [(F.col("pos"), 1)], ended.where(~low), [*keys, "level", "cell"], {"cross_score": F.col("one_run")})
    return found.unionByName(high.select(*keys, "start", "end", F.col("cross_score").cast("double").alias("cross_score")))


def nearest(places: DataFrame, refs: DataFrame, keys: list[str], *, center: bool = False, cap: float = 1e9) -> DataFrame:
    """Distance to the nearest reference, without pairing all: running extremes over one ordered union.

    Edge to edge it is 0 for touching or overlapping intervals; center to center it is
    between the rounded middles.  The order is cut into ranges: each range starts from the
    extremes of those before and after it, so a chromosome is not one task."""
    mid = lambda s, e: F.floor(F.col(s) + (F.col(e) - F.col(s)) / 2 + 0.5)
    places = places.withColumns({"qs": mid("start", "end") if center else F.col("start"), "qe": mid("start", "end") if center else F.col("end")})
    r = refs.select(*keys, (mid("rs", "re") if center else F.col("rs")).alias("a"), (mid("rs", "re") if center else F.col("re")).alias("b"))
    none = F.lit(None).cast("long")
    # below: the largest end of references that start at or before the query's end;
    # above: the smallest start of those that start after it.  Of the former, the largest end is the nearest.
    u = places.select(*keys, F.col("qe").alias("pos"), F.lit(1).alias("kind"), "start", "end", "qs", "qe", none.alias("a"), none.alias("b")).unionByName(
        r.select(*keys, F.col("a").alias("pos"), F.lit(0).alias("kind"), none.alias("start"), none.alias("end"), none.alias("qs"), none.alias("qe"), "a", "b")
    ).withColumn("bin", F.floor(F.col("pos") / BIN))
    bins = u.groupBy(*keys, "bin").agg(F.max("b").alias("top"), F.min("a").alias("low"))
    # frames that grow from the start, in either order: Spark computes any other anew for each row
    up, down = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys).orderBy(F.desc("bin"))
    earlier = (Window.unboundedPreceding, -1)
    bins = bins.select(*keys, "bin", F.max("top").over(up.rowsBetween(*earlier)).alias("top"), F.min("low").over(down.rowsBetween(*earlier)).alias("low"))
    up, down = Window.partitionBy(*keys, "bin").orderBy("pos", "kind"), Window.partitionBy(*keys, "bin").orderBy(F.desc("pos"), F.desc("kind"))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    below = F.greatest(F.max("b").over(up.rowsBetween(*so_far)), F.col("top"))
    above = F.least(F.min("a").over(down.rowsBetween(*so_far)), F.col("low"))
    found = u.join(bins, [*keys, "bin"]).withColumns({"below": below, "above": above}).where("kind = 1")
    before = F.when(F.col("below").isNotNull(), F.greatest(F.lit(0), F.col("qs") - F.col("below")))
    gap = F.least(before, F.col("above") - F.col("qe"), F.lit(int(cap)))
    has = F.col("below").isNotNull() | F.col("above").isNotNull()
    return found.select(*keys, "start", "end", F.when(has, gap.cast("double")).alias("cross_score"))


def outside(features: DataFrame, spans: DataFrame, *, stranded: bool = False, cell: int = 1 << 14) -> DataFrame:
    """Features that lie inside none of ``spans``: the containment anti-join."""
    key = strand_index(stranded)
    f = features.withColumn("key", key).withColumn("cell", F.floor(F.col("start") / cell))
    s = spans.select("chrom", key.alias("key"), F.col("start").alias("rs"), F.col("end").alias("re")).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("rs") / cell), F.floor(F.col("re") / cell)))
    )
    same = (f["chrom"] == s["chrom"]) & (f["key"] == s["key"]) & (f["cell"] == s["cell"])
    return f.join(s, same & (f["start"] >= s["rs"]) & (f["end"] <= s["re"]), "left_anti").drop("key", "cell")


def excluded_fraction(features: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Share of each feature that merged exclusions cover, as ``excluded``."""
    return crossing(features, exclusions, "FRACTION", touch=False).withColumnRenamed("cross_score", "excluded")


def probe_count(features: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes (points) in the closed span [start, end - 1] of each feature, as ``n_probes``."""
    places = features.select("chrom", "start", "end").distinct()
    changes = probes.select("chrom", F.col("start").alias("pos"), F.lit(1).cast("long").alias("n"))
    ends = [(F.col("end") - 1, 1), (F.col("start") - 1, -1)]
    count = _read(places.where("start < end"), ends, changes, ["chrom"], {"n_probes": F.col("sign") * F.col("n_run")})
    return features.join(count, ["chrom", "start", "end"], "left").withColumn("n_probes", F.coalesce("n_probes", F.lit(0).cast("long")))


def probe_gaps(probes: DataFrame, chroms: DataFrame, max_gap: int) -> DataFrame:
    """Stretches between successive probes (from 0, and to the end) of over ``max_gap``."""
    points = probes.select("chrom", F.col("start").alias("pos"))
    for edge in (F.lit(0).cast("long"), F.col("size")):
        points = points.unionByName(chroms.select("chrom", edge.alias("pos")))
    pairs = tiles(points, ["chrom"])
    return pairs.where(F.col("e") - F.col("s") > max_gap).select("chrom", F.col("s").alias("start"), F.col("e").alias("end"))
