"""Seeded random placement of features, enrichment by iteration, and hotspots.

Features are placed in rounds.  A feature's draws hang on the seed, the iteration, its own columns and
the number of the draw alone; in each round it takes its next draw that fits, and a scan within cells of
positions finds those draws of an iteration that meet: of them the one of the greatest keyed rank stays and the
others draw again.  So results do not depend on partitions, and no task holds an iteration.  Only where features
may cover a part of each other (``max_overlap`` between 0 and 1) does a place depend on all before it, and an
iteration's features are placed one by one.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.operators.intervals import BIN, collapse, in_regions, offset, region_counts
from spanloom.operators.joins import crossing, greatest_crossing, overlap_sums, probe_count
from spanloom.sources.folders import materialized, stored

PLACED = "iteration int, id string, chrom string, start long, end long, score double, strand string"


class Occupied:
    """Merged regions of one chromosome and strand, kept sorted."""

    def __init__(self, start: list[int] | None = None, end: list[int] | None = None) -> None:
        self.start: list[int] = start or []
        self.end: list[int] = end or []

    def near(self, s: int, e: int) -> range:
        """Regions that overlap [s, e)."""
        return range(bisect.bisect_right(self.end, s), bisect.bisect_left(self.start, e))

    def add(self, s: int, e: int) -> None:
        i, j = bisect.bisect_left(self.end, s), bisect.bisect_right(self.start, e)
        if i < j:
            s, e = min(s, self.start[i]), max(e, self.end[j - 1])
        self.start[i:j], self.end[i:j] = [s], [e]

    def blocks(self, s: int, e: int, most: float, both: bool) -> bool:
        """Whether more than ``most`` of [s, e) (with ``both``: or of a region it meets) is covered."""
        if most >= 1 or s >= e:
            return False
        total = 0
        for k in self.near(s, e):
            n = min(e, self.end[k]) - max(s, self.start[k])
            total += n
            if both and n > most * (self.end[k] - self.start[k]):
                return True
        return total / (e - s) > most


#: Draws from the whole genome before the free places are listed.
DRAWS = 2000


def _free_starts(length, names, sizes, excluded, taken, strand, stranded) -> list[tuple[int, int, int, str]]:
    """Runs of starts at which a feature of ``length`` meets nothing: chromosome number, first, how many, strand."""
    out = []
    for k, (chrom, size) in enumerate(zip(names, sizes)):
        for side in ("+", "-") if stranded else (strand,):
            full = Occupied()
            for own in (excluded.get(chrom), taken.get((chrom, side if stranded else "."))):
                for a, b in zip(own.start, own.end) if own else ():
                    full.add(a, b)
            for a, b in zip([0, *full.end], [*full.start, size]):
                if b - a >= length:
                    out.append((k, a, b - a - length + 1, side))
    return out


def _draw(runs: list[tuple[int, int, int, str]], rng) -> tuple[int, int, str]:
    """One of the starts of ``runs``, each as likely as the others."""
    end = np.cumsum([n for _, _, n, _ in runs])
    x = int(rng.integers(end[-1]))
    i = int(np.searchsorted(end, x, "right"))
    k, first, n, side = runs[i]
    return k, first + x - int(end[i] - n), side


def place(
    features: pd.DataFrame, iteration: int, chroms: list[tuple[str, int, int]], excluded: dict[str, Occupied], probes: dict[str, np.ndarray] | None,
    *, seed: int, stranded: bool, max_excluded: float, max_overlap: float, min_probes: int, max_attempts: int,
) -> pd.DataFrame:
    """Random places of one iteration's features, over the chromosomes laid end to end, copies included."""
    rng = np.random.default_rng([seed, iteration])
    names, sizes = zip(*[(c, size) for c, size, copies in chroms for _ in range(copies)])
    ends = np.cumsum(sizes)
    taken: dict[tuple[str, str], Occupied] = {}
    rows = []
    for f in features.sort_values(["chrom", "start", "end", "id"], kind="stable").itertuples(index=False):
        length = f.end - f.start
        exact = None
        for attempt in range(max_attempts):
            if attempt == DRAWS and not max_overlap and not max_excluded:
                # the genome is nearly full: from here on, draw among the places that are free
                exact = _free_starts(length, names, sizes, excluded, taken, f.strand, stranded)
            if exact:
                k, s, strand = _draw(exact, rng)
                chrom = names[k]
                e = s + length
            else:
                x = int(rng.integers(ends[-1]))
                k = int(np.searchsorted(ends, x, "right"))
                chrom, s = names[k], x - int(ends[k] - sizes[k])
                e = s + length
                strand = ("+", "-")[int(rng.integers(2))] if stranded else f.strand
            if e > sizes[k] or (chrom in excluded and excluded[chrom].blocks(s, e, max_excluded, False)):
                continue
            own = taken.setdefault((chrom, strand if stranded else "."), Occupied())
            if own.blocks(s, e, max_overlap, True):
                continue
            if probes is not None:
                p = probes.get(chrom, np.zeros(0))
                if np.searchsorted(p, e - 1, "right") - np.searchsorted(p, s, "left") < min_probes:
                    continue
            own.add(s, e)
            rows.append((iteration, f.id, chrom, s, e, f.score, strand))
            break
        else:
            raise ValueError(f"feature {f.id} found no place in {max_attempts} attempts")
    return pd.DataFrame(rows, columns=["iteration", "id", "chrom", "start", "end", "score", "strand"])


#: Draws of the first round for each feature; each round takes four times as many, as fewer features are left.
FIRST_DRAWS, MOST_DRAWS = 1, 4096
_FEATURE = ("id", "chrom", "start", "end", "score", "strand")


def keyed_number(*parts: Column | str) -> Column:
    """A whole number below 2 ** 60 that hangs on the parts, text or columns: fifteen hex digits of their MD5, as in any SQL."""
    text = F.concat_ws("|", *(F.lit(x) if isinstance(x, str) else F.coalesce(x.cast("string"), F.lit("")) for x in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def draws(features: DataFrame, chroms: list[tuple[str, int, int]], first: Column, n: int, *, seed: int, stranded: bool, unfit: bool = False) -> DataFrame:
    """``n`` draws of each feature from number ``first`` on, those that fit: adds ``draw, to_chrom, s, e, side``.

    A draw is a base of all chromosomes laid end to end, copies included, and must leave the feature's length behind it.
    With ``unfit`` the others stay, with a null ``to_chrom``."""
    parts, laid = [], 0
    for name, size, copies in chroms:
        for _ in range(copies):
            parts.append((name, laid, laid + size))
            laid += size
    if not laid:
        raise ValueError("the genome has no bases")
    # a draw's number is exploded with it, and so computed once: as a column it would be computed anew for each chromosome and use;
    # one draw, and few chromosomes, go without lambdas, which are not compiled
    own = lambda k: (str(seed), F.col("iteration"), F.col("own"), k)
    number = lambda k: F.struct(k.alias("draw"), (keyed_number(*own(k)) % laid).alias("x"))
    d = features.withColumn("try", F.explode(F.array(number(first)) if n == 1 else F.transform(F.sequence(first, first + (n - 1)), number)))
    d = d.withColumns({"draw": F.col("try.draw"), "x": F.col("try.x")}).drop("try")
    if len(parts) <= 64:
        for i, c in enumerate(("name", "low", "high")):
            held = F
            for part in parts:
                held = held.when(F.col("x") < part[2], F.lit(part[i]) if i == 0 else F.lit(part[i]).cast("long"))
            d = d.withColumn(f"on_{c}", held)
    else:
        ends = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")) for name, low, high in parts))
        d = d.withColumn("on", F.filter(ends, lambda c: (c["low"] <= F.col("x")) & (F.col("x") < c["high"]))[0])
        d = d.withColumns({f"on_{c}": F.col(f"on.{c}") for c in ("name", "low", "high")}).drop("on")
    side = F.when(keyed_number(*own(F.col("draw")), "strand") % 2 == 0, "+").otherwise("-") if stranded else F.col("strand")
    length = F.col("end") - F.col("start")
    fits = F.col("x") + length <= F.col("on_high")
    d = d if unfit else d.where(fits)
    s = F.col("x") - F.col("on_low")
    return d.withColumns({"to_chrom": F.when(fits, F.col("on_name")), "s": s, "e": s + length, "side": side}).drop("x", "on_name", "on_low", "on_high")


def _allowed(d: DataFrame, exclusions: DataFrame | None, probes: DataFrame | None, max_excluded: float, min_probes: int) -> DataFrame:
    """Draws of which no more than ``max_excluded`` lies in merged exclusions and that hold enough probes; both are read from running sums."""
    place = [F.col("to_chrom").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end")]
    back = lambda t: t.withColumnsRenamed({"chrom": "to_chrom", "start": "s", "end": "e"})
    if exclusions is not None and max_excluded < 1:
        merged = exclusions.select("chrom", F.col("start").alias("rs"), F.col("end").alias("re"))
        held = back(overlap_sums(d.where("s < e").select(*place).distinct(), merged, ["chrom"]))
        d = d.join(held, ["to_chrom", "s", "e"], "left").where(F.coalesce(F.col("overlap") / (F.col("e") - F.col("s")) <= max_excluded, F.lit(True))).drop("overlap")
    if probes is not None and min_probes > 0:
        d = d.join(back(probe_count(d.select(*place).distinct(), probes)), ["to_chrom", "s", "e"]).where(F.col("n_probes") >= min_probes).drop("n_probes")
    return d


def _longest(d: DataFrame) -> int:
    return max(1, d.agg(F.max(F.col("e") - F.col("s"))).first()[0] or 0)


def _in_cells(d: DataFrame, longest: int) -> DataFrame:
    """A row for each cell of BIN positions in which a row of up to ``longest`` bases may begin that shares a base with ``s`` to ``e``.

    So the cell of a row's own start knows all that it meets; other cells have copies."""
    first = F.least(F.col("s"), F.greatest(F.col("s") - (longest - 1), F.lit(0)))
    return d.withColumn("cell", F.explode(F.sequence(F.floor(first / BIN), F.floor(F.greatest(F.col("s"), F.col("e") - 1) / BIN))))


def _taken(cells: DataFrame, taken: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """``cells`` with ``taken``, whether they share a base with one of the rows ``s, e`` of ``taken``.

    In order of ends before starts, the rows of ``taken`` so far are those that begin before the end; one of them meets if its end is behind the start."""
    first, last = F.floor(F.greatest(F.col("s") - 2 * longest, F.lit(0)) / BIN), F.floor((F.col("e") + longest) / BIN)
    held = taken.where("s < e").select(*keys, F.col("s").alias("at"), F.col("e").alias("until"), F.explode(F.sequence(first, last)).alias("cell"))
    u = cells.withColumn("at", F.col("e")).unionByName(held.withColumn("other", F.lit(True)), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys, "cell").orderBy("at", F.col("other").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    met = (F.col("s") < F.col("e")) & F.coalesce(F.max("until").over(so_far) > F.col("s"), F.lit(False))
    return u.withColumn("taken", met).where("other is null").drop("at", "until", "other")


#: Up to this many cells of exclusions, with at most CHAIN in one, are broadcast to the draws, which then are not shuffled to meet them.
FEW_SHUT = 300_000


def _few(shut: DataFrame, longest: int) -> DataFrame | None:
    """The rows ``to_chrom, s, e`` in the cells of draws that they may meet, if they are few enough to be broadcast."""
    first, last = F.floor(F.greatest(F.col("s") - 2 * longest, F.lit(0)) / BIN), F.floor((F.col("e") + longest) / BIN)
    held = shut.where("s < e").select("to_chrom", F.col("s").alias("shut_s"), F.col("e").alias("shut_e"), F.explode(F.sequence(first, last)).alias("cell"))
    n = held.groupBy("to_chrom", "cell").agg(F.count("*").alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    return None if (n["all"] or 0) > FEW_SHUT or (n["most"] or 0) > CHAIN else held


def _by_few(d: DataFrame, few: DataFrame, how: str) -> DataFrame:
    """Draws that share a base with one of ``few`` (``left_semi``) or with none (``left_anti``)."""
    f = few.withColumnsRenamed({"to_chrom": "shut_on", "cell": "shut_cell"})
    same = (F.col("to_chrom") == F.col("shut_on")) & (F.floor(F.col("s") / BIN) == F.col("shut_cell"))
    return d.join(F.broadcast(f), same & (F.col("s") < F.col("e")) & (F.col("shut_s") < F.col("e")) & (F.col("s") < F.col("shut_e")), how)


def _free(d: DataFrame, placed: DataFrame, keys: list[str], longest: int | None = None) -> DataFrame:
    """Draws that share no base with ``placed``: each is one row, in the cell of its start."""
    cells = d.withColumn("cell", F.floor(F.col("s") / BIN))
    return _taken(cells, placed, keys, longest or _longest(d)).where("not taken").drop("cell", "taken")


def _chained(cells: DataFrame, keys: list[str], idle: Column | None = None) -> DataFrame:
    """Rows in cells with ``met``, whether they share a base with another of the cell, and the ``chain`` of those that do; ``idle`` ones do not count."""
    out = F.col("s") >= F.col("e") if idle is None else idle | (F.col("s") >= F.col("e"))
    w = Window.partitionBy(*keys, "cell", "idle").orderBy("s", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = cells.withColumn("idle", out).withColumns({"before": before, "after": F.lead("s").over(w)})
    opens = F.when(F.col("before") > F.col("s"), 0).otherwise(1)
    c = c.withColumn("chain", F.sum(opens).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    met = F.coalesce(F.col("before") > F.col("s"), F.lit(False)) | F.coalesce(F.col("after") < F.col("e"), F.lit(False))
    return c.withColumn("met", ~F.col("idle") & met).drop("before", "after", "idle")


def _meeting(d: DataFrame, keys: list[str]) -> DataFrame:
    """Draws that share a base with another, once each."""
    cells = _chained(_in_cells(d, _longest(d)), keys)
    return cells.where(F.col("met") & (F.col("cell") == F.floor(F.col("s") / BIN))).drop("cell", "chain", "met")


#: Chains of up to this many draws are compared pair by pair; longer ones by cells.
CHAIN = 64


def _beaten(met: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """``iteration, fid`` of draws that share a base with one of a greater rank."""
    by = [*keys, "cell", "chain"]
    sized = stored(met.select(*by, "s", "e", "rank", "fid", *({"iteration"} - set(by))).withColumn("size", F.count("*").over(Window.partitionBy(*by))))
    chains = sized.where(F.col("size") <= CHAIN).groupBy(*by).agg(F.collect_list(F.struct("s", "e", "rank", "fid")).alias("all"))
    worse = F.filter("all", lambda a: F.exists("all", lambda b: (a["s"] < b["e"]) & (b["s"] < a["e"]) & (a["rank"] < b["rank"])))
    own = F.floor(F.col("a.s") / BIN) == F.col("cell")
    out = chains.select("iteration", "cell", F.explode(worse).alias("a")).where(own).select("iteration", "a.fid")
    long = sized.where(F.col("size") > CHAIN)
    if long.isEmpty():
        return out
    # greatest_crossing has cells of its own
    long, by = long.withColumnRenamed("cell", "home"), ["home" if k == "cell" else k for k in by]
    places = long.select(*by, F.col("s").alias("start"), F.col("e").alias("end")).distinct().withColumns({"lo": F.col("start") + 1, "hi": F.col("end") - 1})
    refs = long.select(*by, F.col("s").alias("rs"), F.col("e").alias("re"), F.col("rank").alias("value"))
    best = greatest_crossing(places, refs, by, longest=longest).withColumnsRenamed({"start": "s", "end": "e"})
    beaten = long.where(F.col("home") == F.floor(F.col("s") / BIN)).join(best, [*by, "s", "e"]).where("cross_score > rank")
    return out.unionByName(beaten.select("iteration", "fid"))


#: Draws whose cells are broadcast to the places that they may meet.
FEW_DRAWS = 300_000


def _told_apart(actual: DataFrame, *more: str) -> DataFrame:
    """Features with ``own``, the text on which their draws hang: equal rows are told apart by a number, and counted before they are."""
    each = actual.groupBy(*_FEATURE, *more).agg(F.count("*").alias("copies")).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _FEATURE if c != "score"), F.col("nth").cast("string"), F.when(F.col("nth") > 1, F.col("score").cast("string")))
    return each.select(*_FEATURE, *more, text.alias("own"))


def _spread(each: DataFrame) -> DataFrame:
    """Features with a number ``fid``: few make many draws, so they are spread over all tasks before they do."""
    tasks = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(each.repartition(tasks, "own").withColumn("fid", F.monotonically_increasing_id()))


def _place_in_rounds(
    each: DataFrame, iterations: int, chroms: list[tuple[str, int, int]], exclusions: DataFrame | None, probes: DataFrame | None,
    *, seed: int, stranded: bool, max_excluded: float, apart: bool, min_probes: int, max_attempts: int, scored: bool, named: bool = True,
) -> DataFrame:
    """Places of the features ``each`` in all iterations; with ``apart`` none of an iteration (and strand) meet.  Scores go along if ``scored``, ids if ``named``.

    Features with a ``fid`` are taken as they are (``_spread``).  The first round makes one draw a feature and iteration, and shuffles it once, to the cells where it meets exclusions and other draws; what
    is written of it has those without a place marked, so no later round reads all features again."""
    each = each if scored else each.drop("score")
    each = each if "fid" in each.columns else _spread(each)
    longest = max(1, each.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0)
    strict, few = exclusions is not None and max_excluded <= 0, None
    if strict:
        shut = stored(exclusions.select(F.col("chrom").alias("to_chrom"), F.col("start").alias("s"), F.col("end").alias("e")).distinct())
        few = None if apart else _few(shut, longest)
    elif exclusions is not None:
        exclusions = materialized(collapse(exclusions, names=False))
    partial = None if strict else exclusions
    judged = (partial is not None and max_excluded < 1) or (probes is not None and min_probes > 0)
    keys = ["iteration", "to_chrom", *(["side"] if stranded else [])]
    own = ["iteration", "fid", *(["rank"] if apart else []), *(["id"] if named else []), *(["score"] if scored else []), "draw", "to_chrom", "s", "e", "side"]
    at_home = F.col("cell") == F.floor(F.col("s") / BIN)
    left = each.withColumn("iteration", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))))
    placed, tried, n, count = None, 0, FIRST_DRAWS, None
    while count != 0:
        if tried >= max_attempts:
            lost = left.agg(F.min("id").alias("id")).first()["id"]
            raise ValueError(f"feature {lost} found no place in {max_attempts} attempts")
        n = min(n, max_attempts - tried)
        # one draw each, judged by place alone: those that fail are kept, and marked
        single = n == 1 and placed is None and not judged
        ranked = left.withColumn("rank", keyed_number(str(seed), F.col("iteration"), F.col("own"), "rank")) if apart else left
        d = draws(ranked, chroms, F.lit(tried), n, seed=seed, stranded=stranded, unfit=single).select(*own)
        if single:
            # draws that do not fit have no place to meet at
            unfit = F.col("to_chrom").isNull()
            d = d.withColumns({"s": F.when(unfit, F.col("fid") % 4096 * BIN).otherwise(F.col("s")), "e": F.when(unfit, F.col("fid") % 4096 * BIN).otherwise(F.col("e"))})
            c = _in_cells(d, longest) if apart else d.withColumn("cell", F.floor(F.col("s") / BIN))
            c = _taken(c, shut, ["to_chrom"], longest) if strict and few is None else c.withColumn("taken", F.lit(False))
            c = c.withColumn("taken", F.col("taken") | F.col("to_chrom").isNull())
        else:
            if judged:
                d = _allowed(materialized(d), partial, probes, max_excluded, min_probes)
            if strict and few is not None:
                d = _by_few(d, few, "left_anti")
            elif strict:
                d = _free(d, shut, ["to_chrom"], longest)
            if apart and placed is not None:
                known = placed.select(*keys, "s", "e")
                if count * n <= FEW_DRAWS:
                    d = stored(d)
                    near = d.select(*keys, F.explode(F.sequence(F.floor(F.greatest(F.col("s") - longest, F.lit(0)) / BIN), F.floor((F.col("e") + longest) / BIN))).alias("cell")).distinct()
                    known = known.withColumn("cell", F.floor(F.col("s") / BIN)).join(F.broadcast(near), [*keys, "cell"], "left_semi").drop("cell")
                d = _free(d, known, keys, longest)
            shape = F.struct("draw", *(x for x in own if x not in ("iteration", "fid", "draw")))
            d = d.groupBy("iteration", "fid").agg(F.min(shape).alias("d")).select("iteration", "fid", "d.*").select(*own)
            c = (_in_cells(d, longest) if apart else d.withColumn("cell", F.floor(F.col("s") / BIN))).withColumn("taken", F.lit(False))
        if apart:
            table = _chained(c, keys, F.col("taken"))
            table = stored(table.where(F.col("met") | at_home))
            # what is settled is read where places are asked for; the few others are read apart from it
            open_ = stored(table.where(F.col("met") | F.col("taken")))
            met = open_.where("met")
            beaten = stored(_beaten(met, keys, longest))
            good = table.where(~F.col("met") & ~F.col("taken")).select(*own)
            good = good.unionByName(met.where(at_home).join(beaten, ["iteration", "fid"], "left_anti").select(*own))
        else:
            table = stored(c)
            good = table.where("not taken").select(*own)
            beaten = None
        if single:
            lost = (open_ if apart else table).where(F.col("taken") & at_home).select("iteration", "fid")
            if few is not None:
                lost = lost.unionByName(_by_few(good, few, "left_semi").select("iteration", "fid"))
                good = _by_few(good, few, "left_anti")
            lost = lost if beaten is None else lost.unionByName(beaten)
            left = lost.join(each, "fid")
        else:
            left = left.join(good.select("iteration", "fid"), ["iteration", "fid"], "left_anti")
        placed = good if placed is None else placed.unionByName(good)
        left = stored(left)
        count = left.count()
        tried, n = tried + n, min(4 * n, MOST_DRAWS)
    score = F.col("score") if scored else F.lit(None).cast("double").alias("score")
    return placed.select("iteration", F.col("id") if named else F.lit(None).cast("string").alias("id"), F.col("to_chrom").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end"), score, F.col("side").alias("strand"))


def permute(
    features: DataFrame, chroms: DataFrame, *, iterations: int = 100, seed: int = 1, exclusions: DataFrame | None = None,
    probes: DataFrame | None = None, stranded: bool = False, max_excluded: float = 0.0, max_overlap: float = 0.0, min_probes: int = 0,
    offset_control: int | None = None, max_attempts: int = 100_000, scored: bool = True, named: bool = True,
) -> DataFrame:
    """Actual features (iteration -1), an optional shifted control (-2), and random placements (0, 1, ...).

    Chromosomes are gathered once and sent to the tasks.  A feature that finds no place in ``max_attempts`` draws is
    an error.  With a ``max_overlap`` of 0 no two features of an iteration (with ``stranded``: and strand) meet, with 1 all may.
    Without ``scored``, placements are the same and may have null scores, without ``named`` null ids.  Features that ``_spread``
    has numbered are placed as they are."""
    actual = features.select(F.col("id").cast("string"), "chrom", "start", "end", F.col("score").cast("double"), "strand")
    sizes = [(r["chrom"], r["size"], r["copies"] if "copies" in r else 1) for r in chroms.orderBy("chrom").collect()]
    if 0 < max_overlap < 1:
        placed = _place_in_turn(
            actual, sizes, exclusions, probes, iterations=iterations, seed=seed, stranded=stranded, max_excluded=max_excluded,
            max_overlap=max_overlap, min_probes=min_probes, max_attempts=max_attempts,
        )
    else:
        if iterations:
            placed = _place_in_rounds(
                features if "fid" in features.columns else _told_apart(actual), iterations, sizes, exclusions, probes, seed=seed, stranded=stranded, max_excluded=max_excluded, apart=max_overlap <= 0,
                min_probes=min_probes, max_attempts=max_attempts, scored=scored, named=named,
            )
        else:
            placed = actual.limit(0).select(F.lit(0).alias("iteration"), *actual.columns)
    out = actual.select(F.lit(-1).alias("iteration"), *actual.columns).unionByName(placed)
    if offset_control is not None:
        out = offset(actual, offset_control).select(F.lit(-2).alias("iteration"), *actual.columns).unionByName(out)
    return out


def _place_in_turn(
    actual: DataFrame, sizes: list[tuple[str, int, int]], exclusions: DataFrame | None, probes: DataFrame | None, *, iterations: int, **how
) -> DataFrame:
    """Places one by one, an iteration a group: for features that may cover a part of each other."""
    marks, own = None, [F.col(c).alias(f"mark_{c}") for c in ("chrom", "start", "end")]
    if exclusions is not None:
        marks = collapse(exclusions, names=False).select(F.lit("x").alias("kind"), *own)
    if probes is not None:
        points = probes.withColumn("end", F.col("start")).select(F.lit("p").alias("kind"), *own)
        marks = points if marks is None else marks.unionByName(points)
    probed = probes is not None

    def plain(key, pdf):
        return place(pdf, int(key[0]), sizes, {}, None, **how)

    def marked(key, pdf, own):
        if pdf.empty:
            return pdf[["iteration", "id", "chrom", "start", "end", "score", "strand"]]
        own = own.sort_values("mark_start")
        known = {c: Occupied(x["mark_start"].tolist(), x["mark_end"].tolist()) for c, x in own[own["kind"] == "x"].groupby("mark_chrom")}
        at = {c: x["mark_start"].to_numpy() for c, x in own[own["kind"] == "p"].groupby("mark_chrom")}
        return place(pdf, int(key[0]), sizes, known, at if probed else None, **how)

    numbers = F.explode(F.sequence(F.lit(0), F.lit(iterations - 1)))
    random = actual.withColumn("iteration", numbers) if iterations else actual.withColumn("iteration", F.lit(0)).limit(0)
    if marks is None:
        return random.groupBy("iteration").applyInPandas(plain, PLACED)
    marks = marks.withColumn("mark_iteration", numbers) if iterations else marks.withColumn("mark_iteration", F.lit(0)).limit(0)
    return random.groupBy("iteration").cogroup(marks.groupBy("mark_iteration")).applyInPandas(marked, PLACED)


def rules_kept(placed: DataFrame, chroms: DataFrame, exclusions: DataFrame) -> DataFrame:
    """How many placements of each iteration lie inside a chromosome, share no base with ``exclusions``, and none with each other:
    ``iteration, inside, clear, apart``.  A placement is shuffled once, to its cells."""
    d = placed.select("iteration", F.col("chrom").alias("to_chrom"), F.col("start").alias("s"), F.col("end").alias("e"))
    shut = exclusions.select(F.col("chrom").alias("to_chrom"), F.col("start").alias("s"), F.col("end").alias("e")).distinct()
    longest = _longest(d)
    cells = _chained(_taken(_in_cells(d, longest), shut, ["to_chrom"], longest), ["iteration", "to_chrom"])
    home = cells.where(F.col("cell") == F.floor(F.col("s") / BIN)).join(F.broadcast(chroms.select(F.col("chrom").alias("to_chrom"), "size")), "to_chrom", "left")
    inside = F.coalesce((F.col("s") >= 0) & (F.col("e") <= F.col("size")), F.lit(False))
    return home.groupBy("iteration").agg(F.count_if(inside).alias("inside"), F.count_if(~F.col("taken")).alias("clear"), F.count_if(~F.col("met")).alias("apart"))


def collapsed(placed: DataFrame, *, padding: int = 0, unpadded: bool = False, stranded: bool = False) -> DataFrame:
    """The regions of each iteration's placements, with how many features each holds as score: ``iteration, chrom, start, end, name, score, strand``.

    Padding is added before merging and, with ``unpadded``, taken off the regions again."""
    named = placed.select(F.concat_ws("|", F.col("iteration").cast("string"), "chrom").alias("chrom"), "start", "end", F.col("id").alias("name"), "score", "strand")
    merged = collapse(named, padding=padding, unpadded=unpadded, stranded=stranded)
    key = F.split("chrom", r"\|", 2)
    return merged.select(key[0].cast("int").alias("iteration"), key[1].alias("chrom"), "start", "end", "name", F.col("n").cast("double").alias("score"), "strand")


def simulate(features: DataFrame, chroms: DataFrame, refs: DataFrame, *, score_type: str = "COUNT", **how) -> DataFrame:
    """Scores of actual and random placements: ``id, iteration, score``.  One plan: place, then cross."""
    named = features.withColumn("score", F.coalesce("score", F.lit(0.0)))
    placed = permute(named, chroms, scored=False, **how).select("iteration", "id", "chrom", "start", "end")
    return crossing(placed, refs, score_type).select("id", "iteration", F.col("cross_score").alias("score"))


def hotspot(
    features: DataFrame, chroms: DataFrame, *, iterations: int = 100, seed: int = 1, exclusions: DataFrame | None = None, rounds: int | None = None, **how
) -> DataFrame:
    """Largest clusters of overlapping features, round after round, against random placements.

    A row per round: features left, the size of the largest clusters, how many there are,
    features in them, and for j = 1 .. that many the share of iterations whose clusters of at
    least that size hold at least j times as many.  The clusters' features then go, and their
    spans are excluded, until no cluster is left or after ``rounds``, if given.  What goes are
    whole clusters that meet no other, so the clusters are found once, and a round has those up to its size.
    The driver sees the sizes that occur and counts of a round's iterations; clusters and features stay in Spark."""
    spark = features.sparkSession
    actual = features.select(F.col("id").cast("string"), "chrom", "start", "end", F.col("score").cast("double"), "strand")
    members, clusters = in_regions(actual)
    clusters = stored(clusters)
    sizes = sorted(((int(r["n"]), int(r["k"])) for r in clusters.groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True)
    sizes = sizes if rounds is None else sizes[:rounds]
    each = _spread(_told_apart(members, "n")) if iterations and sizes else None
    longest = max(1, actual.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0)
    total, rows = clusters.agg(F.sum("n")).first()[0], []
    for number, (most, k) in enumerate(sizes):
        reach = []
        if iterations:
            gone = clusters.where(F.col("n") > most).select("chrom", "start", "end") if number else None
            given = None if exclusions is None else exclusions.select("chrom", "start", "end")
            shut = gone if given is None else given if gone is None else given.unionByName(gone)
            sims = permute(
                each.where(F.col("n") <= most).drop("n"), chroms, iterations=iterations, seed=seed + number, exclusions=shut, max_overlap=1.0, scored=False, named=False, **how
            ).where("iteration >= 0")
            # of regions of one feature or more, none is left out, so they need not be told apart
            regions = region_counts(sims, ["iteration", "chrom"], least=most, longest=longest) if most > 1 else sims.select("iteration", F.lit(1).alias("n"))
            held = regions.groupBy("iteration").agg(F.sum("n").alias("held"))
            # how many iterations hold j times as many, for the j that occur
            reach = held.groupBy(F.floor(F.col("held") / most).alias("j")).agg(F.count("*").alias("n")).collect()
        # the share falls in steps: from above one j that occurs up to the next it is the same
        steps, before = [], 0
        for j in sorted(int(r["j"]) for r in reach):
            steps.append((min(j, k) - before, sum(int(r["n"]) for r in reach if r["j"] >= j) / iterations))
            before = min(j, k)
        rows.append((number, total, most, k, most * k, [*steps, (k - before, 0.0)]))
        total -= most * k
    out = spark.createDataFrame(rows, "round int, n_features long, cluster_size long, n_clusters int, n_clustered long, steps array<struct<k: int, share: double>>")
    return out.withColumn("share", F.flatten(F.transform("steps", lambda x: F.array_repeat(x["share"], x["k"])))).drop("steps")
