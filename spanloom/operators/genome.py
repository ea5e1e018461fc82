"""Genome tables, sequences and annotation."""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanloom.operators.intervals import collapse, cumulative, split, with_previous
from spanloom.sources.folders import materialized


def upper_bases(seq: str | Column) -> Column:
    """Upper case of the ASCII letters; other characters, if any, keep their length."""
    return F.translate(seq, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def map_columns(table: DataFrame, *, chrom: int, start: int, end: int, name: int | None = None, score: int | None = None, strand: int | None = None) -> DataFrame:
    """BED columns of a table by their places from 1; defaults are ``*``, 0 and +."""
    c = lambda i: F.col(f"`{table.columns[i - 1]}`")
    take = lambda i, d: F.coalesce(c(i).cast("string"), F.lit(d)) if i else F.lit(d)
    return table.select(
        c(chrom).cast("string").alias("chrom"), c(start).cast("long").alias("start"), c(end).cast("long").alias("end"),
        take(name, "*").alias("name"), take(score, "0").cast("double").alias("score"), take(strand, "+").alias("strand"),
    )


def gap_features(gaps: DataFrame) -> DataFrame:
    """BED rows of a gap table (chrom, chromStart, chromEnd, size, type)."""
    return gaps.select("chrom", F.col("chromStart").alias("start"), F.col("chromEnd").alias("end"), F.col("type").alias("name"), F.col("size").cast("double").alias("score"), F.lit("+").alias("strand"))


def main_chroms(chroms: DataFrame) -> DataFrame:
    """Without chrM and names that hold an underscore."""
    return chroms.where("chrom like 'chr%' and chrom != 'chrM' and not contains(chrom, '_')")


def ignore_chroms(df: DataFrame, spec: str | None, *, suffixes: bool = False) -> DataFrame:
    """Without the chromosomes of ``spec``, names parted by commas or blanks; with ``suffixes`` also names that end in one of them."""
    names = [n for n in re.split(r"[\s,]+", spec or "") if n]
    gone = F.col("chrom").isin(names)
    for n in names if suffixes else ():
        gone = gone | F.col("chrom").endswith(n)
    return df.where(~gone) if names else df


def canonical_sizes(chroms: DataFrame, least: int = 1) -> DataFrame:
    """Main chromosomes of at least ``least`` bases."""
    return main_chroms(chroms).where(F.col("size") >= least)


def genome_stats(chroms: DataFrame, transcripts: DataFrame | None = None) -> DataFrame:
    """``n_chromosomes, n_bases`` and, of ``transcripts``, ``n_transcripts, n_genes, transcript_bases``."""
    out = chroms.agg(F.count("*").alias("n_chromosomes"), F.sum("size").alias("n_bases"))
    if transcripts is None:
        return out
    t = transcripts.agg(
        F.count("*").alias("n_transcripts"), F.countDistinct("gene").alias("n_genes"), F.sum(F.col("txEnd") - F.col("txStart")).alias("transcript_bases")
    )
    return out.crossJoin(t)  # one row each


def transcript_name(t: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """Transcripts as BED rows whose name holds tags: ``transcript:..;gene:..``.  ``symbols`` (name, symbol) is joined by id."""
    if symbols is None:
        gene = F.coalesce(F.nullif("name2", F.lit("")), "name")
    else:
        t = t.join(symbols.select("name", "symbol"), "name", "left")
        gene = F.coalesce(F.nullif("symbol", F.lit("")), F.nullif("name2", F.lit("")), "name")
    name = F.concat_ws(";", F.concat(F.lit("transcript:"), "name"), F.concat(F.lit("gene:"), gene))
    return t.select("chrom", F.col("txStart").alias("start"), F.col("txEnd").alias("end"), name.alias("name"), F.lit(0.0).alias("score"), "strand", gene.alias("gene"))


def genes(transcripts: DataFrame) -> DataFrame:
    """Span of each gene by chromosome and strand."""
    return transcripts.groupBy("gene", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(
        "chrom", "start", "end", F.col("gene").alias("name"), F.lit(0.0).alias("score"), "strand"
    )


def motif_length(motif: str) -> int:
    """Length of a motif in which an alternation counts as one base."""
    return len(re.sub(r"\([^)]*\)", "N", motif))


def motif_bins(sequences: DataFrame, motif: str, bin_size: int = 1000) -> DataFrame:
    """Share of non-overlapping matches by bin, four decimals: ``chrom, start, end, score``.

    A bin's text begins with the last L - 1 bases of the bin before, so that matches across
    the border count; the last bin keeps its nominal width."""
    carry = motif_length(motif) - 1
    # the sequence is cut once; what is exploded is a bin's text alone
    cuts = F.regexp_extract_all(upper_bases("seq"), F.lit(f"(?s).{{1,{bin_size}}}"), F.lit(0))
    text = F.transform("cuts", lambda x, i: F.concat(F.when(i > 0, F.right(F.get("cuts", i - 1), F.lit(carry))).otherwise(""), x))
    bins = sequences.where("length(seq) > 0").select("chrom", cuts.alias("cuts")).select("chrom", F.posexplode(text).alias("bin", "text"))
    start = F.col("bin") * bin_size
    value = F.floor(F.regexp_count("text", F.lit(motif)) / bin_size * 10000 + 0.5) / 10000
    return bins.select("chrom", start.cast("long").alias("start"), (start + bin_size).cast("long").alias("end"), value.alias("score"))


def split_sequences(sequences: DataFrame, site: str) -> DataFrame:
    """Fragments of each sequence, cut after each match of ``site`` on either strand: ``chrom, start, end, strand, seq``.

    N in the site is any base.  A fragment is + if it ends in the forward pattern's text, else -."""
    forward = site.upper()
    back = forward.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    pattern = "(?:" + "|".join(p.replace("N", ".") for p in dict.fromkeys((forward, back))) + ")"
    # pieces end with a match, or are what is left
    piece = F.regexp_extract_all("seq", F.lit(f"((?s).*?{pattern}|.+$)"), F.lit(1))
    rows = sequences.select("chrom", F.monotonically_increasing_id().alias("row"), piece.alias("all")).select("chrom", "row", F.posexplode("all").alias("at", "seq"))
    # a sequence's pieces are as many rows as it had bases at most, and their starts one running sum
    length = F.length("seq").cast("long")
    start = F.sum(length).over(Window.partitionBy("chrom", "row").orderBy("at")) - length
    out = rows.withColumn("start", start)
    plus = F.col("seq").endswith(forward.replace("N", "."))
    return out.select("chrom", "start", (F.col("start") + F.length("seq")).alias("end"), F.when(plus, "+").otherwise("-").alias("strand"), "seq")


def split_histogram(fragments: DataFrame) -> DataFrame:
    """Fragment lengths in bins of a hundredth of their spread (1 at least): ``length, n``."""
    n = fragments.select((F.col("end") - F.col("start")).alias("v"))
    step = n.agg(F.greatest(F.lit(1), F.floor((F.max("v") - F.min("v")) / 100 + 0.5)).alias("step"))
    return n.crossJoin(F.broadcast(step)).groupBy((F.floor(F.col("v") / F.col("step") + 0.5) * F.col("step")).alias("length")).agg(F.count("*").alias("n"))


def edit_sequence(seq: str, changes: list[tuple[str, str, str, str]]) -> str:
    """Apply replacements to one sequence.

    (kind, left, right, text): by COORDINATES, the text stands between base ``left`` (the
    last before, from 1) and base ``right`` (the first after), applied from right to left;
    by FLANKS, between the first ``left`` and the ``right`` that follows it."""
    seq = seq.upper()
    spots = sorted((c for c in changes if c[0] == "COORDINATES"), key=lambda c: -int(c[1]))
    for _, left, right, text in spots:
        seq = seq[: int(left)] + text.upper() + seq[int(right) - 1 :]
    for kind, left, right, text in changes:
        if kind == "FLANKS":
            left, right = left.upper(), right.upper()
            i = seq.find(left)
            j = seq.find(right, i + len(left)) if i >= 0 else -1
            if j >= 0:
                seq = seq[: i + len(left)] + text.upper() + seq[j:]
    return seq


def build_sequences(sequences: DataFrame, changes: DataFrame) -> DataFrame:
    """Edited sequences; ``changes`` has ``chrom, kind, left, right, text``.  A chromosome is one row, as in the input."""
    own = changes.groupBy("chrom").agg(F.sort_array(F.collect_list(F.struct("kind", "left", "right", "text"))).alias("changes"))

    def edit(batches):
        for pdf in batches:
            done = [edit_sequence(s, [tuple(c[k] for k in ("kind", "left", "right", "text")) for c in (ch if ch is not None else [])]) for s, ch in zip(pdf["seq"], pdf["changes"])]
            yield pd.DataFrame({"chrom": pdf["chrom"], "seq": done})

    return sequences.join(own, "chrom", "left").mapInPandas(edit, "chrom string, seq string")


def in_pieces(chunks: DataFrame, piece: int) -> DataFrame:
    """Stretches ``chrom, start, seq`` that follow each other, cut and joined to pieces of ``piece`` bases; the last is what is left."""
    length = F.length("seq")
    cuts = F.sequence(F.floor(F.col("start") / piece), F.floor((F.col("start") + length - 1) / piece))
    cut = chunks.where(length > 0).withColumn("k", F.explode(cuts))
    low = F.greatest(F.col("start"), F.col("k") * piece)
    text = F.substr("seq", (low - F.col("start") + 1).cast("int"), (F.least(F.col("start") + length, (F.col("k") + 1) * piece) - low).cast("int"))
    whole = cut.select("chrom", "k", low.alias("low"), text.alias("text")).groupBy("chrom", "k").agg(F.sort_array(F.collect_list(F.struct("low", "text"))).alias("t"))
    return whole.select("chrom", (F.col("k") * piece).cast("long").alias("start"), F.array_join("t.text", "").alias("seq"))


def _replaced(pieces: DataFrame, spots: DataFrame, piece: int) -> DataFrame:
    """Pieces in which the stretches ``chrom, a, b`` (half-open, without overlap) have become ``text``.

    What is kept between the stretches moves by what those before it add; pieces are cut where a kept stretch ends, and never joined to a
    chromosome."""
    held = with_previous(spots, ["chrom"], "a", ["b"])
    torn = (F.col("b") < F.col("a")) | (F.col("previous.b") > F.col("a"))
    held = held.withColumn("grow", F.when(torn, F.raise_error(F.lit("changes overlap")).cast("long")).otherwise(F.length("text") - (F.col("b") - F.col("a"))))
    held = cumulative(held, ["chrom"], "a", "grow", "moved")
    before = F.col("moved") - F.col("grow")
    kept = held.select("chrom", F.coalesce("previous.b", F.lit(0).cast("long")).alias("low"), F.col("a").alias("high"), before.alias("by"))
    size = pieces.groupBy("chrom").agg(F.max(F.col("start") + F.length("seq")).alias("high"))
    last = held.groupBy("chrom").agg(F.max(F.struct("b", "moved")).alias("m"))
    tail = size.join(last, "chrom", "left").select("chrom", F.coalesce("m.b", F.lit(0).cast("long")).alias("low"), "high", F.coalesce("m.moved", F.lit(0).cast("long")).alias("by"))
    kept = kept.unionByName(tail).where("low < high")
    kept = kept.withColumn("at", F.explode(F.sequence(F.floor(F.col("low") / piece), F.floor((F.col("high") - 1) / piece)))).withColumn("start", F.col("at") * piece)
    low, high = F.greatest("low", "start"), F.least(F.col("high"), F.col("start") + F.length("seq"))
    part = pieces.join(kept, ["chrom", "start"]).select("chrom", (low + F.col("by")).alias("start"), F.substr("seq", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("seq"))
    new = held.select("chrom", (F.col("a") + before).alias("start"), F.col("text").alias("seq"))
    return in_pieces(part.unionByName(new), piece)


#: Bases of the pieces that sequences are changed in: a row of a short piece costs more than its bases.
WORK_BASES = 4096


def build_pieces(pieces: DataFrame, changes: DataFrame, piece: int, *, work: int | None = None) -> DataFrame:
    """``build_sequences`` over sequences in pieces (``chrom, start, seq``, each of ``piece`` bases but the last).

    COORDINATES that overlap are an error.  A chromosome's FLANKS are applied one after the other, in order of their texts, to what
    those before have made, all chromosomes at a time; flanks are found across the borders of pieces.  No task holds a chromosome.  The pieces that are changed have ``work`` bases (a
    few thousand), and are cut to ``piece`` at the end."""
    work = work or piece * max(1, WORK_BASES // piece)
    held = in_pieces(pieces.select("chrom", "start", upper_bases("seq").alias("seq")), work)
    spots = changes.where("kind = 'COORDINATES'").select("chrom", F.col("left").cast("long").alias("a"), (F.col("right").cast("long") - 1).alias("b"), upper_bases("text").alias("text"))
    out = materialized(_replaced(held, spots, work))
    nth = F.row_number().over(Window.partitionBy("chrom").orderBy("left", "right", "text"))
    flanks = changes.where("kind = 'FLANKS'").select("chrom", *(upper_bases(c).alias(c) for c in ("left", "right", "text")), nth.alias("nth"))
    for k in range(1, (flanks.agg(F.max("nth")).first()[0] or 0) + 1):
        own = flanks.where(F.col("nth") == k)
        wanted = own.select("chrom", F.explode(F.array(F.struct(F.lit("l").alias("name"), F.col("left").alias("text")), F.struct(F.lit("r").alias("name"), F.col("right").alias("text")))).alias("w")).select("chrom", "w.*")
        found = materialized(places_in_pieces(out, wanted, work))
        first = found.where("name = 'l'").groupBy("chrom").agg(F.min(F.col("start") + F.length("text")).alias("a"))
        second = found.where("name = 'r'").join(first, "chrom").where("start >= a").groupBy("chrom", "a").agg(F.min("start").alias("b"))
        out = materialized(_replaced(out, second.join(own.select("chrom", "text"), "chrom"), work))
    return in_pieces(out, piece)


def lift_over(points: DataFrame, changes: DataFrame) -> DataFrame:
    """New positions after COORDINATES replacements (``chrom, last_before, first_after, inserted``): adds ``lifted``.

    From ``first_after`` on, positions shift by what the replacement adds; positions inside a
    replaced span are -1; others stay.  Changes are few per chromosome and do not overlap, so
    they come along as one sorted array."""
    own = changes.groupBy("chrom").agg(F.collect_list(F.struct("last_before", "first_after", "inserted")).alias("changes"))
    p = points.join(own, "chrom", "left")  # broadcast only below Spark's limit of size
    shift = F.aggregate(
        F.coalesce("changes", F.array().cast("array<struct<last_before:bigint,first_after:bigint,inserted:bigint>>")), F.lit(0).cast("long"),
        lambda a, c: a + F.when(F.col("pos") >= c["first_after"], c["inserted"] - (c["first_after"] - c["last_before"] - 1)).otherwise(0),
    )
    gone = F.coalesce(F.exists("changes", lambda c: (F.col("pos") > c["last_before"] + c["inserted"]) & (F.col("pos") < c["first_after"])), F.lit(False))
    return p.select(*points.columns, F.when(gone, F.lit(-1).cast("long")).otherwise(F.col("pos") + shift).alias("lifted"))


def find_features(sequences: DataFrame, wanted: DataFrame) -> DataFrame:
    """Places of exact sequences (``name, chrom, text``), not overlapping: BED rows."""
    hit = F.split(upper_bases("seq"), F.concat(F.lit(r"\Q"), upper_bases("text"), F.lit(r"\E")), -1)
    own = sequences.withColumn("row", F.monotonically_increasing_id())
    rows = own.join(wanted, "chrom").select("chrom", "row", "name", "text", F.length("text").alias("len"), hit.alias("parts")).where("size(parts) > 1")
    rows = rows.select("chrom", "row", "name", "text", "len", F.size("parts").alias("n"), F.posexplode(F.transform("parts", F.length)).alias("at", "part"))
    w = Window.partitionBy("chrom", "row", "name", "text").orderBy("at")
    rows = rows.withColumn("before", F.sum(F.col("part").cast("long")).over(w)).where("at < n - 1")
    start = F.col("before") + F.col("at") * F.col("len")
    return rows.select("chrom", start.alias("start"), (start + F.col("len")).alias("end"), "name", F.lit(0.0).alias("score"), F.lit("+").alias("strand"))


#: Letters of distinct texts that ride along in each task as one automaton (about 100 bytes each); beyond, texts meet the places of
#: their first letters by a join.
AUTOMATON_LETTERS = 1_000_000


#: Texts of up to this many letters are looked at for whether two places of theirs can overlap; longer ones may.
LAPPING_LETTERS = 1024


def places_in_pieces(pieces: DataFrame, wanted: DataFrame, piece: int) -> DataFrame:
    """All places of exact sequences (``name, chrom, text``) in sequences in pieces (``chrom, start, seq``, each of ``piece`` bases
    but the last): ``chrom, name, text, start``."""
    return _places(pieces, wanted, piece).select("chrom", "name", "text", F.explode("starts").alias("start"))


def _places(pieces: DataFrame, wanted: DataFrame, piece: int) -> DataFrame:
    """``places_in_pieces``, a row for each text of a piece, with ``starts`` and whether places of the text may overlap, ``laps``.

    All texts are searched at once: a task reads each base of its pieces once, by an automaton of all texts, with as many bases
    of the pieces behind as the longest text may take."""
    texts = wanted.select("chrom", "name", upper_bases("text").alias("text")).where("text != ''").distinct()
    size = texts.select("text").distinct().agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("letters"), F.coalesce(F.max(F.length("text")), F.lit(1)).alias("longest")).first()
    held = pieces.select("chrom", "start", upper_bases("seq").alias("seq"))
    more = held
    for behind in range(1, -(-(size["longest"] - 1) // piece) + 1):
        part = held.select("chrom", (F.col("start") - behind * piece).alias("start"), F.left("seq", F.lit(size["longest"] - 1)).alias("next"))
        more = more.join(part, ["chrom", "start"], "left").withColumn("seq", F.concat("seq", F.coalesce("next", F.lit("")))).drop("next")
    # two places overlap where the text ends as it begins
    length = F.length("text")
    ends = F.exists(F.sequence(F.lit(1), length - 1), lambda k: F.left("text", k) == F.right("text", k))
    lapping = texts.withColumn("laps", F.when(length == 1, False).when(length > LAPPING_LETTERS, True).otherwise(ends))
    if size["letters"] <= AUTOMATON_LETTERS:
        return _automaton_hits(more, [r["text"] for r in texts.select("text").distinct().collect()], piece).join(lapping, ["chrom", "text"])
    return _seeded_hits(more, lapping, piece, size["longest"]).withColumn("starts", F.array("start")).drop("start")


def find_in_pieces(pieces: DataFrame, wanted: DataFrame, piece: int) -> DataFrame:
    """``find_features`` over sequences in pieces, by ``places_in_pieces``.

    Of places of one text that overlap, the first counts, then the first that begins behind it, and so on; only texts whose places can
    overlap are put in order for that."""
    found = _places(pieces, wanted, piece)
    found = found.select("chrom", "name", "text", "laps", F.length("text").alias("len"), F.explode("starts").alias("start"))
    hits = found.where("laps").drop("laps")
    keys = ["chrom", "name", "text"]
    before = with_previous(hits, keys, "start", ["len"])
    opens = F.when(F.col("previous.start") + F.col("len") > F.col("start"), 0).otherwise(1)
    chains = cumulative(before.withColumn("opens", opens), keys, "start", "opens", "chain")
    lone = chains.groupBy(*keys, "chain").agg(F.sort_array(F.collect_list("start")).alias("all"), F.max("len").alias("len"))
    step = lambda a, s: F.when(s >= a["free"], F.struct((s + F.col("len")).alias("free"), F.concat(a["own"], F.array(s)).alias("own"))).otherwise(a)
    start = F.struct(F.lit(-(1 << 62)).cast("long").alias("free"), F.array().cast("array<bigint>").alias("own"))
    own = lone.select("chrom", "name", "len", F.explode(F.aggregate("all", start, step, lambda a: a["own"])).alias("start"))
    own = own.unionByName(found.where("not laps").select("chrom", "name", "len", "start"))
    return own.select("chrom", "start", (F.col("start") + F.col("len")).alias("end"), "name", F.lit(0.0).alias("score"), F.lit("+").alias("strand"))


def _automaton_hits(held: DataFrame, texts: list[str], piece: int) -> DataFrame:
    """Places of all texts that begin in each piece: ``chrom, text, starts``, a row for each text of a piece."""

    def search(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for t in texts:
            automaton.add_word(t, t)
        if texts:
            automaton.make_automaton()
        for b in batches:
            rows: list[tuple[int, str, list[int]]] = []
            for i, (start, seq) in enumerate(zip(b.column("start").to_pylist(), b.column("seq").to_pylist())):
                own: dict[str, list[int]] = {}
                for end, t in automaton.iter(seq) if texts else ():
                    at = end + 1 - len(t)
                    if at < piece:
                        own.setdefault(t, []).append(start + at)
                rows += [(i, t, at) for t, at in own.items()]
            at, found, starts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("chrom").take(pa.array(at, pa.int64())), pa.array(found, pa.string()), pa.array(starts, pa.list_(pa.int64()))], ["chrom", "text", "starts"]
            )

    return held.mapInArrow(search, "chrom string, text string, starts array<long>")


def _seeded_hits(held: DataFrame, texts: DataFrame, piece: int, longest: int) -> DataFrame:
    """The same where texts are too many for a task: all places of as many letters as the shortest text has meet the texts that begin so."""
    k = int(texts.agg(F.min(F.length("text"))).first()[0])
    at = F.sequence(F.lit(1), F.least(F.lit(piece), F.length("seq") - (k - 1)))
    places = held.where(F.length("seq") >= k).select("chrom", "start", "seq", F.explode(at).alias("i"))
    places = places.select("chrom", (F.col("start") + F.col("i") - 1).alias("start"), F.substr("seq", F.col("i"), F.lit(longest)).alias("here"))
    seeded = texts.withColumn("seed", F.left("text", F.lit(k)))
    met = places.withColumn("seed", F.left("here", F.lit(k))).join(seeded, ["chrom", "seed"])
    return met.where(F.col("here").startswith(F.col("text"))).select("chrom", "start", "name", "text", "laps")


def best_names(names: Column) -> Column:
    """Names of a gene without compounds of known ones, and without generic ones while better remain."""
    plain = F.array_distinct(names)
    single = F.filter(plain, lambda n: ~(n.contains("-") & F.exists(F.split(n, "-"), lambda p: F.array_contains(plain, p))))
    generic = r"^LOC\d|^C[0-9XY]+orf|^Gm\d"
    better = F.filter(single, lambda n: ~n.rlike(generic))
    return F.array_sort(F.when(F.size(better) > 0, better).otherwise(single))


def family_root(names: Column) -> Column:
    """An array of the one root that all names of a family share, or the names themselves.

    Names are ordered by length, then as text.  Tried in turn: the shortest name, if all
    others go on with word characters; the first without its last capital, or without a
    hyphen and one or two digits, or without one or two digits, if all others are that root
    and such an ending; and the longest beginning of the shortest that all share, of at
    least two characters and at most four less than it."""
    by_length = F.transform(F.array_sort(F.transform(names, lambda n: F.struct(F.length(n).alias("k"), n.alias("n")))), lambda x: x["n"])
    first, others = F.get(by_length, F.lit(0)), F.slice(by_length, F.lit(2), F.greatest(F.size(by_length) - 1, F.lit(0)))

    def rest(n: Column, root: Column) -> Column:
        return F.when(n.startswith(root), F.substr(n, F.length(root) + 1))

    def all_go_on(root: Column, ending: str) -> Column:
        return F.forall(others, lambda n: F.coalesce(rest(n, root).rlike(f"^(?:{ending})$"), F.lit(False)))

    out = F.when(F.size(by_length) < 2, by_length).when(all_go_on(first, r"\w+"), F.array(first))
    for ending in (r"[A-Z]", r"-\d{1,2}", r"\d{1,2}"):
        root = F.regexp_extract(first, f"^(.+?)(?:{ending})$", 1)
        out = out.when((root != "") & all_go_on(root, ending), F.array(root))
    least = F.greatest(F.lit(2), F.length(first) - 4)
    starts = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda d: F.left(first, F.greatest(F.length(first) - d, least)))
    shared = F.filter(starts, lambda s: (F.length(first) >= 2) & F.forall(others, lambda n: n.startswith(s)))
    return out.when(F.size(shared) > 0, F.slice(shared, 1, 1)).otherwise(by_length)


def named_spans(transcripts: DataFrame) -> DataFrame:
    """Exon spans with the condensed names of all genes that share them: ``chrom, start, end, strand, name``."""
    ex = exon_rows(transcripts)
    own = ex.groupBy("chrom", "start", "end", "strand").agg(F.collect_set("gene").alias("genes"))
    return own.select("chrom", "start", "end", "strand", F.array_join(family_root(best_names(F.col("genes"))), ",").alias("name"))


def gene_span_rows(transcripts: DataFrame) -> DataFrame:
    """Merged transcripts of each gene as BED rows: ``chrom, start, end, name, score, strand``; several spans get ``:1``, ``:2``, ..."""
    s = gene_spans(transcripts)
    k = F.split("key", r"\|")
    name = F.when(F.col("spans") > 1, F.concat_ws(":", k[0], F.col("nth").cast("string"))).otherwise(k[0])
    return s.select(k[1].alias("chrom"), F.col("span_start").alias("start"), F.col("span_end").alias("end"), name.alias("name"), F.lit(0.0).alias("score"), k[2].alias("strand"))


def exon_rows(transcripts: DataFrame) -> DataFrame:
    """``gene, chrom, strand, start, end`` of all exons, from comma-joined or array starts and ends."""
    kind = transcripts.schema["exonStarts"].dataType.simpleString()
    arr = (lambda c: F.filter(F.split(c, ","), lambda x: x != "").cast("array<bigint>")) if kind == "string" else (lambda c: F.col(c).cast("array<bigint>"))
    z = F.arrays_zip(arr("exonStarts").alias("s"), arr("exonEnds").alias("e"))
    return transcripts.select("gene", "chrom", "strand", F.explode(z).alias("x")).select("gene", "chrom", "strand", F.col("x.s").alias("start"), F.col("x.e").alias("end"))


def gene_spans(transcripts: DataFrame) -> DataFrame:
    """Transcripts of a gene that overlap, merged: ``key`` (gene|chrom|strand), ``span_start, span_end``, ``nth`` of ``spans``."""
    tx = transcripts.select(F.concat_ws("|", "gene", "chrom", "strand").alias("chrom"), F.col("txStart").alias("start"), F.col("txEnd").alias("end"), F.lit("").alias("name"), F.lit(0.0).alias("score"), F.lit("+").alias("strand"))
    spans = collapse(tx, names=False).select(F.col("chrom").alias("key"), F.col("start").alias("span_start"), F.col("end").alias("span_end"))
    w = Window.partitionBy("key").orderBy(F.col("span_start").cast("string"))  # a gene has few spans
    return spans.withColumns({"nth": F.row_number().over(w), "spans": F.count("*").over(Window.partitionBy("key"))})


def gene_parts(transcripts: DataFrame) -> DataFrame:
    """Exons and introns of gene spans: ``chrom, start, end, name, strand, gene_length, kind, splice``.

    Transcripts of a gene that overlap are one span; several spans get ``:1``, ``:2``, ...
    Exons merge; they have the odd splice numbers, the introns between them the even ones."""
    spans = gene_spans(transcripts)
    ex = exon_rows(transcripts).withColumn("key", F.concat_ws("|", "gene", "chrom", "strand"))
    ex = ex.join(spans, "key").where("start >= span_start and end <= span_end")
    name = F.when(F.col("spans") > 1, F.concat_ws(":", "gene", "nth")).otherwise(F.col("gene"))
    ex = ex.select(F.concat_ws("|", name, F.col("chrom"), F.col("strand"), (F.col("span_end") - F.col("span_start")).cast("string")).alias("chrom"), "start", "end", F.lit("").alias("name"), F.lit(0.0).alias("score"), F.lit("+").alias("strand"))
    merged = collapse(ex, names=False)
    own = Window.partitionBy("chrom").orderBy("start")
    exons = merged.select("chrom", "start", "end", (F.row_number().over(own) * 2 - 1).alias("splice"), F.lag("end").over(own).alias("before"))
    introns = exons.where("before is not null").select("chrom", F.col("before").alias("start"), F.col("start").alias("end"), (F.col("splice") - 1).alias("splice"), F.lit("intron").alias("kind"))
    parts = exons.select("chrom", "start", "end", "splice", F.lit("exon").alias("kind")).unionByName(introns)
    k = F.split("chrom", r"\|")
    return parts.select(k[1].alias("chrom"), "start", "end", k[0].alias("name"), k[2].alias("strand"), k[3].cast("long").alias("gene_length"), "kind", "splice")


#: An element of this many bases makes no cut, but competes in the cuts it covers.
LONG_ELEMENT = 1_000_000


def segment_map(transcripts: DataFrame, *, stranded: bool = False) -> DataFrame:
    """The genome cut into stretches of one annotation: ``chrom, start, end, name, strand, gene_length, feature, splice``.

    Where elements overlap, sense wins over antisense (``stranded`` reflects each element to
    the other strand), then exon over intron; if several are left the stretch is ambiguous.
    Equal neighbours merge."""
    parts = materialized(gene_parts(transcripts))  # read many times below
    if stranded:
        anti = parts.withColumn("strand", F.when(F.col("strand") == "+", "-").otherwise("+")).withColumn("sense", F.lit(0))
        parts = parts.withColumn("sense", F.lit(1)).unionByName(anti)
    else:
        parts = parts.withColumn("sense", F.lit(1)).withColumn("strand", F.lit("."))
    rank = F.col("sense") * 2 + (F.col("kind") == "exon").cast("int")
    parts = parts.where("end > start").withColumn("rank", rank)
    info = F.to_json(F.struct("name", "gene_length", "kind", "splice", "sense", "rank"))
    f = parts.select("chrom", "start", "end", info.alias("name"), F.col("rank").cast("double").alias("score"), "strand")
    short = f.where(F.col("end") - F.col("start") < LONG_ELEMENT)
    cuts = split(short, stranded=True)
    tiles = cuts.select("chrom", "strand", "start", "end").distinct()
    big = f.where(F.col("end") - F.col("start") >= LONG_ELEMENT).select("chrom", "strand", F.col("start").alias("rs"), F.col("end").alias("re"), "name", "score")
    cell = 1 << 20
    over = (
        tiles.withColumn("cell", F.floor(F.col("start") / cell))
        .join(big.withColumn("cell", F.explode(F.sequence(F.floor(F.col("rs") / cell), F.floor(F.col("re") / cell)))), ["chrom", "strand", "cell"])
        .where("start >= rs and end <= re")
        .select("chrom", "start", "end", "name", "score", "strand")
    )
    all_ = cuts.unionByName(over).distinct()
    best = F.max("score").over(Window.partitionBy("chrom", "strand", "start", "end"))
    won = all_.withColumn("best", best).where("score = best").groupBy("chrom", "strand", "start", "end").agg(F.count("*").alias("n"), F.min("name").alias("info"))
    won = won.withColumn("info", F.when(F.col("n") == 1, F.col("info")).otherwise("ambiguous"))
    own = ["chrom", "strand"]
    won = with_previous(materialized(won), own, "start", ["end", "info"])
    turn = F.when((F.col("previous.info") == F.col("info")) & (F.col("previous.end") == F.col("start")), 0).otherwise(1)
    runs = cumulative(won.withColumn("turn", turn), own, "start", "turn", "run")
    out = runs.groupBy("chrom", "strand", "run", "info").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    g = lambda k: F.get_json_object("info", f"$.{k}")
    side = F.when(g("sense") == "0", F.lit("anti")).otherwise(F.lit(""))
    vague = F.col("info") == "ambiguous"
    return out.select(
        "chrom", "start", "end", F.when(vague, "ambiguous").otherwise(g("name")).alias("name"), "strand",
        F.when(vague, 0).otherwise(g("gene_length").cast("long")).alias("gene_length"),
        F.when(vague, "ambiguous").otherwise(F.concat(side, g("kind"))).alias("feature"), F.when(vague, 0).otherwise(g("splice").cast("int")).alias("splice"),
    )
