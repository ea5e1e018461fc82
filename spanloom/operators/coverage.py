"""Coverage: depth histograms, base and bin coverage, chunks, and break maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.intervals import depth, sweep


def depth_histogram(reads: DataFrame, chroms: DataFrame) -> DataFrame:
    """How many bases have each depth, 0 included: ``depth, n``."""
    covered = depth(reads).groupBy("depth").agg(F.sum(F.col("end") - F.col("start")).alias("n"))
    total = chroms.agg(F.sum("size").alias("size")).crossJoin(covered.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    zero = total.select(F.lit(0).cast("long").alias("depth"), (F.col("size") - F.col("n")).alias("n"))
    return covered.unionByName(zero)


def base_coverage(reads: DataFrame, read_length: float = 1.0, *, strand: str | None = None) -> DataFrame:
    """Covered stretches with depth over read length: ``chrom, start, end, coverage``.  Expand with ``bases`` where needed."""
    if strand:
        reads = reads.where(F.col("strand") == strand)
    return depth(reads).select("chrom", "start", "end", (F.col("depth") / read_length).alias("coverage"))


def usable_reads(reads: DataFrame, *, min_mapq: int = 0, require: int = 0, forbid: int = 0) -> DataFrame:
    """Alignments of at least ``min_mapq`` whose ``flag`` has all bits of ``require`` and none of ``forbid``."""
    flag = F.col("flag")
    return reads.where((F.col("mapq") >= min_mapq) & (flag.bitwiseAND(require) == require) & (flag.bitwiseAND(forbid) == 0))


def strand_reads(reads: DataFrame, strand: str, *, invert: bool = False) -> DataFrame:
    """Alignments of one strand by flag 16; ``invert`` turns strands, as where the other strand was sequenced."""
    back = F.col("flag").bitwiseAND(16) != 0
    return reads.where(back if (strand == "-") != invert else ~back)


def merge_alignments(*parts: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    """All parts' alignments, one for each place, strand and mate place: the least ``name`` of those of the best ``quality``.

    Unmapped alignments (flag 4) are all kept.  Two rows meet by key, so a place in very many
    reads is reduced before it is shuffled."""
    all_ = parts[0]
    for more in parts[1:]:
        all_ = all_.unionByName(more)
    if not remove_duplicates:
        return all_
    lost = F.col("flag").bitwiseAND(4) != 0
    keys = ["chrom", "start", "mate_start", F.col("flag").bitwiseAND(16).alias("side")]
    best = all_.where(~lost).groupBy(*keys).agg(F.min_by(F.struct(*all_.columns), F.struct(-F.col("quality"), "name")).alias("best"))
    return best.select("best.*").unionByName(all_.where(lost))


def bases(stretches: DataFrame) -> DataFrame:
    """One row per base of ``base_coverage``."""
    return stretches.select("chrom", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"), "coverage")


def bin_coverage(reads: DataFrame, bin_size: int, *, count: str | None = None) -> DataFrame:
    """Counts by strand, chromosome and nearest bin: position rounded half up to a multiple of ``bin_size``."""
    at = (F.floor(F.col("start") / bin_size + 0.5) * bin_size).cast("long")
    return reads.groupBy("strand", "chrom", at.alias("bin")).agg(F.sum(F.col(count) if count else F.lit(1.0)).alias("coverage"))


def chunk_size(n_bases: int, n_chunks: int) -> int:
    """Even share of the bases, rounded half up to two significant digits."""
    size = n_bases // n_chunks
    step = 10 ** max(0, len(str(size)) - 2)
    return max(1, (2 * size + step) // (2 * step) * step)


def chunk_tiles(chroms: DataFrame, size: int, *, half_open: bool = False) -> DataFrame:
    """Tiles of ``size`` from 1, closed; the last takes what is left if that is at most a tenth more: ``chrom, chunk, start, end``.

    ``half_open`` gives starts from 0, as in BED files."""
    # tiles before the last: those after which over 1.1 tiles remain
    full = F.greatest(F.lit(0), F.ceil((F.col("size") - 1.1 * size) / size)).cast("int")
    n = chroms.select("chrom", "size", F.explode(F.sequence(F.lit(0), full)).alias("chunk"), full.alias("last"))
    return n.select(
        "chrom", "chunk", (F.col("chunk") * size + (0 if half_open else 1)).cast("long").alias("start"),
        F.when(F.col("chunk") == F.col("last"), F.col("size")).otherwise((F.col("chunk") + 1) * size).cast("long").alias("end"),
    )


def break_map(fragments: DataFrame) -> DataFrame:
    """Coverage changes of fragments ``sample, chrom, pos, len``: +1 at the position, -1 after the end; zeros drop out."""
    ends = fragments.select("sample", "chrom", F.col("pos").cast("long").alias("pos"), F.lit(1).alias("d")).unionByName(
        fragments.select("sample", "chrom", (F.col("pos") + F.col("len")).cast("long").alias("pos"), F.lit(-1).alias("d"))
    )
    return ends.groupBy("sample", "chrom", "pos").agg(F.sum("d").cast("int").alias("delta")).where("delta != 0")


def fragment_stats(fragments: DataFrame, chroms: DataFrame) -> DataFrame:
    """``sample, chrom, n_frags, sum_len, chrom_len, avg_len`` (rounded) and ``coverage`` (one decimal)."""
    s = fragments.groupBy("sample", "chrom").agg(F.count("*").alias("n_frags"), F.sum("len").cast("long").alias("sum_len"))
    return s.join(F.broadcast(chroms), "chrom").select(
        "sample", "chrom", "n_frags", "sum_len", F.col("size").alias("chrom_len"),
        F.floor(F.col("sum_len") / F.col("n_frags") + 0.5).alias("avg_len"), (F.floor(F.col("sum_len") / F.col("size") * 10 + 0.5) / 10).alias("coverage"),
    )


def segments(breaks: DataFrame) -> DataFrame:
    """Stretches of even coverage between breaks: ``sample, chrom, start, end, cov``."""
    return sweep(breaks.select("sample", "chrom", "pos", F.col("delta").alias("d")), ["sample", "chrom"]).withColumnRenamed("level", "cov")
