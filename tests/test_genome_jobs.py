import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import genome as G
from spanloom.operators import jobs as J
from spanloom.operators import varbin as B
from spanloom.operators.coverage import chunk_size, chunk_tiles
from spanloom.plans.parameters import Pipeline, choose, invoke, series
from spanloom.sources import bed as S


def test_sequence_edits():
    assert G.edit_sequence("CCAAAAGGGGCC", [("COORDINATES", "6", "7", "TT")]) == "CCAAAATTGGGGCC"
    assert G.edit_sequence("aaccggtt", [("FLANKS", "AAC", "GTT", "NNN")]) == "AACNNNGTT"


def test_build_and_lift_over(spark):
    seq = spark.createDataFrame([("c", "CCAAAAGGGGCC")], "chrom string, seq string")
    ch = spark.createDataFrame([("c", "COORDINATES", "4", "9", "T")], "chrom string, kind string, left string, right string, text string")
    assert G.build_sequences(seq, ch).first()["seq"] == "CCAATGGCC"[:4] + "T" + "GGCC"
    pts = spark.createDataFrame([("c", p) for p in (3, 4, 5, 7, 9, 12)], "chrom string, pos long")
    num = spark.createDataFrame([("c", 4, 9, 1)], "chrom string, last_before long, first_after long, inserted long")
    got = {r["pos"]: r["lifted"] for r in G.lift_over(pts, num).collect()}
    assert got == {3: 3, 4: 4, 5: 5, 7: -1, 9: 6, 12: 9}


def test_motif_counts_do_not_overlap_and_cross_bins(spark):
    seq = spark.createDataFrame([("c", "AAAA"), ("d", "CAAC")], "chrom string, seq string")
    got = {(r["chrom"], r["start"]): r["score"] for r in G.motif_bins(seq, "AA", 4).collect()}
    assert got["c", 0] == 0.5
    assert {(r["chrom"], r["start"]): r["score"] for r in G.motif_bins(seq, "AA", 2).collect()}["d", 2] == 0.5


def test_split_and_find(spark):
    seq = spark.createDataFrame([("c", "TTGATCAAGATCGG")], "chrom string, seq string")
    got = sorted((r["start"], r["end"], r["strand"]) for r in G.split_sequences(seq, "GATC").collect())
    assert got == [(0, 6, "+"), (6, 12, "+"), (12, 14, "-")]
    want = spark.createDataFrame([("w", "c", "gatc")], "name string, chrom string, text string")
    assert sorted(r["start"] for r in G.find_features(seq, want).collect()) == [2, 8]


def test_segment_map_prefers_exons(spark):
    t = spark.createDataFrame(
        [("A", "c", "+", 0, 1000, [0, 800], [100, 1000]), ("B", "c", "+", 500, 900, [500, 850], [600, 900])],
        "gene string, chrom string, strand string, txStart long, txEnd long, exonStarts array<bigint>, exonEnds array<bigint>",
    )
    got = [(r["start"], r["end"], r["name"], r["feature"]) for r in G.segment_map(t).orderBy("start").collect()]
    assert got == [
        (0, 100, "A", "exon"), (100, 500, "A", "intron"), (500, 600, "B", "exon"), (600, 800, "ambiguous", "ambiguous"),
        (800, 850, "A", "exon"), (850, 900, "ambiguous", "ambiguous"), (900, 1000, "A", "exon"),
    ]


def test_chunks():
    assert chunk_size(3_088_269_832, 75) == 41_000_000


def test_last_chunk_absorbs_a_tenth(spark):
    c = spark.createDataFrame([("a", 209), ("b", 211), ("c", 50)], "chrom string, size long")
    got = sorted((r["chrom"], r["start"], r["end"]) for r in chunk_tiles(c, 100).collect())
    assert got == [("a", 1, 100), ("a", 101, 209), ("b", 1, 100), ("b", 101, 200), ("b", 201, 211), ("c", 1, 50)]


def test_bins_hold_their_target():
    bins = B.walk_bins(np.array([10, 110]), np.array([2.0, -2.0]), 200, 50.0)
    assert bins[:2] == [(0, 34), (35, 59)]
    assert bins[-1][1] == 200 and all(a[1] + 1 == b[0] for a, b in zip(bins, bins[1:]))


def test_viterbi_smooths_a_glitch():
    e = np.log(np.array([[0.9, 0.1]] * 5 + [[0.4, 0.6]] + [[0.9, 0.1]] * 5 + [[0.1, 0.9]] * 6))
    assert B.viterbi(e).tolist() == [0] * 11 + [1] * 6


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("# note\nchr1\t1,000\t2000\tn\tNULL\t+\textra\r\n\nchr2\t5\t9\n")
    got = sorted(map(tuple, S.read_bed(spark, str(tmp_path / "a.bed"), padding=10).collect()))
    assert got == [("chr1", 990, 2010, "n", None, "+", ["extra"]), ("chr2", -5, 19, None, None, None, [])]
    (tmp_path / "bad.bed").write_text("chr1\t-4\t9\n")
    with pytest.raises(Exception, match="invalid start"):
        S.read_bed(spark, str(tmp_path / "bad.bed")).collect()
    (tmp_path / "b.map").write_bytes(struct.pack("<IhIh", 5, 2, 70000, -2))
    assert sorted((r["pos"], r["delta"]) for r in S.read_break_map(spark, str(tmp_path / "b.map"), "s", "c").collect()) == [(5, 2), (70000, -2)]
    (tmp_path / "c.fa").write_text(">c1 note\nacgt\nAC\n>c2\nTT\n")
    assert sorted(map(tuple, S.read_fasta(spark, str(tmp_path / "c.fa")).collect())) == [("c1", "ACGTAC"), ("c2", "TT")]


def test_long_files_are_read_by_ranges(spark, tmp_path):
    """Records and maps that many tasks read, each knowing only its own range."""
    r = np.random.default_rng(3)
    seqs = {f"c{k}": "".join(r.choice(list("acgtN"), n)) for k, n in enumerate((1, 50, 977, 4000, 64, 128))}
    wrapped = [f">{c} a note\n" + "\n".join(s[i : i + 50] for i in range(0, len(s), 50)) + "\n\n" for c, s in seqs.items()]
    (tmp_path / "a.fa").write_text("".join(wrapped[:4]) + ">empty\n")
    (tmp_path / "b.fa").write_text("".join(wrapped[4:]))
    pos = np.sort(r.choice(10**6, 5000, replace=False))
    rows = [(int(p), int(d)) for p, d in zip(pos, r.integers(-9, 9, 5000))]
    (tmp_path / "x.map").write_bytes(b"".join(struct.pack("<Ih", *x) for x in rows))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.input.fileinputformat.split.maxsize", "600")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for piece in (64, 37, 10000):
            got = {}
            for x in S.read_fasta_pieces(spark, str(tmp_path / "*.fa"), piece).collect():
                assert x.start % piece == 0 and len(x.seq) <= piece
                got.setdefault(x.chrom, {})[x.start] = x.seq
            assert {c: "".join(p[k] for k in sorted(p)) for c, p in got.items()} == {c: s.upper() for c, s in seqs.items()}
        breaks = S.read_break_map(spark, str(tmp_path / "x.map"), "s", "c")
        assert breaks.rdd.getNumPartitions() >= 40
        assert sorted((x["pos"], x["delta"]) for x in breaks.collect()) == rows
    finally:
        hadoop.unset("mapreduce.input.fileinputformat.split.maxsize")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stats_keep_the_last_write(spark):
    s = spark.createDataFrame([("e", "a", "1", 1), ("e", "a", "2", 2), ("e", "b", "x", 1), ("e", "b", "", 2)], "entity string, name string, value string, version int")
    assert [tuple(r) for r in S.latest_stats(s).collect()] == [("e", "a", "2")]


def test_series_and_choices():
    assert [d["A"] + d["B"] + d["C"] for d in series("$A a1 a2 + $B b1 b2 * $C c1 c2")] == ["a1b1c1", "a1b1c2", "a2b2c1", "a2b2c2"]
    with pytest.raises(ValueError, match="zipped"):
        list(series("$A a1 a2 + $B b1"))
    assert choose("$X ? yes : no", {"X": None}) == "no" and choose("$X ? yes : no", {"X": "1"}) == "yes"
    assert invoke(lambda A: {"out": A * 2}, "$A p q", ("out",)) == {"out": ["pp", "qq"]}
    done = Pipeline().add("b", lambda a: a + 1, "a").add("a", lambda: 1).run()
    assert done == {"a": 1, "b": 2}


def test_jobs(spark):
    jobs = spark.createDataFrame([(1, "x", 137, False), (2, "x", 0, False), (3, "y", 137, False), (4, "z", None, False)], "job long, command string, exit_status int, deleted boolean")
    want = spark.createDataFrame([(c,) for c in "wxyz"], "command string")
    assert sorted(r[0] for r in J.extend(want, jobs).collect()) == ["w", "y", "z"]
    assert sorted(r["job"] for r in jobs.where(J.job_selector("3+,1")).collect()) == [1, 3, 4]


def test_log_and_exit_states(spark):
    texts = [
        "x\nq: execution started: Mon 1\nout\nq: exit_status: 0; walltime: 0:59.12; seconds: 59; maxvmem: 1499500K;\n", "x\nq: execution started: Tue\nout",
        "", "x\nq: execution started: Wed\n exit_status: 3; walltime: 12:34.5; seconds: 754; maxvmem: 12K;", "x\nq: execution started: Thu\n exit_status: 1; walltime: 1:02:03; seconds: 3723; maxvmem: 2000000K;",
    ]
    got = J.parse_logs(spark.createDataFrame(list(enumerate(texts)), "job int, text string")).orderBy("job").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("Mon 1", "0", "00:00:59", 59.0, 1.5), ("Tue", "137", "99:99:99", 9999999.0, 0.0), ("", "pending", "", 0.0, 0.0),
        ("Wed", "3", "00:12:34", 754.0, 0.0), ("Thu", "1", "01:02:03", 3723.0, 2.0),
    ]
    states = spark.createDataFrame([(s,) for s in ("0", "137", "Eqw", "hqw", "deleted", None)], "exit_status string")
    assert [tuple(r)[1:] for r in J.job_states(states).collect()] == [(False, False), (False, False), (True, True), (False, True), (False, False), (False, False)]
    lines = spark.createDataFrame(list(enumerate(["submitted\tMon", "jobName\tjobID", "a\t1", "submitted\tTue", "b\t2", "c\t3"])), "n long, value string")
    assert sorted(map(tuple, J.load_status(lines, ["name", "id"]).collect())) == [(1, "a", "1"), (2, "b", "2"), (2, "c", "3")]


def test_closure_stays_in_its_batch(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    e = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 1), (2, 1, 9)], "batch_id int, predecessor long, job long")
    got = J.successors(e, spark.createDataFrame([(1, 1)], "batch_id int, job long"))
    assert sorted(r["job"] for r in got.collect()) == [1, 2, 3]
    assert got.agg(F.max("batch_id")).first()[0] == 1


def test_paths(spark, tmp_path):
    from spanloom.sources import files

    (tmp_path / "x.gz").write_text("")
    assert files.exists(spark, f"{tmp_path}/*.gz") and not files.exists(spark, f"{tmp_path}/*.txt")
    assert files.gzipped(spark, f"{tmp_path}/*") and files.check_prefix(spark, f"{tmp_path}/new")
    with pytest.raises(FileNotFoundError):
        files.require(spark, f"{tmp_path}/nothing*")


def test_streamed_features_cross_static_references(spark, bed, tmp_path):
    from spanloom.streaming.static import hits

    bed([("c", 5, 9, "q", 1.0, "+"), ("c", 50, 60, "far", 1.0, "+")]).write.parquet(str(tmp_path / "in"))
    refs = bed([("c", 9, 20, "touch", 1.0, "+"), ("c", 0, 6, "over", 1.0, "+")])
    stream = spark.readStream.schema(refs.schema).parquet(str(tmp_path / "in"))
    q = hits(stream, refs).writeStream.format("memory").queryName("crossed").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["name"], r["ref"]) for r in spark.table("crossed").collect()) == [("q", "over"), ("q", "touch")]
