"""Registered queries over the driver's tables and the SQL that says what they must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import scalars as L
from spanloom.functions.scalars import human, stars
from spanloom.operators import correlate as C
from spanloom.operators import coverage as V
from spanloom.operators import genome as G
from spanloom.operators import intervals as I
from spanloom.operators import jobs as J
from spanloom.operators import joins as X
from spanloom.operators import scores as S
from spanloom.operators import simulate as M
from spanloom.operators import varbin as B
from spanloom.operators.reshape import crosstab, uncrosstab, with_places
from spanloom.plans import views as P
from spanloom.plans.views import with_
from spanloom.sources import bed as R
from spanloom.sources.folders import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: The iterations of the view; each of its features has all of them.
ITERATIONS = list(range(-1, 19))


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where there is one."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


BED3 = 's AS start, e AS "end"'

# ---- interval algebra ---------------------------------------------------------------


def _collapse_sql(key: str = "'.'", pad: int = 0, names: bool = False) -> str:
    return f"""{with_('iv')}, cp AS (SELECT chrom, {key} AS k, s - {pad} AS s, e + {pad} AS e, name FROM iv),
        m AS (SELECT *, max(e) OVER (PARTITION BY chrom, k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM cp),
        g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m),
        c AS (SELECT chrom, k, min(s) AS s, max(e) AS e, count(*) AS n, string_agg(CASE WHEN name = '0' THEN chrom || ':' || s || '-' || e || '[' || k || ']' ELSE name END, '::' ORDER BY s, e, name) AS name FROM g GROUP BY chrom, k, gid)"""


@query("collapse", _collapse_sql(names=True) + f" SELECT chrom, {BED3}, name, 0.0::DOUBLE AS score, '+' AS strand, n FROM c")
def _(spark, d):
    return I.collapse(P.intervals(spark, d))


@query("collapse_stranded", _collapse_sql("strand") + f" SELECT chrom, {BED3}, name, 0.0::DOUBLE AS score, k AS strand, n FROM c")
def _(spark, d):
    return I.collapse(P.intervals(spark, d), stranded=True)


@query("collapse_padded", _collapse_sql(pad=250) + ' SELECT chrom, s + 250 AS start, e - 250 AS "end", n FROM c')
def _(spark, d):
    return I.collapse(P.intervals(spark, d), padding=250, unpadded=True, names=False).select("chrom", "start", "end", "n")


@query("pad_unpad", with_("iv") + ' SELECT name, s - 100 AS start, e + 100 AS "end" FROM iv')
def _(spark, d):
    return I.pad(P.intervals(spark, d), 100).select("name", "start", "end")


@query("offset_control", with_("iv") + ' SELECT name, s + 5000 AS start, e + 5000 AS "end" FROM iv')
def _(spark, d):
    return I.offset(P.intervals(spark, d), 5000).select("name", "start", "end")


def _grouped(d: DataFrame) -> DataFrame:
    # places repeat: positions are cut to hundreds
    return d.withColumns({"start": F.floor(F.col("start") / 20000) * 20000, "end": F.floor(F.col("start") / 20000) * 20000 + 20000})


_GROUP_SQL = with_("iv") + """, g AS (SELECT chrom, (s // 20000) * 20000 AS s, name, score FROM iv)
    SELECT chrom, s AS start, s + 20000 AS "end", string_agg(name, '::' ORDER BY name) AS name, {v} AS score, '+' AS strand FROM g GROUP BY chrom, s"""
for _type, _agg in {
    "COUNT": "count(*)::DOUBLE", "SUM": "round(sum(score), 6)", "AVERAGE": "round(avg(score), 6)", "MEDIAN": "round(median(score), 6)",
    "MIN": "min(score)", "MAX": "max(score)", "BOOLEAN": "1.0::DOUBLE",
}.items():

    @query(f"group_{_type.lower()}", _GROUP_SQL.replace("{v}", _agg))
    def _(spark, d, kind=_type):
        return rounded(I.group(_grouped(P.intervals(spark, d)), kind), "score")


@query(
    "group_median_upper",
    with_("iv") + """, g AS (SELECT chrom, (s // 20000) * 20000 AS s, list_sort(list(score)) AS v FROM iv GROUP BY ALL)
    SELECT chrom, s AS start, v[CAST(floor(len(v) / 2.0 + 0.5) AS BIGINT) + 1] AS score FROM g""",
)
def _(spark, d):
    return _grouped(P.intervals(spark, d)).groupBy("chrom", "start").agg(I.median_upper().alias("score"))


_SPLIT = with_("iv", "chroms") + """, p AS (SELECT DISTINCT chrom, pos FROM (SELECT chrom, s AS pos FROM iv UNION ALL SELECT chrom, e FROM iv)),
    q AS (SELECT chrom, pos AS ps, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS pe FROM p),
    sp AS (SELECT iv.chrom, q.ps, q.pe, iv.name, iv.score FROM iv JOIN q ON iv.chrom = q.chrom AND q.ps >= iv.s AND q.pe <= iv.e)"""


@query("split", _SPLIT + ' SELECT chrom, ps AS start, pe AS "end", name, score FROM sp')
def _(spark, d):
    return I.split(P.intervals(spark, d)).select("chrom", "start", "end", "name", "score")


@query("split_grouped", _SPLIT + """ SELECT chrom, ps AS start, pe AS "end", string_agg(name, '::' ORDER BY name) AS name, round(sum(score), 6) AS score FROM sp GROUP BY ALL""")
def _(spark, d):
    return rounded(I.split_summed(P.intervals(spark, d)), "score").select("chrom", "start", "end", "name", "score")


_GAPS = _collapse_sql() + """, z AS (SELECT 'chr' || i AS chrom, 600000 AS size FROM range(1, 6) t(i)),
    w AS (SELECT c.chrom, coalesce(lag(e) OVER (PARTITION BY c.chrom ORDER BY s), 0) AS a, least(s, size) AS b FROM c JOIN z USING (chrom)),
    t AS (SELECT z.chrom, coalesce(max(e), 0) AS a, any_value(size) AS b FROM z LEFT JOIN c USING (chrom) GROUP BY z.chrom),
    gaps AS (SELECT * FROM w WHERE a < b UNION ALL SELECT * FROM t WHERE a < b)"""


@query("gaps_complement", _GAPS + """ SELECT chrom, a AS start, b AS "end", 'GAP' AS name FROM gaps""")
def _(spark, d):
    return I.complement(P.intervals(spark, d), P.chroms(spark)).select("chrom", "start", "end", "name")


@query("split_gaps", _SPLIT + """, u AS (SELECT chrom, ps AS start, pe AS "end", name FROM sp) """ + ", " + _GAPS[len(with_("iv")) + 2 :] + """ SELECT * FROM u UNION ALL SELECT chrom, a, b, 'GAP' FROM gaps""")
def _(spark, d):
    return I.split(P.intervals(spark, d), chroms=P.chroms(spark), gaps=True).select("chrom", "start", "end", "name")


_DEPTH = with_("iv") + """, p AS (SELECT chrom, pos, sum(d) AS d FROM (SELECT chrom, s AS pos, 1 AS d FROM iv UNION ALL SELECT chrom, e, -1 FROM iv) GROUP BY chrom, pos),
    w AS (SELECT chrom, pos AS s, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS e,
          sum(d) OVER (PARTITION BY chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS depth FROM p),
    dp AS (SELECT chrom, s, e, CAST(depth AS BIGINT) AS depth FROM w WHERE e IS NOT NULL AND depth > 0)"""


@query("depth", _DEPTH + f" SELECT chrom, {BED3}, depth FROM dp")
def _(spark, d):
    return I.depth(P.intervals(spark, d))


@query("depth_histogram", _DEPTH + """, h AS (SELECT depth, CAST(sum(e - s) AS BIGINT) AS n FROM dp GROUP BY depth)
    SELECT * FROM h UNION ALL SELECT 0, 5 * 600000 - CAST((SELECT sum(n) FROM h) AS BIGINT)""")
def _(spark, d):
    return V.depth_histogram(P.intervals(spark, d), P.chroms(spark))


@query("base_coverage", _DEPTH + f" SELECT chrom, {BED3}, round(depth / 50.0, 6) AS coverage FROM dp")
def _(spark, d):
    return rounded(V.base_coverage(P.intervals(spark, d), 50.0), "coverage")


@query("bin_coverage", with_("iv") + " SELECT strand, chrom, CAST(floor(s / 1000.0 + 0.5) * 1000 AS BIGINT) AS bin, round(sum(score), 6) AS coverage FROM iv GROUP BY ALL")
def _(spark, d):
    return rounded(V.bin_coverage(P.intervals(spark, d), 1000, count="score"), "coverage")


_SIZES = with_("iv") + """, z AS (SELECT chrom, CAST(max(e) + sum(score) AS BIGINT) AS size FROM iv GROUP BY chrom)"""


def _sizes(spark, d) -> DataFrame:
    """Chromosomes as long as their furthest end and all their scores together."""
    return P.intervals(spark, d).groupBy("chrom").agg(F.round(F.max("end") + F.sum("score")).cast("long").alias("size"))


@query("chunk_tiles", _SIZES.replace("CAST(max(e) + sum(score) AS BIGINT)", "CAST(round(max(e) + sum(score)) AS BIGINT)") + """ SELECT chrom, CAST(i AS INTEGER) AS chunk, CAST(i * 41000 + 1 AS BIGINT) AS start,
    CAST(CASE WHEN i = n THEN size ELSE (i + 1) * 41000 END AS BIGINT) AS "end"
    FROM (SELECT chrom, size, greatest(0, CAST(ceil((size - 1.1 * 41000) / 41000) AS BIGINT)) AS n FROM z), LATERAL (SELECT unnest(range(0, n + 1)) AS i)""")
def _(spark, d):
    return V.chunk_tiles(_sizes(spark, d), 41000)


# ---- interval joins -------------------------------------------------------------------

_HITS = with_("f", "r") + """, x AS (SELECT f.event_id AS id, f.s, f.e, r.s AS rs, r.e AS re, r.score AS rscore FROM f JOIN r ON f.chrom = r.chrom AND r.s <= f.e AND r.e >= f.s)"""
_COLLAPSED_REFS = (
    with_("f", "r") + """, m AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM r),
    g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m),
    c AS (SELECT chrom, min(s) AS rs, max(e) AS re FROM g GROUP BY chrom, gid),
    x AS (SELECT f.event_id AS id, f.s, f.e, c.rs, c.re FROM f JOIN c ON f.chrom = c.chrom AND c.rs <= f.e AND c.re >= f.s)"""
)
_OVERLAP = "(least(e, re) - greatest(s, rs))"
_ENDS = "sum(CASE WHEN s BETWEEN rs AND re OR e BETWEEN rs AND re THEN 1 ELSE 0 END)"
_PART = f"({_OVERLAP} / CAST(e - s AS DOUBLE))"
for _type, (_from, _val, _none) in {
    "COUNT": (_HITS, "count(*)", "0"),
    "COUNT_ENDS": (_HITS, _ENDS, "0"),
    "LENGTH": (_COLLAPSED_REFS, f"sum{_OVERLAP}", "0"),
    "FRACTION": (_COLLAPSED_REFS, f"sum({_PART})", "0"),
    "BOOLEAN": (_COLLAPSED_REFS, f"CASE WHEN sum({_PART}) >= 1.0 / any_value(e - s) THEN 1 ELSE 0 END", "0"),
    "BOOLEAN_ENDS": (_COLLAPSED_REFS, f"CASE WHEN {_ENDS} > 0 THEN 1 ELSE 0 END", "0"),
    "WEIGHTED": (_HITS, f"sum({_PART} * rscore)", "0"),
    "WEIGHTED2": (_HITS, f"CASE WHEN sum({_PART}) > 0 THEN sum({_PART} * rscore) / sum({_PART}) END", "NULL"),
    "MAX_REF_LENGTH": (_HITS, "max(re - rs)", "NULL"),
    "MAX_REF_SCORE": (_HITS, "max(rscore)", "NULL"),
}.items():

    @query(
        f"crossing_{_type.lower()}",
        f"{_from}, v AS (SELECT id, CAST({_val} AS DOUBLE) AS v FROM x GROUP BY id) SELECT event_id, round(CAST(coalesce(v, {_none}) AS DOUBLE), 6) AS cross_score FROM f LEFT JOIN v ON id = event_id",
    )
    def _(spark, d, kind=_type):
        return rounded(X.crossing(P.features(spark, d), P.refs(spark, d), kind), "cross_score").select("event_id", "cross_score")


_MID = "CAST(floor({s} + ({e} - {s}) / 2.0 + 0.5) AS BIGINT)"


@query("crossing_distance_edge", with_("f", "r") + " SELECT f.event_id, CAST(min(greatest(0, r.s - f.e, f.s - r.e)) AS DOUBLE) AS cross_score FROM f LEFT JOIN r USING (chrom) GROUP BY f.event_id")
def _(spark, d):
    return X.crossing(P.features(spark, d), P.refs(spark, d), "DISTANCE_EDGE").select("event_id", "cross_score")


@query(
    "crossing_distance_center",
    with_("f", "r") + f" SELECT f.event_id, CAST(min(abs({_MID.format(s='r.s', e='r.e')} - {_MID.format(s='f.s', e='f.e')})) AS DOUBLE) AS cross_score FROM f LEFT JOIN r USING (chrom) GROUP BY f.event_id",
)
def _(spark, d):
    return X.crossing(P.features(spark, d), P.refs(spark, d), "DISTANCE_CENTER").select("event_id", "cross_score")


@query("crossing_strict_padded", with_("f", "r") + """ SELECT f.event_id, CAST(count(r.event_id) AS DOUBLE) AS cross_score FROM f
    LEFT JOIN r ON f.chrom = r.chrom AND f.strand = r.strand AND r.s - 50 < f.e + 50 AND r.e + 50 > f.s - 50 GROUP BY f.event_id""")
def _(spark, d):
    return X.crossing(P.features(spark, d), P.refs(spark, d), "COUNT", stranded=True, padding=50, touch=False).select("event_id", "cross_score")


@query("outside_spans", with_("f", "r") + " SELECT event_id FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.chrom = f.chrom AND f.s >= r.s AND f.e <= r.e)")
def _(spark, d):
    return X.outside(P.features(spark, d), P.refs(spark, d)).select("event_id")


@query("excluded_fraction", f"{_COLLAPSED_REFS}, v AS (SELECT id, sum({_PART}) AS v FROM x GROUP BY id) SELECT event_id, round(coalesce(v, 0), 6) AS excluded FROM f LEFT JOIN v ON id = event_id")
def _(spark, d):
    return rounded(X.excluded_fraction(P.features(spark, d), P.refs(spark, d)), "excluded").select("event_id", "excluded")


@query("min_probes", with_("f", "r") + " SELECT event_id, count(*) FILTER (p IS NOT NULL) AS n_probes FROM f LEFT JOIN (SELECT chrom, s AS p FROM r) q ON f.chrom = q.chrom AND p BETWEEN f.s AND f.e - 1 GROUP BY event_id")
def _(spark, d):
    return X.probe_count(P.features(spark, d), P.refs(spark, d)).select("event_id", "n_probes")


@query("probe_gaps", with_("f", "chroms") + """, p AS (SELECT chrom, s AS pos FROM f UNION SELECT chrom, size FROM chroms),
    w AS (SELECT chrom, coalesce(lag(pos) OVER (PARTITION BY chrom ORDER BY pos), 0) AS a, pos FROM p) SELECT chrom, a AS start, pos AS "end" FROM w WHERE pos - a > 1000""")
def _(spark, d):
    return X.probe_gaps(P.features(spark, d), P.chroms(spark), 1000)


# ---- iterated scores ------------------------------------------------------------------


@query("crosstab", with_("it") + " SELECT id, " + ", ".join(f'max(CASE WHEN iteration = {i} THEN score END) AS "I{i}"' for i in ITERATIONS) + " FROM it GROUP BY id")
def _(spark, d):
    return crosstab(P.iterated(spark, d), ITERATIONS)


@query("uncrosstab", with_("it") + f" , ids AS (SELECT DISTINCT id FROM it) SELECT ids.id, i::INTEGER AS iteration, max(score) AS score FROM ids CROSS JOIN range(-1, 19) t(i) LEFT JOIN it ON it.id = ids.id AND it.iteration = i GROUP BY ALL")
def _(spark, d):
    return uncrosstab(crosstab(P.iterated(spark, d), ITERATIONS), ITERATIONS)


for _how, _agg in {
    "AVERAGE": "avg(score)", "SUM": "sum(score)", "COUNT": "CAST(sum(CASE WHEN score <> 0 THEN 1 ELSE 0 END) AS DOUBLE)", "MEDIAN": "median(score)", "MIN": "min(score)", "MAX": "max(score)",
    "WEIGHTED": "sum(length * score) / sum(length)", "WEIGHTED5": "sum(bed_score * score) / sum(bed_score)",
}.items():

    @query(f"iteration_{_how.lower()}", with_("it") + f" SELECT iteration, round({_agg}, 6) AS value FROM it GROUP BY iteration")
    def _(spark, d, how=_how):
        return rounded(S.aggregate_iterations(P.iterated(spark, d), how), "value")


@query("iteration_tail_p", with_("it") + """, v AS (SELECT iteration, avg(score) AS v FROM it GROUP BY iteration), a AS (SELECT v AS a FROM v WHERE iteration = -1)
    SELECT round(any_value(a), 6) AS actual, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, count(*) AS n,
    round(least(count(*) FILTER (v <= a), count(*) FILTER (v >= a)) / count(*), 6) AS p FROM v, a WHERE iteration >= 0""")
def _(spark, d):
    return rounded(S.tail_p(S.aggregate_iterations(P.iterated(spark, d))), "actual", "mean", "sd", "p")


_QUANT = with_("it") + """, a AS (SELECT id, max(score) FILTER (iteration = -1) AS actual FROM it GROUP BY id),
    q AS (SELECT id, actual, count(*) AS n, median(score) AS median, min(score) AS low, max(score) AS high,
          (count(*) FILTER (score < actual) + count(*) FILTER (score = actual) / 2.0) / count(*) AS quantile FROM it JOIN a USING (id) WHERE iteration >= 0 GROUP BY id, actual)"""


@query("feature_quantile", _QUANT + " SELECT id, actual, n, round(median, 6) AS median, low, high, round(quantile, 6) AS quantile FROM q")
def _(spark, d):
    return rounded(S.feature_quantile(P.iterated(spark, d)), "median", "quantile")


@query("percentile_ranks", with_("it") + " SELECT id, iteration, round((rank() OVER (ORDER BY score) - 1 + count(*) OVER (PARTITION BY score) / 2.0) / count(*) OVER () * 100, 6) AS percentile FROM it")
def _(spark, d):
    return rounded(S.mid_rank_percentile(P.iterated(spark, d), "score"), "percentile").select("id", "iteration", "percentile")


@query("by_score_strata", with_("it") + """, b AS (SELECT *, printf('%.4f', least(greatest(round_even(bed_score / 10, 0) * 10, 10), 60)) AS stratum FROM it)
    SELECT stratum, iteration, count(*) AS n, round(avg(score), 6) AS value FROM b GROUP BY ALL
    UNION ALL SELECT 'high', iteration, count(*), round(avg(score), 6) FROM it WHERE bed_score >= 30 AND bed_score < 50 GROUP BY ALL""")
def _(spark, d):
    return rounded(S.by_score(P.iterated(spark, d), stratum=10.0, low=10.0, high=60.0, groups=[("high", "between", 30.0, 50.0)]), "value")


@query("relate_bins", with_("it") + " SELECT round_even(bed_score / 5, 0) * 5 AS x, count(*) AS n, round(avg(score), 6) AS mean, round(median(score), 6) AS median, round(quantile_cont(score, 0.05), 6) AS q05, round(quantile_cont(score, 0.95), 6) AS q95 FROM it GROUP BY ALL")
def _(spark, d):
    return rounded(S.relate(P.iterated(spark, d), "bed_score", "score", 5.0), "mean", "median", "q05", "q95")


@query("frequency_hist", with_("it") + """, v AS (SELECT iteration, avg(score) AS v FROM it WHERE iteration >= 0 GROUP BY iteration), w AS (SELECT (max(v) - min(v)) / 50 AS w FROM v),
    h AS (SELECT floor(v / w + 0.5) * w AS x, count(*) AS n FROM v, w GROUP BY 1)
    SELECT round(x, 6) AS x, n, round(sum(n) OVER (ORDER BY x) / sum(n) OVER (), 6) AS at_most, round(sum(n) OVER (ORDER BY x DESC) / sum(n) OVER (), 6) AS at_least FROM h""")
def _(spark, d):
    return rounded(S.frequency(S.aggregate_iterations(P.iterated(spark, d))), "x", "at_most", "at_least")


def _distribution_sql(rows: str, size: str) -> str:
    return with_("it") + f""", q0 AS (SELECT id, max(score) FILTER (iteration = -1) AS actual, median(score) FILTER (iteration >= 0) AS sim FROM it GROUP BY id), v AS ({rows}),
        h AS (SELECT series, round_even(v / {size}, 0) * {size} + 0.0 AS x, count(*) AS n FROM v GROUP BY ALL) SELECT series, x, n, round(n / sum(n) OVER (PARTITION BY series), 6) AS share FROM h"""


_OWN = "SELECT 'actual' AS series, actual AS v FROM q0"
for _kind, (_rows, _size) in {
    "unpaired_all": (f"{_OWN} UNION ALL SELECT 'simulated', score FROM it WHERE iteration >= 0", 20.0),
    "unpaired_agg": (f"{_OWN} UNION ALL SELECT 'simulated', sim FROM q0", 20.0),
    "paired_all": ("SELECT 'delta' AS series, actual - score AS v FROM it JOIN q0 USING (id) WHERE iteration >= 0", 20.0),
    "paired_agg": ("SELECT 'delta' AS series, actual - sim AS v FROM q0", 20.0),
    "percentile": ("SELECT 'percentile' AS series, round_even((count(*) FILTER (score < actual) + count(*) FILTER (score = actual) / 2.0) / count(*) * 100, 0) AS v FROM it JOIN q0 USING (id) WHERE iteration >= 0 GROUP BY id", 5.0),
}.items():

    @query("distribution_paired" if _kind == "paired_all" else f"distribution_{_kind}", _distribution_sql(_rows, str(_size)))
    def _(spark, d, kind=_kind, size=_size):
        out = S.distribution(P.iterated(spark, d), kind, bin_size=size, how="MEDIAN")
        return rounded(out.withColumn("x", F.col("x") + 0.0), "share")


@query("relate_iterations", with_("it") + """, e AS (SELECT round_even(bed_score / 5, 0) * 5 AS x, iteration, avg(score) AS m, median(score) AS d FROM it WHERE iteration >= 0 GROUP BY ALL)
    SELECT x, round(avg(m), 6) AS mean_mean, round(median(d), 6) AS median_median, round(quantile_cont(d, 0.05), 6) AS median_q05, round(quantile_cont(d, 0.95), 6) AS median_q95 FROM e GROUP BY x""")
def _(spark, d):
    return rounded(S.relate_iterations(P.iterated(spark, d), "bed_score", "score", 5.0), "mean_mean", "median_median", "median_q05", "median_q95")


@query("aggregate_summary", _QUANT + """, w AS (SELECT iteration, avg(score) AS v FROM it GROUP BY iteration), z AS (SELECT v AS a FROM w WHERE iteration = -1),
    t AS (SELECT any_value(a) AS actual, avg(v) AS mean, stddev_samp(v) AS sd, count(*) AS n_iterations, least(count(*) FILTER (v <= a), count(*) FILTER (v >= a)) / count(*) AS tail_p FROM w, z WHERE iteration >= 0)
    SELECT round(any_value(t.actual), 6) AS actual, round(any_value(t.mean), 6) AS mean, round(any_value(sd), 6) AS sd, any_value(n_iterations) AS n_iterations, round(any_value(tail_p), 6) AS tail_p,
    count(*) AS n_features, round(avg(quantile), 6) AS mean_quantile FROM q, t""")
def _(spark, d):
    out = S.aggregate(P.iterated(spark, d)).drop("gaussian_p", "sign_p", "rank_p")
    return rounded(out, "actual", "mean", "sd", "tail_p", "mean_quantile")


@query("aggregate_tests")
def _(spark, d):
    """The p values of the summary: Gaussian, sign and signed rank."""
    return S.aggregate(P.iterated(spark, d)).select("gaussian_p", "sign_p", "rank_p")


@query("strata_rank_sums", with_("it") + """, a AS (SELECT id % 2 AS g, score FROM it WHERE iteration = -1), r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS k FROM a),
    u AS (SELECT count(*) AS t FROM a GROUP BY score), s AS (SELECT count(*) FILTER (g = 0) AS n, count(*) FILTER (g = 1) AS m, sum(k) FILTER (g = 0) AS ranks FROM r), v AS (SELECT sum(1.0 * t * t * t - t) AS ties FROM u),
    w AS (SELECT *, ranks - n * (n + 1) / 2.0 - n * m / 2.0 AS z0, sqrt(n * m / 12.0 * ((n + m + 1) - ties / (1.0 * (n + m) * (n + m - 1)))) AS sd FROM s, v)
    SELECT n, m, CAST(ranks AS DOUBLE) AS ranks, CAST(ties AS DOUBLE) AS ties, round((z0 - sign(z0) * 0.5) / sd, 6) AS z FROM w""")
def _(spark, d):
    own = P.iterated(spark, d).where("iteration = -1").select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("stratum"), "score")
    return rounded(S.rank_sums(own, "a", "b"), "z")


@query("strata_table")
def _(spark, d):
    it = P.iterated(spark, d)
    strata = it.select("id").distinct().select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("stratum"), "id")
    return S.strata_table(it, [("s0", "s1"), ("s1", "s2")], strata)


@query("mask_and_log", with_("it") + " SELECT id, iteration, CASE WHEN score > 100 THEN round(log10(score), 6) END AS score, CASE WHEN score > 100 THEN round(log10(score), 6) ELSE 0 END AS masked FROM it")
def _(spark, d):
    it = P.iterated(spark, d).select("id", "iteration", F.when(F.col("score") > 100, F.col("score")).otherwise(0.0).alias("score"))
    out = S.apply_log10(it)
    return rounded(S.mask_null(out.withColumn("masked", F.col("score")), score="masked"), "score", "masked")


@query("crosstab_places", with_("it", "iv") + """ SELECT iv.chrom, iv.s AS start, iv.e AS "end", iv.name, max(CASE WHEN iteration = -1 THEN it.score END) AS "I-1", max(CASE WHEN iteration = 18 THEN it.score END) AS "I18"
    FROM it JOIN iv ON iv.event_id = it.id GROUP BY ALL""")
def _(spark, d):
    own = P.intervals(spark, d).withColumn("id", F.col("event_id"))
    return with_places(crosstab(P.iterated(spark, d), ITERATIONS), own).select("chrom", "start", "end", "name", "I-1", "I18")


@query("cdf_points", with_("it") + """ SELECT DISTINCT id, score, round(cume_dist() OVER (PARTITION BY id ORDER BY score), 6) AS share,
    round((rank() OVER (PARTITION BY id ORDER BY score) - 1 + count(*) OVER (PARTITION BY id, score) / 2.0) / count(*) OVER (PARTITION BY id), 6) AS mid FROM it WHERE iteration >= 0""")
def _(spark, d):
    return rounded(S.cdf_points(P.iterated(spark, d)), "share", "mid")


@query("shapiro")
def _(spark, d):
    return rounded(S.normality(P.iterated(spark, d)), "p", "p_log")


# ---- correlation ----------------------------------------------------------------------


def _pearson_sql(w: str, compat: bool = False) -> str:
    hx, hy = ("has_x", "has_y") if compat else ("TRUE", "TRUE")
    return with_("al") + f""", a AS (SELECT *, CAST({w} AS DOUBLE) AS w FROM al), m AS (SELECT count(*) AS n, sum(w) AS weight, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM a),
    v AS (SELECT any_value(n) AS n, any_value(weight) AS weight, any_value(mx) AS mean_x, any_value(my) AS mean_y,
        sqrt(sum(w * (x - mx) ** 2) FILTER ({hx}) / (any_value(weight) - 1)) AS sd_x, sqrt(sum(w * (y - my) ** 2) FILTER ({hy}) / (any_value(weight) - 1)) AS sd_y,
        sum(w * (x - mx) * (y - my)) / (any_value(weight) - 1) AS cov FROM a, m)
    SELECT n, weight, round(mean_x, 6) AS mean_x, round(mean_y, 6) AS mean_y, round(sd_x, 6) AS sd_x, round(sd_y, 6) AS sd_y, round(cov, 6) AS cov, round(cov / (sd_x * sd_y), 6) AS r FROM v"""


_P = ("mean_x", "mean_y", "sd_x", "sd_y", "cov", "r")


@query("correlate_pearson", _pearson_sql("1"))
def _(spark, d):
    return rounded(C.pearson(C.align_samples(P.two_samples(spark, d), "a", "b")), *_P)


@query("correlate_weighted", _pearson_sql("e - s"))
def _(spark, d):
    return rounded(C.pearson(C.align_samples(P.two_samples(spark, d), "a", "b"), weighted=True), *_P)


@query("correlate_compat", _pearson_sql("1", True))
def _(spark, d):
    return rounded(C.pearson(C.align_samples(P.two_samples(spark, d), "a", "b"), compat=True), *_P)


@query("correlate_spearman", with_("al") + """, k AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM al)
    SELECT count(*) AS n, round(corr(rx, ry), 6) AS r FROM k""")
def _(spark, d):
    return rounded(C.spearman(C.align_samples(P.two_samples(spark, d), "a", "b")), "r")


@query("regression", with_("al") + """, s AS (SELECT regr_count(y, x) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_avgx(y, x) AS mx FROM (SELECT least(x, 300) AS x, y FROM al))
    SELECT CAST(n AS BIGINT) AS n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r2, 6) AS r2, round(sqrt(syy * (1 - r2) / (n - 2) / sxx), 6) AS slope_se,
    round(sqrt(syy * (1 - r2) / (n - 2) * (1.0 / n + mx * mx / sxx)), 6) AS intercept_se FROM s""")
def _(spark, d):
    return rounded(C.regression(C.align_samples(P.two_samples(spark, d), "a", "b"), "x", "y", cap_x=300.0), "slope", "intercept", "r2", "slope_se", "intercept_se")


# ---- simulation -----------------------------------------------------------------------


def _named(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id").cast("string").alias("id"), "chrom", "start", "end", "score", "strand")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten seeded simulations of the features, scored against the references, as quantiles by feature."""
    features, refs, chroms = P.simulated(spark, sf_dir)
    return S.feature_quantile(M.simulate(_named(features), chroms, refs, iterations=10, seed=7)).orderBy("id")


def _placed(spark, d, **how):
    f, ex, chroms = P.simulated(spark, d)
    return M.permute(_named(f), chroms, iterations=10, seed=11, exclusions=ex, **how), ex, chroms


@query("permute")
def _(spark, d):
    return _placed(spark, d, offset_control=1000)[0]


@query("permute_draws", f"""WITH k AS (SELECT greatest(1, ceil(count(*) / 1000.0))::BIGINT AS k FROM events), gv AS (SELECT event_id, 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % (500000 * k) AS s,
    1 + CAST(floor(value * 4) AS BIGINT) AS n, CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand, 600000 * k AS size FROM events, k),
    d AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', '5', i, event_id || '|' || chrom || '|' || s || '|' || (s + n) || '|' || strand || '|1', a)), 1, 15)) AS BIGINT) % (5 * size) AS x FROM gv, range(0, 2) t(i), range(0, 60) u(a)),
    f AS (SELECT * FROM d WHERE x % size + n <= size QUALIFY row_number() OVER (PARTITION BY i, event_id ORDER BY a) = 1)
    SELECT CAST(i AS INTEGER) AS iteration, CAST(event_id AS VARCHAR) AS id, 'chr' || (x // size + 1) AS chrom, x % size AS start, x % size + n AS "end" FROM f""")
def _(spark, d):
    """Placements that may meet: each feature's first draw that fits its chromosome."""
    f, chroms = P.grown(spark, d)
    return M.permute(_named(f), chroms, iterations=2, seed=5, max_overlap=1.0).where("iteration >= 0").select("iteration", "id", "chrom", "start", "end")


@query("permute_lengths", with_("f") + ", n AS (SELECT e - s AS length, count(*) AS c FROM f GROUP BY 1) SELECT CAST(i AS INTEGER) AS iteration, length, c AS n FROM n, range(-1, 10) t(i)")
def _(spark, d):
    placed = _placed(spark, d)[0]
    return placed.groupBy("iteration", (F.col("end") - F.col("start")).alias("length")).agg(F.count("*").alias("n"))


@query("permute_collapsed", with_("f") + ", n AS (SELECT count(*) AS n FROM f) SELECT CAST(i AS INTEGER) AS iteration, CAST(n AS DOUBLE) AS n FROM n, range(-1, 10) t(i)")
def _(spark, d):
    """All features of an iteration stand in its padded, merged regions."""
    regions = M.collapsed(_placed(spark, d)[0], padding=100, unpadded=True)
    return regions.groupBy("iteration").agg(F.sum("score").alias("n"))


@query("permute_rules", with_("f") + """, n AS (SELECT count(*) AS n FROM f) SELECT CAST(i AS INTEGER) AS iteration, n AS inside, n AS clear, n AS apart FROM n, range(0, 10) t(i)""")
def _(spark, d):
    """How many placements of each iteration lie inside a chromosome, off the exclusions, and apart from the others: all."""
    placed, ex, chroms = _placed(spark, d)
    return M.rules_kept(placed.where("iteration >= 0"), chroms, ex)


@query("simulate")
def _(spark, d):
    return flagship(spark, d)


_GROWN = """k AS (SELECT greatest(1, ceil(count(*) / 1000.0))::BIGINT AS k FROM events), gv AS (SELECT event_id, 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % (500000 * k) AS s,
    (event_id * 7919) % (500000 * k) + 1 + CAST(floor(value * 4) AS BIGINT) AS e FROM events, k), gf AS (SELECT * FROM gv WHERE event_id % 3 <> 0), gr AS (SELECT * FROM gv WHERE event_id % 3 = 0)"""


@query("simulate_actual", f"""WITH {_GROWN} SELECT CAST(gf.event_id AS VARCHAR) AS id, CAST(count(gr.s) AS DOUBLE) AS actual, 10::BIGINT AS n
    FROM gf LEFT JOIN gr ON gf.chrom = gr.chrom AND gr.s <= gf.e AND gr.e >= gf.s GROUP BY gf.event_id""")
def _(spark, d):
    """Of each feature, the actual score and how many simulations it was held against."""
    return flagship(spark, d).select("id", "actual", "n")


@query("hotspot")
def _(spark, d):
    features, chroms = P.grown(spark, d)
    return M.hotspot(_named(features).withColumn("name", F.col("id")), chroms, iterations=5, seed=3)


@query("hotspot_first", f"""WITH {_GROWN}, m AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM gv),
    g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m),
    c AS (SELECT count(*) AS n FROM g GROUP BY chrom, gid), t AS (SELECT max(n) AS most, CAST(sum(n) AS BIGINT) AS total FROM c)
    SELECT any_value(total) AS n_features, any_value(most) AS cluster_size, CAST(count(*) AS INTEGER) AS n_clusters, count(*) * any_value(most) AS n_clustered FROM c, t WHERE n = most""")
def _(spark, d):
    """The first round's clusters, of all features."""
    features, chroms = P.grown(spark, d)
    out = M.hotspot(_named(features).withColumn("name", F.col("id")), chroms, iterations=2, seed=3, rounds=1)
    return out.select("n_features", "cluster_size", "n_clusters", "n_clustered")


# ---- coverage and copy number ---------------------------------------------------------

_BREAKS = with_("fr") + """, bk AS (SELECT sample, chrom, pos, CAST(sum(d) AS INTEGER) AS delta FROM (SELECT sample, chrom, pos, 1 AS d FROM fr UNION ALL SELECT sample, chrom, pos + len, -1 FROM fr) GROUP BY ALL HAVING sum(d) <> 0)"""
_WEIGHTS = _BREAKS + """, sg AS (SELECT sample, chrom, pos AS s, lead(pos) OVER w AS e, sum(delta) OVER w AS cov FROM bk WINDOW w AS (PARTITION BY sample, chrom ORDER BY pos)),
    ln AS (SELECT sample, floor(avg(len) + 0.5) AS avg_len FROM fr GROUP BY sample),
    bn AS (SELECT 'chr' || c AS chrom, b AS bin, b * 10000 AS s, b * 10000 + 10000 AS e FROM range(1, 6) t(c), range(0, 60) u(b)),
    raw AS (SELECT bn.chrom, bin, sample, floor(sum(cov * (least(sg.e, bn.e) - greatest(sg.s, bn.s))) / any_value(avg_len) * 1000 + 0.5) / 1000 AS raw FROM sg JOIN bn ON sg.chrom = bn.chrom AND sg.s < bn.e AND sg.e > bn.s AND cov > 0 JOIN ln USING (sample) GROUP BY ALL)"""


@query("break_map", _BREAKS + " SELECT * FROM bk")
def _(spark, d):
    return V.break_map(P.fragments(spark, d))


@query("fragment_stats", with_("fr") + """ SELECT sample, chrom, count(*) AS n_frags, CAST(sum(len) AS BIGINT) AS sum_len, 600000::BIGINT AS chrom_len, CAST(floor(avg(len) + 0.5) AS BIGINT) AS avg_len, floor(sum(len) / 600000.0 * 10 + 0.5) / 10 AS coverage FROM fr GROUP BY ALL""")
def _(spark, d):
    return V.fragment_stats(P.fragments(spark, d), P.chroms(spark))


def _lengths(fr: DataFrame) -> DataFrame:
    return fr.groupBy("sample").agg(F.floor(F.avg("len") + 0.5).cast("double").alias("avg_len"))


def _raw(spark, d) -> tuple[DataFrame, DataFrame]:
    fr, bins = P.fragments(spark, d), P.fixed_bins(spark)
    return B.bin_weights(V.break_map(fr), bins, _lengths(fr)), bins


@query("bin_weights", _WEIGHTS + " SELECT chrom, bin, sample, raw FROM raw")
def _(spark, d):
    return _raw(spark, d)[0]


@query("norm_median", _WEIGHTS + """, tt AS (SELECT sample, sum(raw) AS t FROM raw GROUP BY sample), wt AS (SELECT sample, t / (SELECT median(t) FROM tt) AS weight FROM tt),
    nm AS (SELECT chrom, bin, sample, raw / weight AS norm FROM raw JOIN wt USING (sample)), md AS (SELECT chrom, bin, floor(median(norm) + 0.5) AS m FROM nm GROUP BY ALL)
    SELECT chrom, bin, sample, round(norm, 6) AS norm, CASE WHEN m = 0 THEN 1.0 ELSE m END AS med_cov, CAST(floor(10000 / ((CASE WHEN m = 0 THEN 1.0 ELSE m END) / 50.0) + 0.5) AS BIGINT) AS adj_len FROM nm JOIN md USING (chrom, bin)""")
def _(spark, d):
    raw, bins = _raw(spark, d)
    n = B.normalise(raw, bins.withColumn("no_gap_len", F.col("end") - F.col("start") + 1), bin_count=50.0)
    return rounded(n, "norm").select("chrom", "bin", "sample", "norm", "med_cov", "adj_len")


@query("correct_for_gaps", _collapse_sql() + """, bn AS (SELECT 'chr' || q AS chrom, b AS bin, b * 10000 AS s, b * 10000 + 9999 AS e FROM range(1, 6) t(q), range(0, 60) u(b))
    SELECT bn.chrom, bin, 10000::BIGINT AS length, CAST(10000 - coalesce(sum(least(bn.e + 1, c.e) - greatest(bn.s, c.s)) FILTER (c.s IS NOT NULL), 0) AS BIGINT) AS no_gap_len
    FROM bn LEFT JOIN c ON bn.chrom = c.chrom AND c.s < bn.e + 1 AND c.e > bn.s GROUP BY bn.chrom, bin""")
def _(spark, d):
    gaps = I.collapse(P.intervals(spark, d), names=False)
    return B.correct_for_gaps(P.fixed_bins(spark), gaps).select("chrom", "bin", "length", "no_gap_len")


_WALK = """, mg AS (SELECT chrom, pos, sum(x) AS x FROM (SELECT chrom, pos, delta / avg_len AS x FROM bk JOIN (SELECT sample, floor(avg(len) + 0.5) AS avg_len FROM fr GROUP BY sample) USING (sample) UNION ALL SELECT DISTINCT chrom, 0, 0.0 FROM bk) GROUP BY ALL),
    lv AS (SELECT chrom, pos, sum(x) OVER w AS level, lead(pos) OVER w - pos AS n FROM mg WINDOW w AS (PARTITION BY chrom ORDER BY pos)),
    li AS (SELECT chrom, pos, level, coalesce(sum(level * n) OVER (PARTITION BY chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS total FROM lv),
    ar AS (SELECT chrom, list(pos ORDER BY pos) AS p, list(level ORDER BY pos) AS l, list(total ORDER BY pos) AS t FROM li GROUP BY chrom),
    w AS (SELECT chrom, target, 0::BIGINT AS n, 0::BIGINT AS s FROM ar, targets UNION ALL SELECT chrom, target, n + 1, e + 1 FROM step WHERE e IS NOT NULL)"""
_STEP = """SELECT chrom, target, n, s, CASE WHEN k <= len(t) THEN CAST(trunc(p[k] - (t[k] - goal) / l[k - 1] - 0.5) AS BIGINT) END AS e FROM (
    SELECT *, len([1 FOR y IN t IF y < goal]) + 1 AS k FROM (SELECT *, t[i] + (s - p[i]) * l[i] + target AS goal FROM (
        SELECT chrom, target, n, s, p, l, t, len([1 FOR y IN p IF y <= s]) AS i FROM w JOIN ar USING (chrom))))"""


def _bins_sql(targets: str) -> str:
    """Bins of each target by a recursion from bin to bin, over the cumulative line as lists."""
    return _BREAKS.replace("WITH ", "WITH RECURSIVE ", 1) + f", targets AS ({targets})" + _WALK.replace("FROM step", f"FROM ({_STEP})") + (
        f", bins AS (SELECT chrom, target, n AS bin, s AS start, coalesce(e, 600000) AS stop FROM ({_STEP}) WHERE e IS NOT NULL OR s <= 600000)"
    )


@query("bin_ends", _bins_sql("SELECT 60.0::DOUBLE AS target") + ' SELECT chrom, bin, start, stop AS "end" FROM bins')
def _(spark, d):
    fr = P.fragments(spark, d)
    return B.bin_ends(V.break_map(fr), P.chroms(spark), _lengths(fr), bin_count=20.0, n_samples=3)


_COUNTS = list(range(25, 425, 25))
_CANDIDATES = _bins_sql(f"SELECT unnest({_COUNTS})::BIGINT AS vbc, floor(vbc / 3.0 + 0.5) * 3 AS target") + """, sz AS (SELECT vbc, stop - start + 1 - coalesce((SELECT sum(least(stop + 1, g.e) - greatest(start, g.s)) FROM gaps g WHERE g.chrom = bins.chrom AND g.s < stop + 1 AND g.e > start), 0) AS v
        FROM bins JOIN targets USING (target) WHERE chrom = 'chr2' AND start >= 1000 AND stop <= 480000),
    pk AS (SELECT vbc, v FROM sz JOIN (SELECT vbc, median(v) AS mid FROM sz GROUP BY vbc) USING (vbc) WHERE v BETWEEN mid - mid / 2 AND mid + mid / 2),
    cd AS (SELECT vbc AS count, median(v) AS median, avg(v) AS mean, stddev_samp(v) AS sd FROM pk GROUP BY vbc)"""
_CANDIDATES = _CANDIDATES.replace(", targets AS (", ", gaps AS (SELECT chrom, s, e FROM (SELECT 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % 500000 AS s, (event_id * 7919) % 500000 + 3 AS e FROM events WHERE event_id % 5 = 0)), targets AS (", 1)


def _candidates(spark, d) -> DataFrame:
    """All nominal counts on one chromosome, with short gaps."""
    fr = P.fragments(spark, d)
    start = (F.col("event_id") * 7919) % 500000
    gaps = P.intervals(spark, d).where("event_id % 5 = 0").select("chrom", start.alias("start"), (start + 3).alias("end"))
    return B.candidate_counts(B.cumulative_line(V.break_map(fr), _lengths(fr)), P.chroms(spark), ("chr2", 1000, 480000), _COUNTS, n_samples=3, gaps=gaps)


@query("bin_count_candidates", _CANDIDATES + " SELECT count, round(median, 6) AS median, round(mean, 6) AS mean, round(sd, 6) AS sd FROM cd")
def _(spark, d):
    return rounded(_candidates(spark, d).withColumn("count", F.col("count").cast("long")), "median", "mean", "sd")


@query("bin_count", _CANDIDATES + " SELECT count, round(mean, 6) AS mean FROM cd WHERE mean - 1.25 * sd > 2.0 / 3 * (mean + 1.25 * sd) ORDER BY count LIMIT 1")
def _(spark, d):
    return rounded(B.pick_bin_count(_candidates(spark, d)).select(F.col("count").cast("long").alias("count"), "mean"), "mean")


@query("reference_stats", with_("iv") + """, o AS (SELECT e - s AS v FROM iv WHERE chrom = 'chr2' AND s >= 10000 AND e <= 400000), m AS (SELECT median(v) AS mid FROM o)
    SELECT round(median(v), 6) AS median, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd FROM o, m WHERE v >= mid - mid / 2 AND v <= mid + mid / 2""")
def _(spark, d):
    return rounded(B.reference_stats(P.intervals(spark, d).withColumn("no_gap_len", F.col("end") - F.col("start")), "chr2", 10000, 400000), "median", "mean", "sd")


_STATS = with_("iv") + """, p AS (SELECT iv.chrom, cn, e - s AS v FROM iv, range(1, 4) t(cn)),
    k AS (SELECT chrom, cn, count(*) AS n, median(v) AS median, avg(v) AS mean, stddev_samp(v) AS sd FROM p WHERE v BETWEEN {k} * (200 - 2.5 * 30) AND {k} * (200 + 2.5 * 30) GROUP BY ALL),
    b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY n DESC, cn) = 1)
    SELECT c.chrom, CASE WHEN n > 100 THEN round(median, 6) ELSE 0 END::DOUBLE AS median, CASE WHEN n > 100 THEN round(mean, 6) ELSE 0 END::DOUBLE AS mean, CASE WHEN n > 100 THEN round(sd, 6) ELSE 0 END::DOUBLE AS sd FROM (SELECT DISTINCT chrom FROM iv) c LEFT JOIN b USING (chrom)"""
for _name, _compat in (("bin_stats", False), ("bin_stats_compat", True)):

    @query(_name, _STATS.replace("{k}", "1.0" if _compat else "(2.0 / cn)"))
    def _(spark, d, compat=_compat):
        bins = P.intervals(spark, d).withColumn("adj_len", F.col("end") - F.col("start"))
        return rounded(B.bin_stats(bins, mean=200.0, sd=30.0, compat=compat), "median", "mean", "sd")


@query("viterbi_cn")
def _(spark, d):
    raw, bins = _raw(spark, d)
    n = B.normalise(raw, bins.withColumn("no_gap_len", F.col("end") - F.col("start") + 1), bin_count=50.0)
    one = n.select("chrom", "bin", "adj_len").distinct()
    m = one.agg(F.avg("adj_len").alias("m"), F.stddev_samp("adj_len").alias("s")).first()
    return B.copy_number(one, mean=m["m"], sd=max(m["s"], 1.0))


def _changes_sql() -> str:
    """The path by a recursion over bins that carries the best score and path of each state."""
    moves = "[sc[a] + CASE WHEN a = b THEN ln(0.95) ELSE ln(0.05 / 4) END FOR a IN range(1, 6)]"
    return _WEIGHTS.replace("WITH ", "WITH RECURSIVE ", 1) + f""", tt AS (SELECT sample, sum(raw) AS t FROM raw GROUP BY sample), wt AS (SELECT sample, t / (SELECT median(t) FROM tt) AS weight FROM tt),
        md AS (SELECT chrom, bin, CASE WHEN floor(median(raw / weight) + 0.5) = 0 THEN 1.0 ELSE floor(median(raw / weight) + 0.5) END AS m FROM raw JOIN wt USING (sample) GROUP BY ALL),
        o AS (SELECT chrom, sample, bin, row_number() OVER (PARTITION BY chrom, sample ORDER BY bin) AS i, round_even(raw, 0) AS x, weight * m / 2 AS one FROM raw JOIN wt USING (sample) JOIN md USING (chrom, bin)),
        em AS (SELECT chrom, sample, bin, i, [greatest(x * ln(mu) - mu - lgamma(x + 1), ln(1e-300)) FOR mu IN [0.05 * one + 1, one, one * 2, one * 3, one * 4]] AS e FROM o),
        v AS (SELECT chrom, sample, i, [y - ln(5) FOR y IN e] AS sc, ['1', '2', '3', '4', '5'] AS path FROM em WHERE i = 1
            UNION ALL SELECT chrom, sample, i, [list_max(ways[b]) + e[b] FOR b IN range(1, 6)], [path[list_position(ways[b], list_max(ways[b]))] || b FOR b IN range(1, 6)]
            FROM (SELECT em.chrom, em.sample, em.i, e, path, [{moves} FOR b IN range(1, 6)] AS ways FROM v JOIN em ON em.chrom = v.chrom AND em.sample = v.sample AND em.i = v.i + 1)),
        last AS (SELECT chrom, sample, path[list_position(sc, list_max(sc))] AS path FROM v QUALIFY row_number() OVER (PARTITION BY chrom, sample ORDER BY i DESC) = 1)
        SELECT chrom, bin, sample, CAST(CAST(path[i] AS INTEGER) - 3 AS INTEGER) AS dcn FROM last JOIN em USING (chrom, sample)"""


@query("copy_changes", _changes_sql())
def _(spark, d):
    raw, bins = _raw(spark, d)
    n = B.normalise(raw, bins.withColumn("no_gap_len", F.col("end") - F.col("start") + 1), bin_count=50.0)
    return B.copy_changes(n.withColumn("cn", F.lit(2)))


_CHANGES = """ch AS (SELECT 's' || (event_id % 3) AS sample, 'chr' || ((event_id // 3) % 5 + 1) AS chrom, event_id // 15 AS bin, (event_id // 15) * 10 AS s, (event_id // 15) * 10 + 9 AS e, CASE WHEN value > 60 THEN 1 WHEN value < 20 THEN -1 ELSE 0 END AS dcn, value / 10 AS dcn_raw FROM events)"""


@query("cnv_runs", f"WITH {_CHANGES}" + """, k AS (SELECT *, bin - row_number() OVER (PARTITION BY sample, chrom, dcn ORDER BY bin) AS g FROM ch)
    SELECT sample, chrom, min(s) AS start, max(e) AS "end", count(*) AS n_bins, CAST(dcn AS INTEGER) AS sign, round(avg(dcn_raw), 6) AS mean_dcn FROM k WHERE dcn <> 0 GROUP BY sample, chrom, dcn, g HAVING count(*) > 2""")
def _(spark, d):
    ev = P.table(spark, d, "events")
    bin_ = F.floor(F.col("event_id") / 15)
    ch = ev.select(
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("sample"), F.concat(F.lit("chr"), (F.floor(F.col("event_id") / 3) % 5 + 1).cast("string")).alias("chrom"),
        bin_.alias("bin"), (bin_ * 10).alias("start"), (bin_ * 10 + 9).alias("end"), F.when(F.col("value") > 60, 1).when(F.col("value") < 20, -1).otherwise(0).alias("dcn"), (F.col("value") / 10).alias("dcn_raw"),
    )
    return rounded(B.cnv_runs(ch, min_bins=2), "mean_dcn")


_NORM = ORACLE["norm_median"]


def _normal(spark, d):
    raw, bins = _raw(spark, d)
    return B.normalise(raw, bins.withColumn("no_gap_len", F.col("end") - F.col("start") + 1), bin_count=50.0)


@query("plot_values", _NORM.replace("SELECT chrom, bin, sample, round(norm, 6) AS norm", "SELECT chrom, bin, sample, norm").join(("WITH pv AS (", """), c AS (SELECT *, floor(9000.0 / adj_len * 2 * 100 + 0.5) / 100 AS cn_raw FROM pv),
    y AS (SELECT *, (norm - med_cov) / med_cov * cn_raw * 100 + 0.5 AS y FROM c) SELECT chrom, bin, sample, cn_raw, round(CASE WHEN y < 0 THEN ceil(y) ELSE floor(y) END / 100 + 0.0, 2) AS dcn_raw FROM y""")))
def _(spark, d):
    out = B.plot_values(_normal(spark, d), ref_mean=9000.0).select("chrom", "bin", "sample", "cn_raw", "dcn_raw")
    return rounded(out, "dcn_raw", digits=2)


@query("sample_blocks", _WEIGHTS + """ SELECT chrom, bin, max(raw) FILTER (sample = 's0') AS raw_s0, max(raw) FILTER (sample = 's1') AS raw_s1, max(raw) FILTER (sample = 's2') AS raw_s2 FROM raw GROUP BY chrom, bin""")
def _(spark, d):
    return B.sample_blocks(_raw(spark, d)[0], ["s0", "s1", "s2"], ("raw",))


@query("bin_peaks", """WITH pv AS (""" + _NORM + """), b AS (SELECT DISTINCT chrom, bin, adj_len, CAST(bin % 3 AS INTEGER) AS cn FROM pv), c AS (SELECT cn, floor(adj_len / 500.0 + 0.5) * 500 AS a, count(*) AS k FROM b GROUP BY ALL),
    p AS (SELECT cn, a AS peak FROM c QUALIFY row_number() OVER (PARTITION BY cn ORDER BY k DESC, a) = 1) SELECT b.cn, count(*) AS n, round(avg(adj_len), 6) AS mean, round(stddev_samp(adj_len), 6) AS sd, any_value(peak) AS peak FROM b JOIN p USING (cn) GROUP BY b.cn""")
def _(spark, d):
    bins = _normal(spark, d).select("chrom", "bin", "adj_len", (F.col("bin") % 3).cast("int").alias("cn")).distinct()
    return rounded(B.bin_peaks(bins, width=500.0).withColumn("peak", F.col("peak").cast("double")), "mean", "sd")


@query("bin_ends_cover", "SELECT 'chr' || i AS chrom, 600001::BIGINT AS bases, 0::BIGINT AS low, 600000::BIGINT AS high FROM range(1, 6) t(i)")
def _(spark, d):
    """Bins that follow each other cover a chromosome's positions 0 to its size once."""
    b = QUERIES["bin_ends"](spark, d)
    return b.groupBy("chrom").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.min("start").alias("low"), F.max("end").alias("high"))


@query("copy_number_rows", _WEIGHTS + " SELECT chrom, bin, count(*) AS n_samples, TRUE AS in_range FROM raw GROUP BY chrom, bin")
def _(spark, d):
    """Each bin has one modal number, and each of its samples one change, within their bounds."""
    cn = QUERIES["viterbi_cn"](spark, d).where("cn between 0 and 5")
    dcn = QUERIES["copy_changes"](spark, d).groupBy("chrom", "bin").agg(F.count("*").alias("n_samples"), F.max(F.abs("dcn")).alias("most"))
    return cn.join(dcn, ["chrom", "bin"]).select("chrom", "bin", "n_samples", (F.col("most") <= 2).alias("in_range"))


_READS = """rd AS (SELECT event_id, 'chr' || (user_id % 5 + 1) AS chrom, (event_id * 7919) % 5000 AS start, (event_id * 31) % 50 AS mate_start, event_id % 32 AS flag, (event_id * 7) % 61 AS mapq, CAST(floor(value) AS BIGINT) AS quality, printf('r%010d', event_id) AS name FROM events)"""


def _reads(spark, d) -> DataFrame:
    return P.table(spark, d, "events").select(
        "event_id", F.concat(F.lit("chr"), (F.col("user_id") % 5 + 1).cast("string")).alias("chrom"), ((F.col("event_id") * 7919) % 5000).alias("start"), ((F.col("event_id") * 31) % 50).alias("mate_start"),
        (F.col("event_id") % 32).alias("flag"), ((F.col("event_id") * 7) % 61).alias("mapq"), F.floor("value").alias("quality"), F.format_string("r%010d", "event_id").alias("name"),
    )


@query("usable_reads", f"WITH {_READS} SELECT event_id FROM rd WHERE mapq >= 20 AND flag & 1 = 1 AND flag & 8 = 0 AND flag & 16 = 0")
def _(spark, d):
    return V.strand_reads(V.usable_reads(_reads(spark, d), min_mapq=20, require=1, forbid=8), "-", invert=True).select("event_id")


@query("merge_alignments", f"""WITH {_READS} SELECT event_id FROM rd WHERE flag & 4 <> 0 UNION ALL
    SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY chrom, start, mate_start, flag & 16 ORDER BY quality DESC, name) AS k FROM rd WHERE flag & 4 = 0) WHERE k = 1""")
def _(spark, d):
    r = _reads(spark, d)
    return V.merge_alignments(r.where("event_id % 2 = 0"), r.where("event_id % 2 = 1")).select("event_id")


@query("chunk_tiles_bed", _SIZES.replace("CAST(max(e) + sum(score) AS BIGINT)", "CAST(round(max(e) + sum(score)) AS BIGINT)") + """, b AS (SELECT CAST(sum(size) AS BIGINT) // 24 AS share FROM z),
    w AS (SELECT CAST(floor(share / p + 0.5) * p AS BIGINT) AS w FROM (SELECT share, CAST(10 ** greatest(0, length(CAST(share AS VARCHAR)) - 2) AS BIGINT) AS p FROM b))
    SELECT chrom, CAST(i AS INTEGER) AS chunk, CAST(i * w AS BIGINT) AS start, CAST(CASE WHEN i = n THEN size ELSE (i + 1) * w END AS BIGINT) AS "end"
    FROM (SELECT chrom, size, w, greatest(0, CAST(ceil((size - 1.1 * w) / w) AS BIGINT)) AS n FROM z, w), LATERAL (SELECT unnest(range(0, n + 1)) AS i)""")
def _(spark, d):
    """Tiles of a 24th of the bases, rounded to two digits."""
    sizes = _sizes(spark, d)
    return V.chunk_tiles(sizes, V.chunk_size(sizes.agg(F.sum("size")).first()[0], 24), half_open=True)


# ---- readers and writers --------------------------------------------------------------


@query("bed_round_trip", with_("iv") + f" SELECT chrom, {BED3}, name, score, strand FROM iv")
def _(spark, d):
    """Features written as BED files and read again."""
    path = shared_path(spark, "bed")
    R.write_bed(P.intervals(spark, d).select("chrom", "start", "end", "name", "score", "strand"), path)
    return R.read_bed(spark, path, stranded=True, allow_empty=False).drop("extra")


@query("bed_lines", with_("iv") + ' SELECT chrom, s - 10 AS start, e + 10 AS "end", name FROM iv')
def _(spark, d):
    """Lines with thousands marks, carriage returns, comments and blank names, padded at load."""
    f = P.intervals(spark, d)
    line = F.concat_ws("\t", "chrom", F.regexp_replace(F.format_number("start", 0), "x", ""), F.col("end").cast("string"), "name", F.lit("NA"), F.lit("+\r"))
    lines = f.select(line.alias("value")).unionByName(f.select(F.concat(F.lit("#"), "name").alias("value")))
    return R.parse_bed(lines, padding=10).select("chrom", "start", "end", "name")


@query("fasta_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS chrom, length(text) AS n, sha256(repeat(translate(CAST(doc_id AS VARCHAR), '0123456789', 'ACGTNACGTN'), 40)) AS seq FROM documents")
def _(spark, d):
    """Sequences written as FASTA files and read again; ``n`` is of the text they were named after."""
    docs = P.table(spark, d, "documents")
    name = F.col("doc_id").cast("string")
    seq = docs.select(name.alias("chrom"), F.repeat(F.translate(name, "0123456789", "ACGTNACGTN"), 40).alias("seq"))
    path = shared_path(spark, "fasta")
    R.to_fasta(seq).write.text(path)
    return R.read_fasta(spark, path).join(docs.select(name.alias("chrom"), F.length("text").cast("long").alias("n")), "chrom").select("chrom", "n", F.sha2("seq", 256).alias("seq"))


@query("fasta_pieces", """WITH q AS (SELECT CAST(doc_id AS VARCHAR) AS chrom, repeat(translate(CAST(doc_id AS VARCHAR), '0123456789', 'ACGTNACGTN'), 90) AS seq FROM documents),
    p AS (SELECT chrom, seq, unnest(range(0, (length(seq) - 1) // 64 + 1)) AS k FROM q) SELECT chrom, k * 64 AS start, substr(seq, CAST(k * 64 + 1 AS BIGINT), 64) AS seq FROM p""")
def _(spark, d):
    """Sequences written as FASTA files and read again as pieces of 64 bases."""
    name = F.col("doc_id").cast("string")
    path = shared_path(spark, "pieces")
    R.to_fasta(P.table(spark, d, "documents").select(name.alias("chrom"), F.repeat(F.translate(name, "0123456789", "ACGTNACGTN"), 90).alias("seq"))).write.text(path)
    return R.read_fasta_pieces(spark, path, 64)


@query("latest_stats", "SELECT user_id AS entity, event_type AS name, CAST(arg_max(event_id % 7, event_id) AS VARCHAR) AS value FROM events GROUP BY ALL HAVING arg_max(event_id % 7, event_id) <> 0")
def _(spark, d):
    e = P.table(spark, d, "events")
    value = F.when(F.col("event_id") % 7 == 0, "").otherwise((F.col("event_id") % 7).cast("string"))
    return R.latest_stats(e.select(F.col("user_id").alias("entity"), F.col("event_type").alias("name"), value.alias("value"), F.col("event_id").alias("version")))


@query("weighed_chroms", """SELECT chrom, size, CASE WHEN chrom IN ('chrX', 'chrY') THEN 1 ELSE 2 END::INTEGER AS copies FROM (SELECT CASE o_orderkey % 8 WHEN 0 THEN 'chrX' WHEN 1 THEN 'chrY' WHEN 2 THEN 'chrM' WHEN 3 THEN 'un_7' ELSE 'chr' || (o_orderkey % 20) END AS chrom, o_orderkey AS size FROM orders)
    WHERE chrom <> 'chrM' AND chrom <> 'un_7'""")
def _(spark, d):
    k = F.col("o_orderkey")
    name = F.when(k % 8 == 0, "chrX").when(k % 8 == 1, "chrY").when(k % 8 == 2, "chrM").when(k % 8 == 3, "un_7").otherwise(F.concat(F.lit("chr"), (k % 20).cast("string")))
    return R.weigh_chroms(P.table(spark, d, "orders").select(name.alias("chrom"), k.alias("size")), canonical=True)


@query("gap_rows", """SELECT 'chr' || (o_orderkey % 5) AS chrom, o_orderkey AS start, o_orderkey + 10 AS "end", o_orderstatus AS name, 10.0::DOUBLE AS score, '+' AS strand FROM orders""")
def _(spark, d):
    """A gap table mapped to BED columns by place, and by name."""
    o = P.table(spark, d, "orders").select(F.concat(F.lit("chr"), (F.col("o_orderkey") % 5).cast("string")).alias("chrom"), F.col("o_orderkey").alias("chromStart"), (F.col("o_orderkey") + 10).alias("chromEnd"), F.lit(10).alias("size"), F.col("o_orderstatus").alias("type"))
    a = G.gap_features(o.where("chromStart % 2 = 0"))
    return a.unionByName(G.map_columns(o.where("chromStart % 2 = 1"), chrom=1, start=2, end=3, name=5, score=4))


# ---- genome ---------------------------------------------------------------------------


@query("gene_spans", with_("tx") + """ SELECT gene AS name, chrom, strand, min(s) AS start, max(e) AS "end" FROM tx GROUP BY gene, chrom, strand""")
def _(spark, d):
    t = P.transcripts(spark, d).select("gene", "chrom", "strand", F.col("txStart").alias("start"), F.col("txEnd").alias("end"))
    return G.genes(t).select("name", "chrom", "strand", "start", "end")


@query("transcript_names", with_("tx") + """ SELECT chrom, min(s) AS start, max(e) AS "end", 'transcript:' || name || ';gene:' || name AS name FROM tx GROUP BY chrom, name""")
def _(spark, d):
    return G.transcript_name(P.transcripts(spark, d).withColumn("name2", F.lit(""))).select("chrom", "start", "end", "name")


@query("transcript_symbols", with_("tx") + """ SELECT chrom, min(s) AS start, max(e) AS "end", 'transcript:' || name || ';gene:' || CASE WHEN any_value(CAST(substr(name, 2) AS BIGINT)) % 3 = 0 THEN 'sym_' || name ELSE any_value(gene) END AS name FROM tx GROUP BY chrom, name""")
def _(spark, d):
    t = P.transcripts(spark, d).withColumn("name2", F.col("gene"))
    symbols = t.where(F.substring("name", 2, 20).cast("long") % 3 == 0).select("name", F.concat(F.lit("sym_"), "name").alias("symbol"))
    return G.transcript_name(t, symbols).select("chrom", "start", "end", "name")


@query("gene_span_rows", with_("tx") + """, t AS (SELECT gene, chrom, strand, name, min(s) AS s, max(e) AS e FROM tx GROUP BY ALL), m AS (SELECT *, max(e) OVER (PARTITION BY gene, chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM t),
    g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY gene, chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m),
    c AS (SELECT gene, chrom, strand, min(s) AS s, max(e) AS e FROM g GROUP BY gene, chrom, strand, gid)
    SELECT chrom, s AS start, e AS "end", CASE WHEN count(*) OVER w > 1 THEN gene || ':' || row_number() OVER (PARTITION BY gene, chrom, strand ORDER BY CAST(s AS VARCHAR)) ELSE gene END AS name, strand FROM c WINDOW w AS (PARTITION BY gene, chrom, strand)""")
def _(spark, d):
    return G.gene_span_rows(P.transcripts(spark, d)).select("chrom", "start", "end", "name", "strand")


@query("named_exon_spans", with_("tx") + """ SELECT chrom, s AS start, e AS "end", strand, min(gene) AS name FROM tx GROUP BY ALL""")
def _(spark, d):
    """Spans of exons with their genes' names, which here are one for each span."""
    return G.named_spans(P.transcripts(spark, d))


@query("genome_counts", with_("tx") + """, t AS (SELECT name, any_value(gene) AS gene, max(e) - min(s) AS n FROM tx GROUP BY name) SELECT 5::BIGINT AS n_chromosomes, 3000000::BIGINT AS n_bases, count(*) AS n_transcripts, count(DISTINCT gene) AS n_genes, CAST(sum(n) AS BIGINT) AS transcript_bases FROM t""")
def _(spark, d):
    return G.genome_stats(G.canonical_sizes(P.chroms(spark)), P.transcripts(spark, d))


@query("ignored_chroms", with_("iv") + " SELECT event_id FROM iv WHERE chrom NOT IN ('chr2', 'chr4')")
def _(spark, d):
    return G.ignore_chroms(P.intervals(spark, d), "2, chr4", suffixes=True).select("event_id")


@query("segment_map_cover", with_("tx") + """, t AS (SELECT chrom, name, min(s) AS s, max(e) AS e FROM tx GROUP BY ALL), m AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM t),
    g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m)
    SELECT chrom, CAST(sum(n) AS BIGINT) AS bases, CAST(sum(n) AS BIGINT) AS covered, 0::BIGINT AS unmerged FROM (SELECT chrom, max(e) - min(s) AS n FROM g GROUP BY chrom, gid) GROUP BY ALL""")
def _(spark, d):
    """The stretches of the map, of both strands, cover all transcripts' spans once, and none could be merged with the one before."""
    m = I.with_previous(G.segment_map(P.transcripts(spark, d)), ["chrom", "strand"], "start", ["end", "name", "feature", "splice", "gene_length"])
    same = F.struct("name", "feature", "splice", "gene_length") == F.struct("previous.name", "previous.feature", "previous.splice", "previous.gene_length")
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce("previous.end", F.lit(0))))
    return m.groupBy("chrom").agg(
        F.sum(F.col("end") - F.col("start")).alias("bases"), F.sum(new).alias("covered"), F.count_if((F.col("previous.end") == F.col("start")) & same).alias("unmerged"),
    )


@query("split_lengths", with_("iv") + """, w AS (SELECT greatest(1, floor((max(e - s) - min(e - s)) / 100.0 + 0.5)) AS w FROM iv) SELECT CAST(floor((e - s) / w + 0.5) * w AS BIGINT) AS length, count(*) AS n FROM iv, w GROUP BY 1""")
def _(spark, d):
    return G.split_histogram(P.intervals(spark, d)).withColumn("length", F.col("length").cast("long"))


@query("exon_rows", with_("tx") + """ SELECT gene, chrom, strand, s AS start, e AS "end" FROM tx""")
def _(spark, d):
    return G.exon_rows(P.transcripts(spark, d))


@query("segment_map")
def _(spark, d):
    return G.segment_map(P.transcripts(spark, d))


@query("motif_bins", with_("sq") + """, b AS (SELECT chrom, seq, unnest(range(0, (length(seq) - 1) // 500 + 1)) AS i FROM sq WHERE length(seq) > 0)
    SELECT chrom, CAST(i * 500 AS BIGINT) AS start, CAST(i * 500 + 500 AS BIGINT) AS "end",
    floor(len(regexp_extract_all(substring(seq, greatest(0, i * 500 - 2) + 1, CAST(i * 500 + 500 - greatest(0, i * 500 - 2) AS BIGINT)), 'TH(E|A)')) / 500.0 * 10000 + 0.5) / 10000 AS score FROM b""")
def _(spark, d):
    return G.motif_bins(P.sequences(spark, d), "TH(E|A)", 500)


@query("sequence_split", with_("sq") + r""", q AS (SELECT chrom, regexp_extract_all(seq, '(?s)(.*?TION|.+$)') AS p FROM sq WHERE length(seq) > 0),
    u AS (SELECT chrom, unnest(p) AS seq, unnest(range(1, len(p) + 1)) AS i, p FROM q)
    SELECT chrom, CAST(coalesce(list_sum([length(x) for x in p[1:i-1]]), 0) AS BIGINT) AS start, length(seq) AS n FROM u""")
def _(spark, d):
    # a site whose two strands are one pattern, as the texts are not DNA
    piece = G.split_sequences(P.sequences(spark, d).where("length(seq) > 0").withColumn("seq", F.replace(F.col("seq"), F.lit("TION"), F.lit("GATC"))), "GATC")
    return piece.select("chrom", "start", (F.col("end") - F.col("start")).alias("n"))


@query("lift_over", with_("iv") + """ SELECT event_id, CASE WHEN s > 100000 + 30 AND s < 100501 THEN -1 ELSE s + CASE WHEN s >= 100501 THEN 30 - 500 ELSE 0 END + CASE WHEN s >= 300001 THEN 700 ELSE 0 END END AS lifted FROM iv""")
def _(spark, d):
    ch = P.chroms(spark).select("chrom", F.explode(F.array(F.struct(F.lit(100000).cast("long").alias("last_before"), F.lit(100501).cast("long").alias("first_after"), F.lit(30).cast("long").alias("inserted")), F.struct(F.lit(300000).cast("long").alias("last_before"), F.lit(300001).cast("long").alias("first_after"), F.lit(700).cast("long").alias("inserted")))).alias("c")).select("chrom", "c.*")
    return G.lift_over(P.intervals(spark, d).select("event_id", "chrom", F.col("start").alias("pos")), ch).select("event_id", "lifted")


@query("find_features", with_("sq") + """, q AS (SELECT chrom, string_split(seq, 'THE') AS p FROM sq),
    u AS (SELECT chrom, p, unnest(range(1, len(p))) AS i FROM q) SELECT chrom, CAST(list_sum([length(x) for x in p[1:i]]) + (i - 1) * 3 AS BIGINT) AS start FROM u""")
def _(spark, d):
    s = P.sequences(spark, d)
    return G.find_features(s, s.select("chrom", F.lit("w").alias("name"), F.lit("the").alias("text"))).select("chrom", "start")


_WORDS = ["THE", "TION", "ERE", "ANAN", "OU", "EA", "DIE", "LA", "CIÓN", "STST", "ENEN", "THETHE"]


@query("find_in_pieces", with_("sq") + f""", t AS (SELECT unnest({_WORDS}) AS text), q AS (SELECT chrom, text, string_split(seq, text) AS p FROM sq, t),
    u AS (SELECT chrom, text, p, unnest(range(1, len(p))) AS i FROM q) SELECT chrom, lower(text) AS name, CAST(list_sum([length(x) for x in p[1:i]]) + (i - 1) * length(text) AS BIGINT) AS start FROM u""")
def _(spark, d):
    """Many texts searched at once in sequences that come in pieces of 256 bases."""
    s = P.sequences(spark, d)
    pieces = G.in_pieces(s.select("chrom", F.lit(0).cast("long").alias("start"), "seq"), 256)
    wanted = s.select("chrom", F.explode(F.array(*(F.lit(w) for w in _WORDS))).alias("text")).select("chrom", F.lower("text").alias("name"), "text")
    return G.find_in_pieces(pieces, wanted, 256).select("chrom", "name", "start")


@query("build_pieces", with_("sq") + """, a AS (SELECT chrom, CASE WHEN length(seq) >= 60 THEN substr(seq, 1, 40) || 'NEW TEXT' || substr(seq, 60) ELSE seq END AS s FROM sq),
    b AS (SELECT chrom, CASE WHEN i > 0 AND strpos(substr(s, i + 3), 'TION') > 0 THEN substr(s, 1, i + 2) || '+' || substr(s, i + 2 + strpos(substr(s, i + 3), 'TION')) ELSE s END AS s FROM (SELECT *, strpos(s, 'THE') AS i FROM a)),
    c AS (SELECT chrom, CASE WHEN i > 0 AND strpos(substr(s, i + 4), 'AN') > 0 THEN substr(s, 1, i + 3) || substr(s, i + 3 + strpos(substr(s, i + 4), 'AN')) ELSE s END AS s FROM (SELECT *, strpos(s, 'TION') AS i FROM b)),
    k AS (SELECT chrom, s, unnest(range(0, (length(s) - 1) // 256 + 1)) AS k FROM c WHERE length(s) > 0) SELECT chrom, k * 256 AS start, substr(s, CAST(k * 256 + 1 AS BIGINT), 256) AS seq FROM k""")
def _(spark, d):
    """Sequences in pieces, changed by coordinates and then between flanks."""
    s = P.sequences(spark, d)
    one = lambda *x: F.struct(*(F.lit(v).alias(n) for n, v in zip(("kind", "left", "right", "text"), x)))
    flanks = F.array(one("FLANKS", "the", "tion", "+"), one("FLANKS", "tion", "an", ""))
    spots = F.when(F.length("seq") >= 60, F.array(one("COORDINATES", "40", "60", "new text"))).otherwise(F.array().cast("array<struct<kind:string,left:string,right:string,text:string>>"))
    changes = s.select("chrom", F.explode(F.concat(spots, flanks)).alias("c")).select("chrom", "c.*")
    return G.build_pieces(G.in_pieces(s.select("chrom", F.lit(0).cast("long").alias("start"), "seq"), 256), changes, 256)


# ---- jobs -----------------------------------------------------------------------------


@query("status_filter", with_("jobs") + " SELECT job, maxvmem FROM jobs WHERE maxvmem > 200000 AND state <> 'P' AND regexp_matches(command, '^c1')")
def _(spark, d):
    return J.status_filter(P.jobs(spark, d), [("maxvmem", ">", "200000"), ("state", "!=", "P"), ("command", "~", "^c1")]).select("job", "maxvmem")


@query("job_rollup", """SELECT o_custkey AS job, count(*) AS n_tasks, min(o_orderkey) AS start_time, max(o_orderkey) AS wall_time, max(o_totalprice) AS maxvmem,
    CAST(coalesce(min_by(x, o_orderkey) FILTER (x <> 0), 0) AS INTEGER) AS exit_status FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS x FROM orders) GROUP BY o_custkey""")
def _(spark, d):
    o = P.table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return J.array_rollup(o.select(F.col("o_custkey").alias("job"), F.col("o_orderkey").alias("task"), F.col("o_orderkey").alias("start_time"), F.col("o_orderkey").alias("wall_time"), F.col("o_totalprice").alias("maxvmem"), status.alias("exit_status")))


@query("job_closure", "WITH RECURSIVE e AS (SELECT o_orderkey AS job, o_orderkey // 2 AS p FROM orders WHERE o_orderkey > 0), c AS (SELECT 3 AS job UNION SELECT e.job FROM e JOIN c ON e.p = c.job) SELECT CAST(job AS BIGINT) AS job FROM c")
def _(spark, d):
    from spanloom.sources.folders import set_checkpoint_folder

    set_checkpoint_folder(spark)
    e = P.jobs(spark, d).where("job > 0").select("batch_id", "predecessor", "job")
    return J.successors(e, spark.createDataFrame([(1, 3)], "batch_id int, job long")).select("job")


@query("extend_antijoin", with_("jobs") + """, l AS (SELECT command, arg_max(coalesce(exit_status, -1), job) AS x FROM jobs GROUP BY command) SELECT 'c' || i AS command FROM range(0, 1000) t(i) WHERE 'c' || i NOT IN (SELECT command FROM l WHERE x NOT IN (137, -1))""")
def _(spark, d):
    wanted = spark.range(1000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("command"))
    return J.extend(wanted, P.jobs(spark, d))


@query("job_selector", with_("jobs") + " SELECT job FROM jobs WHERE job BETWEEN 120 AND 135 OR job = 7 OR job >= 990")
def _(spark, d):
    return P.jobs(spark, d).where(J.job_selector("120-35,7,990+")).select("job")


@query("scalar_labels", """SELECT o_orderkey AS job, CASE WHEN o_totalprice / 1e7 < 1e-4 THEN '***' WHEN o_totalprice / 1e7 < 1e-3 THEN '**' WHEN o_totalprice / 1e7 < 0.01 THEN '*' ELSE '' END AS mark,
    CASE WHEN o_totalprice >= 1e9 THEN 'G' WHEN o_totalprice >= 1e6 THEN 'M' WHEN o_totalprice >= 1e3 THEN 'K' ELSE '' END AS unit FROM orders""")
def _(spark, d):
    o = P.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("job"), stars(F.col("o_totalprice") / 1e7).alias("mark"), F.regexp_extract(human("o_totalprice"), "([KMG]?)$", 1).alias("unit"))


@query("job_states", """SELECT o_orderkey AS job, o_orderkey % 6 = 1 AS in_error, o_orderkey % 6 IN (1, 3) AS deletable FROM orders""")
def _(spark, d):
    """Exit states are numbers, words of the scheduler, deletions, or open; only Eqw is an error, and only words can be deleted."""
    k = F.col("o_orderkey")
    status = F.when(k % 6 == 0, "0").when(k % 6 == 1, "Eqw").when(k % 6 == 2, "deleted").when(k % 6 == 3, "hqw").when(k % 6 == 4, "137")
    return J.job_states(P.table(spark, d, "orders").select(k.alias("job"), status.alias("exit_status"))).select("job", "in_error", "deletable")


@query("status_listing", with_("jobs") + " SELECT command AS job_name, ' ' AS array, CAST(job AS VARCHAR) AS job_id, coalesce(CAST(exit_status AS VARCHAR), '-') AS exit_status, '-' AS start_time, '-' AS wall_time, state AS maxvmem FROM jobs")
def _(spark, d):
    j = P.jobs(spark, d).select(F.col("command").alias("job_name"), F.lit(None).cast("string").alias("array"), F.col("job").alias("job_id"), "exit_status", F.lit("").alias("start_time"), F.lit(None).cast("string").alias("wall_time"), F.col("state").alias("maxvmem"))
    return J.project_status(j)


@query("log_states", """SELECT o_orderkey AS job, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'day ' || o_orderkey END AS start_time,
    CASE WHEN o_orderkey % 4 = 0 THEN 'pending' WHEN o_orderkey % 4 = 1 THEN '137' ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS exit_status,
    CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN '99:99:99' WHEN o_orderkey % 4 = 2 THEN '00:0' || (o_orderkey % 10) || ':07' ELSE '0' || (o_orderkey % 10) || ':20:07' END AS wall_time,
    CASE WHEN o_orderkey % 4 = 0 THEN 0 WHEN o_orderkey % 4 = 1 THEN 9999999 ELSE o_orderkey % 1000 END::DOUBLE AS seconds,
    CASE WHEN o_orderkey % 4 > 1 THEN floor(o_orderkey % 100000 * 7 / 1000.0 + 0.5) / 1000 ELSE 0 END::DOUBLE AS maxvmem FROM orders""")
def _(spark, d):
    """Logs of jobs that wait, were cut off, and ended after minutes or hours."""
    k = F.col("o_orderkey")
    wall = F.when(k % 4 == 2, F.format_string("%d:07.31", k % 10)).otherwise(F.format_string("%d:20:07", k % 10))
    start = F.concat(F.lit("header\nq: execution started: day "), k.cast("string"), F.lit("\noutput\n"))
    end = F.format_string("q: exit_status: %d; walltime: %s; seconds: %d; maxvmem: %dK;\n", k % 3, wall, k % 1000, k % 100000 * 7)
    text = F.concat(F.when(k % 4 > 0, start).otherwise(""), F.when(k % 4 > 1, end).otherwise(""))
    return J.parse_logs(P.table(spark, d, "orders").select(k.alias("job"), text.alias("text")))


@query("loaded_status", """WITH l AS (SELECT o_orderkey AS n, count(*) FILTER (o_orderkey % 50 = 0) OVER (ORDER BY o_orderkey) AS batch_id, o_orderkey % 50 AS k FROM orders)
    SELECT batch_id, 'job' || n AS job_name, CAST(n AS VARCHAR) AS job_id FROM l WHERE k > 1""")
def _(spark, d):
    """Status lines with submit marks and labels between the jobs."""
    k = F.col("o_orderkey")
    value = F.when(k % 50 == 0, F.lit("submitted\tMon")).when(k % 50 == 1, F.lit("jobName\tjobID")).otherwise(F.concat(F.lit("job"), k.cast("string"), F.lit("\t"), k.cast("string")))
    return J.load_status(P.table(spark, d, "orders").select(k.alias("n"), value.alias("value")), ["job_name", "job_id"]).withColumn("batch_id", F.col("batch_id").cast("long"))


@query("purge_kept", "SELECT '/d/' || o_orderkey AS path FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, d):
    o = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("job"), F.concat(F.lit("/d/"), F.col("o_orderkey").cast("string")).alias("path"), "o_orderstatus")
    return J.purge_targets(o.select("job", "path"), o.where("o_orderstatus = 'F'")).select("path")


@query("rolled_back", "SELECT o_orderkey AS job, o_orderkey % 13 AS archive FROM orders WHERE o_orderkey % 13 = (SELECT max(o_orderkey % 13) FROM orders)")
def _(spark, d):
    return J.rollback(P.table(spark, d, "orders").select(F.col("o_orderkey").alias("job"), (F.col("o_orderkey") % 13).alias("archive"))).select("job", "archive")


@query("moved_and_masked", """SELECT o_orderkey AS job, '/new/d/' || o_orderkey || '/old' AS script, '/x/' || o_orderkey AS log, 'by ~ of ~~' || o_orderkey AS note FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey").cast("string")
    o = P.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("/home/a/d/"), k, F.lit("/old")).alias("script"), F.concat(F.lit("/x/"), k).alias("log"), F.concat(F.lit("by annette of anneann"), k).alias("note"))
    moved = J.move_paths(o, "/home/a", "/new", ["script", "log"])
    return moved.select(F.col("o_orderkey").alias("job"), "script", "log", J.mask_text(F.col("note"), ["ann", "anne", "annette"]).alias("note"))


@query("remapped", with_("jobs") + " SELECT job, CASE WHEN predecessor % 2 = 0 THEN predecessor + 1000000 ELSE predecessor END AS predecessor FROM jobs")
def _(spark, d):
    j = P.jobs(spark, d)
    ids = j.where("predecessor % 2 = 0").select(F.col("predecessor").alias("old"), (F.col("predecessor") + 1000000).alias("new")).distinct()
    return J.remap(j.select("job", F.array("predecessor").alias("predecessors")), ids).select("job", F.col("predecessors")[0].alias("predecessor"))


@query("settings_round_trip", "SELECT o_orderkey AS job, 'KEY' || (o_orderkey % 5) AS name, o_orderstatus || '=' || o_orderkey AS value FROM orders WHERE o_orderstatus <> 'P'")
def _(spark, d):
    v = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("job"), F.concat(F.lit("KEY"), (F.col("o_orderkey") % 5).cast("string")).alias("name"), F.when(F.col("o_orderstatus") != "P", F.concat_ws("=", "o_orderstatus", F.col("o_orderkey").cast("string"))).alias("value"))
    return J.read_snapshot(J.snapshot_lines(v))


@query("job_texts", "SELECT o_orderkey AS job, '/log/' || o_orderkey AS path, 'state ' || o_orderstatus AS text FROM orders WHERE o_orderkey % 2 = 0")
def _(spark, d):
    o = P.table(spark, d, "orders")
    files = o.select(F.col("o_orderkey").alias("job"), F.when(F.col("o_orderkey") % 2 == 0, "log").otherwise("script").alias("kind"), F.concat(F.lit("/log/"), F.col("o_orderkey").cast("string")).alias("path"), F.concat(F.lit("\x1b[H\x1b[2Jstate "), "o_orderstatus").alias("text"))
    return J.texts_of_jobs(P.jobs(spark, d), files, "log")


@query("files_by_size", "SELECT o_clerk_path AS path, size FROM (SELECT '/d/' || o_orderkey AS o_clerk_path, o_orderkey % 100 AS size FROM orders)")
def _(spark, d):
    return J.order_by_size(P.table(spark, d, "orders").select(F.concat(F.lit("/d/"), F.col("o_orderkey").cast("string")).alias("path"), (F.col("o_orderkey") % 100).alias("size")))


@query("snipped", "WITH n AS (SELECT event_id AS n, event_type AS value FROM events), b AS (SELECT min(n) AS lo, max(n) AS hi FROM n) SELECT n, value FROM n, b WHERE n < lo + 5 OR n > hi - 5")
def _(spark, d):
    return J.snip(P.table(spark, d, "events").select(F.col("event_id").alias("n"), F.col("event_type").alias("value")))


@query("latest_jobs", with_("jobs") + " SELECT command, max(job) AS job FROM jobs GROUP BY command")
def _(spark, d):
    return J.latest(P.jobs(spark, d)).select("command", "job")


@query("text_scalars", """SELECT o_orderkey AS job, reverse(translate(translate(CAST(o_orderkey AS VARCHAR), '0123456789', 'ACGTNACGTN'), 'ACGTN', 'TGCA.')) AS rc, o_orderkey % 24 * 3600 + o_orderkey % 60 * 60 + 5 AS seconds,
    ((26 * 365 + (o_orderkey % 12 + 1) * 30 + 3) * 24 + o_orderkey % 24) * 60 + 7 AS minutes, round(o_orderkey / 1000.0, 3) AS gb, 'g' || o_orderkey AS gene FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey")
    o = P.table(spark, d, "orders").select(
        k.alias("job"), F.translate(k.cast("string"), "0123456789", "ACGTNACGTN").alias("seq"), F.format_string("%02d:%02d:05", k % 24, k % 60).alias("wall"),
        F.format_string("%02d/03/26 %02d:07", k % 12 + 1, k % 24).alias("at"), F.concat(k.cast("string"), F.lit("M")).alias("mem"), F.concat(F.lit("transcript:t;gene:g"), k.cast("string")).alias("name"),
    )
    return o.select("job", L.reverse_complement("seq").alias("rc"), L.wall_seconds("wall").alias("seconds"), L.status_minutes("at").alias("minutes"), L.memory_gigabytes("mem").alias("gb"), L.name_field("name")["gene"].alias("gene"))
