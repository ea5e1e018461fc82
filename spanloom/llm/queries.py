"""Queries over whole tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_MODEL = "piece_bpe_32k.model"
#: The key of op1's query, so that its results can be compared; a secret one is the caller's.
QUERY_KEY = "key of the registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_bytes(name: str = PIECE_MODEL, path: str | None = None) -> bytes:
    """A public vocabulary file: ``path``, or where the module of public tokenizers has ``name``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.surrogates import replace_private

    return replace_private(table(spark, sf_dir, "documents"), key=QUERY_KEY)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and round trip of every document.  ``covered_bytes`` is where the last span ends."""
    from spanloom.llm.pieces import encode_documents

    out = encode_documents(table(spark, sf_dir, "documents"), tokenizer_bytes())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered_bytes"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's removal, and beside it the passages of over 50 words that also stand in another document."""
    from spanloom.llm.suffixes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=400, passage=51).drop("kept")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"), shards=16)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.quality import score_quality, train_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.toxicity import score_toxicity, train_toxicity

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=4)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.secrets import find_secrets, secret_digests

    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spanloom.llm.conversations import Repair, damage, repair_digests

    rows = table(spark, sf_dir, "conversations")
    return repair_digests(rows, Repair(damage(rows)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_licenses": op2_licenses,
    "op3_pieces": op3_pieces,
    "op4_near_dedup": op4_near_dedup,
    "op5_repeats": op5_repeats,
    "op6_decontaminate": op6_decontaminate,
    "op7_sharding": op7_sharding,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_secrets": op12_secrets,
    "op13_conversations": op13_conversations,
}

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def licenses_sql() -> str:
    """The scan as SQL: places by list positions, templates by set intersection with every line and run of lines."""
    from spanloom.llm.licenses import PHRASES, RUN, SLACK, TEMPLATES

    def places(phrase: tuple[str, ...]) -> str:
        test = " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase))
        return f"[i - 1 FOR i IN range(1, len(ws) + 1) IF {test}]"

    values = ", ".join(f"({i}, '{label}', list_distinct(string_split('{text}', ' ')), {SLACK * len(text.split())})" for i, (label, text) in enumerate(TEMPLATES))
    base = ", ".join(f"CASE WHEN len(p_{k}) > 0 THEN '{k}' END" for k in PHRASES)
    found = " || ".join(f"p_{k}" for k in PHRASES)
    vocabulary = sorted({w for _, text in TEMPLATES for w in text.split()})
    most = SLACK * max(len(text.split()) for _, text in TEMPLATES)
    return f"""
        WITH t(id, label, parts, longest) AS (VALUES {values}),
        d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
        w AS (SELECT doc_id, x, {_WORDS.format(_LOW.format("x"))} AS ws FROM d),
        p AS (SELECT *, {", ".join(f"{places(v)} AS p_{k}" for k, v in PHRASES.items())} FROM w),
        l AS (SELECT doc_id, i, {_WORDS.format(_LOW.format("line"))} AS ws FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(x, chr(10)) AS ls FROM d))),
        v AS (SELECT doc_id, i, len(ws) AS n, list_distinct([y FOR y IN ws IF list_contains({vocabulary}, y)]) AS own FROM l),
        c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM v),
        e AS (SELECT * FROM c WHERE len(own) > 0),
        r AS (SELECT a.doc_id, a.i, b.i AS j, CASE WHEN b.i - a.i < {RUN} THEN 0 ELSE b.upto - a.upto + a.n END AS span, list(m.own) AS owns FROM e a JOIN e b ON a.doc_id = b.doc_id AND b.i >= a.i
            AND (b.i - a.i < {RUN} OR b.upto - a.upto + a.n <= {most}) JOIN e m ON m.doc_id = a.doc_id AND m.i BETWEEN a.i AND b.i GROUP BY ALL),
        m AS (SELECT doc_id, i, j, id, label, len(list_intersect(list_distinct(flatten(owns)), parts)) / len(parts) AS share FROM r, t WHERE span <= longest),
        h AS (SELECT * FROM m WHERE share >= 0.9),
        g AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM h AS o WHERE o.doc_id = h.doc_id AND o.id = h.id AND o.i >= h.i AND o.j <= h.j AND o.j - o.i < h.j - h.i)),
        f AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share, count(*) AS n FROM g GROUP BY doc_id),
        q AS (SELECT p.doc_id, len(ws) AS n_words, {found} AS pos, [b FOR b IN [{base}] IF b IS NOT NULL] AS base, more, share, n FROM p LEFT JOIN f USING (doc_id))
        SELECT doc_id, n_words, len(pos) AS n_base, list_min(pos) AS first_word, list_max(pos) AS last_word,
            array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
            CASE WHEN len(pos) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score, coalesce(n, 0) AS n_blocks FROM q"""


NEAR_SQL = rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 2) + 1)) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
    k AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept FROM w LEFT JOIN n USING (doc_id) JOIN k ON k.doc_id = w.doc_id"""



def _least(*ways: str) -> str:
    return f"least({', '.join(ways)})"


def _edit(state: str, cost: str, letter: str) -> str:
    """A state's element (twelve digits of cost, then the audit, so that text order is their order) after an edit."""
    return f"lpad((left({state}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({state}, 13) || '{letter}'"


def conversations_sql() -> str:
    """The repair as a recursion over turns that carries the best element of each of the four states."""
    crc = "SELECT i, i::BIGINT AS v FROM range(256) r(i)"
    for _ in range(8):
        crc = f"SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({crc})"
    to = lambda state, initial: f"CASE WHEN bad THEN NULL WHEN r = '{initial}' THEN {_edit(state, 'late', 'K')} ELSE {_edit(state, '3 + late', 'R')} END"
    step = {
        0: _edit("e0", "4", "D"),
        1: _least(_edit("e1", "4", "D"), f"CASE WHEN NOT bad AND r = 's' THEN {_edit('e0', 'late', 'K')} END"),
        2: _least(_edit("e2", "4", "D"), to("e0", "u"), to("e1", "u"), to("e3", "u")),
        3: _least(_edit("e3", "4", "D"), to("e2", "a")),
    }
    raw = ", ".join(f"{x} AS e{k}" for k, x in step.items())
    user = _least("e2", *(_edit(f"e{k}", "3", "I") for k in (0, 1, 3)))
    return rf"""
        WITH RECURSIVE table_ AS (SELECT list(v ORDER BY i) AS crcs FROM ({crc})),
        o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        h AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
            lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how FROM o, table_),
        d AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
            CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE how WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE how <> 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS r FROM d),
        f AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            NOT regexp_matches(text, '[.!?][ 	-
]*$') AS open_, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM n),
        m AS (SELECT *, blank OR again AS bad, CASE WHEN open_ THEN 3 ELSE 0 END AS late FROM f),
        s AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT bad AND open_) AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id),
        w AS (SELECT conv_id, 0::BIGINT AS i, '000000000000' AS e0, NULL::VARCHAR AS e1, '000000000003I' AS e2, '000000000006II' AS e3 FROM s
            UNION ALL SELECT conv_id, i, e0, e1, e2, {_least("e3", _edit("e2", "3", "I"))} FROM (SELECT conv_id, i, e0, e1, {user} AS e2, e3 FROM (
                SELECT m.conv_id, m.i, {raw} FROM w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1))),
        a AS (SELECT s.*, left(least(e0, e3), 12)::BIGINT AS cost, substr(least(e0, e3), 13) AS audit FROM s JOIN w ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i),
        c AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM a),
        q AS (SELECT conv_id, p, audit[p] AS op, len(replace(audit, 'D', '')) % 2 AS system, p - len(replace(left(audit, p), 'I', '')) AS skip, len(replace(left(audit, p), 'D', '')) AS kept FROM c),
        t AS (SELECT q.conv_id, sha256(string_agg(CASE WHEN op = 'K' THEN role WHEN (kept - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS hash FROM q LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM q.conv_id AND m.i = p - skip WHERE op <> 'D' GROUP BY q.conv_id)
        SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM x.conv_id"""


ORACLE: dict[str, str] = {
    "op2_licenses": licenses_sql(),
    "op4_near_dedup": NEAR_SQL,
    "op13_conversations": conversations_sql(),
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
}
