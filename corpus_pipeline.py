"""The corpus pipeline: five stages over ``documents``, each written and read again.

A stage judges rows, not ids: every row has a key of its own (the file it stands in and
its place there), so rows that share a ``doc_id``, or have none, are judged each.  All
stages but the last return the columns of ``documents``; columns beyond ``doc_id`` and
``text`` pass through unread.  A null text counts as empty, an empty table gives an empty
one, texts are read whole however long, and repeated rows are copies of each other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.decontaminate import contaminated
from spanloom.llm.exact_dedup import exact_duplicates
from spanloom.llm.near_dedup import near_duplicates
from spanloom.llm.pieces import encode_documents
from spanloom.llm.quality import score_quality, train_quality
from spanloom.llm.queries import table, tokenizer_bytes
from spanloom.llm.work import drop_paths, keep_keys, stage, work_tables

def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key, and its name, which no column has: the hash of a row's file and its place in it, the same in every scan.

    Rows that come from no file are written first."""
    key, taken = "row_key_", {c.lower() for c in docs.columns}
    while key in taken:
        key += "_"
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.select("*", place.alias(key)), key
    except AnalysisException:
        return stage(docs, "docs").select("*", place.alias(key)), key


def _without(keyed: DataFrame, verdict: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``verdict``, which becomes a work table."""
    return keep_keys(keyed, stage(verdict.select(key).distinct(), "verdict"), [key], "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts.  Empty and null texts score like a text without words."""
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    keyed, key = _keyed(docs)
    return _without(keyed, score_quality(keyed, model, key=key).where("predicted = 0"), key)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the largest ``doc_id``, or any of several such rows.

    Null and empty texts are one group."""
    keyed, key = _keyed(docs)
    return _without(keyed, exact_duplicates(keyed, key=key).where("not kept"), key)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8): that of the least ``doc_id``.

    Texts without words link with nothing, so their rows stay."""
    keyed, key = _keyed(docs)
    return _without(keyed, near_duplicates(keyed, shingle=5, percent=80, key=key).where("not kept"), key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of a benchmark item; texts without words stay."""
    keyed, key = _keyed(docs)
    return _without(keyed, contaminated(keyed, table(spark, sf_dir, "benchmark"), key=key), key)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, with the digest of what they decode to; one row for each row, empty texts too."""
    out = encode_documents(docs, tokenizer_bytes())
    return out.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding and decoding", encoded),
]

#: The classifier, the near-duplicate components and the tokenizer are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order.  Each stage's rows are written as Parquet before the next, and its work tables then deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        before = set(work_tables())
        out = stage(step(spark, docs, sf_dir), name.split()[0].lower())
        drop_paths(spark, [p for p in work_tables() if p not in before and p != out._work_path])
        docs = out
    return docs
