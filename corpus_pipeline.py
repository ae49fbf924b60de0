"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.llm import decontaminate as benchmark_filter
from moodloom.llm import jaccard_join, language_id, line_dedup, sentence_pieces
from moodloom.llm.common import fold
from moodloom.session import materialize

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# A text in one of the learned languages scores far more; one in none of them has no clear winner.
MIN_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those whose language is not clear."""
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    judged = language_id.annotate(docs, model)
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(
        *docs.columns
    )


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; a document of which nothing is left goes."""
    cleaned = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"\S")
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group linked by Jaccard similarity."""
    found = jaccard_join.jaccard_components(docs.select("doc_id", "text"))
    copies = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark passages make up a 20th."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = benchmark_filter.decontaminate(docs.select("doc_id", "text"), benchmark)
    bad = judged.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("ver").alias("_ver")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_ver"))
    return docs.join(bad, same, "left_anti").select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, score, ids, others, decoded): piece ids of the kept texts and what they decode to."""
    vocabulary = sentence_pieces.load_vocabulary(PIECES)
    encoded = sentence_pieces.encode(docs, vocabulary, decoded=True)
    n_pieces = F.size("ids").cast("long").alias("n_pieces")
    return encoded.select("doc_id", n_pieces, "score", "ids", "others", "decoded")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentence_pieces", encode_pieces),
]
# SQL cannot express a trained network; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
