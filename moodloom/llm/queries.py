"""The registered query of each operator, over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    importance_sampling,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    sentence_pieces,
    sharding,
    spelling_variants,
    token_counts,
    url_filter,
)
from moodloom.llm.common import fold

SHARDS = [f"shard-{i:02d}" for i in range(16)]
TABLE_SIZE = 4_093
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentence_pieces(spark, sf_dir, model_file=PIECES):
    """Best and next segmentations of whole texts, and whether the best decodes to the text."""
    docs = table(spark, sf_dir, "documents")
    vocabulary = sentence_pieces.load_vocabulary(model_file)
    return sentence_pieces.encode(docs, vocabulary, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "score",
        F.get("others", F.lit(0))["score"].alias("score_2"),
        F.get("others", F.lit(1))["score"].alias("score_3"),
        F.xxhash64("ids").alias("ids_hash"),
        F.md5("decoded").alias("decoded_md5"),
    )


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_lm_score(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"))


def op4_url_filter(spark, sf_dir):
    """The list: pages whose id carries a toxic label. Every page with such a URL is blocked."""
    pages = table(spark, sf_dir, "pages")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    listed = pages.select("page_id", "url").join(toxic, "page_id", "left_semi")
    return url_filter.filter_urls(pages, listed)


def op5_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS, TABLE_SIZE).select("doc_id", "slot", "shard")


def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).drop("ver")


def op9_token_counts(spark, sf_dir, model_file=PIECES):
    automaton = token_counts.build(token_counts.load_pieces(model_file))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), automaton)


def op10_line_dedup(spark, sf_dir):
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", "n_chars", F.md5("text").alias("text_md5"))


def op11_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance_sampling.resample(docs, table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_byte_bpe(spark, sf_dir, rank_file=None, pattern=None):
    """``rank_file`` and ``pattern`` are those of the installed public tokenizers unless given."""
    if rank_file is None or pattern is None:
        import public_tokenizers

        rank_file = rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    tokenizer = byte_bpe.build(byte_bpe.load_ranks(rank_file), pattern)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), tokenizer, columns=("packed", "decoded"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark, sf_dir):
    found = spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_language_id": op2_language_id,
    "op3_lm_score": op3_lm_score,
    "op4_url_filter": op4_url_filter,
    "op5_sharding": op5_sharding,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}
