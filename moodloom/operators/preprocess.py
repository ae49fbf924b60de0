"""Lemmas and the full text preparation of a post."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.functions import text as tx
from moodloom.functions.dictionaries import default_stopwords, seed_irregular, seed_nouns

# Noun endings and what replaces them, in order of trial.
NOUN_SUFFIXES = [
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
]

LEMMA_STEPS = 2
MIN_WORDS = 3
# Words of a text looked at before all of them.
HEAD_WORDS = 16
PLAIN_WORD = r"^(?:([a-zA-Z])(?!\1\1)){3,30}$"


def lemma_table(nouns: DataFrame, irregular: DataFrame, steps: int = LEMMA_STEPS) -> DataFrame:
    """``(token, lemma)`` for every inflected form whose lemma differs from it.

    Endings are taken off until a word of the vocabulary is left: at most ``steps`` times, and what lies
    between need not be a word. The rules run backwards from the vocabulary, so that lemmatizing a
    corpus is one lookup per token; each step about triples the table. A form's lemmas are those of
    the fewest steps, the word itself and one step counting alike; of several the shortest
    wins, then the unchanged word, then rule order. Irregular forms skip the rules. Steps never
    lengthen a word and no rule undoes another, so there is no way round in a circle.
    """
    word = F.col("form")
    level = nouns.select(
        F.col("token").alias("form"), F.col("token").alias("lemma"), F.lit(0).alias("steps"), F.lit("").alias("rank")
    )
    forms = level
    for step in range(1, steps + 1):
        grown = []
        for rank, (ending, base) in enumerate(NOUN_SUFFIXES, start=1):
            stem = F.substring(word, F.lit(1), F.length(word) - len(base))
            # The rule taken last on the way back is the first on the way to the lemma.
            way = F.concat(F.lit(str(rank)), F.col("rank"))
            grown.append(F.when(word.endswith(base), F.struct(F.concat(stem, F.lit(ending)).alias("form"), way.alias("rank"))))
        level = level.select("lemma", F.explode(F.array_compact(F.array(*grown))).alias("f")).select(
            "f.form", "lemma", F.lit(step).alias("steps"), "f.rank"
        )
        forms = forms.unionByName(level)
    regular = forms.join(irregular.select(F.col("token").alias("form")), "form", "left_anti")
    listed = irregular.select(F.col("token").alias("form"), "lemma", F.lit(1).alias("steps"), F.lit("").alias("rank"))
    # The word itself has the empty rank, which is the least.
    best = F.min_by("lemma", F.struct(F.greatest("steps", F.lit(1)), F.length("lemma"), F.col("rank")))
    return (
        regular.select("form", "lemma", "steps", "rank")
        .unionByName(listed)
        .groupBy("form")
        .agg(best.alias("lemma"))
        .where("form <> lemma")
        .select(F.col("form").alias("token"), "lemma")
    )


def seed_lemmas(spark) -> DataFrame:
    return lemma_table(seed_nouns(spark), seed_irregular(spark))


def lemmatize(
    df: DataFrame, lemmas: DataFrame, id_col: str = "tweet_id", tokens_col: str = "tokens"
) -> DataFrame:
    """Replace tokens by their lemmas; rows that share an id stay rows of their own.

    Only tokens that change, and one marker row that carries the columns, pass the join; so a row is made once and
    nothing is joined back. An input partitioned by ``id_col`` (the deduplicated posts) needs no exchange for that.
    """
    own = F.coalesce(F.array_distinct(tokens_col), F.array().cast("array<string>"))
    # Where a shuffle joins a large vocabulary, markers must not meet in one task, nor rows travel with each token.
    marker = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(id_col), F.lit(997)).cast("string"))
    marked = (
        df.select(F.col(id_col).alias("_id"), F.struct(*df.columns).alias("_row"), F.concat(F.array(marker), own).alias("_own"))
        .select("_id", "_row", F.posexplode("_own").alias("_pos", "token"))
        .withColumn("_row", F.when(F.col("_pos") == 0, F.col("_row")))
    )
    found = (
        marked.join(lemmas, "token", "left")
        .where((F.col("_pos") == 0) | F.col("lemma").isNotNull())
        .groupBy("_id")
        .agg(
            F.collect_list("_row").alias("_rows"),
            F.map_from_entries(F.collect_set(F.when(F.col("_pos") > 0, F.struct("token", "lemma")))).alias("_lemmas"),
        )
    )
    swapped = F.transform(tokens_col, lambda t: F.coalesce(F.element_at(F.col("_lemmas"), t), t))
    tokens = F.when(F.size("_lemmas") == 0, F.col(tokens_col)).otherwise(swapped)
    return found.select("_lemmas", F.inline_outer("_rows")).select(
        *[tokens.alias(c) if c == tokens_col else F.col(c) for c in df.columns]
    )


def preprocess(
    df: DataFrame,
    lemmas: DataFrame | None,
    stopwords: Iterable[str] | None = None,
    id_col: str = "tweet_id",
    min_words: int | None = MIN_WORDS,
) -> DataFrame:
    """Add ``clean_text``, ``tokens``, ``processed_text``, ``text_length`` and ``word_count``.

    Posts with fewer than ``min_words`` words left are dropped; ``None`` keeps all.
    Lemmas change words, not their number: a caller that needs only scores and
    counts passes no ``lemmas`` and is spared their lookup.
    """
    stopwords = default_stopwords() if stopwords is None else stopwords
    cleaned = df.withColumn("clean_text", tx.clean_text(F.col("text")))
    # Filters on what comes out of a generator stay above it; through columns the optimizer would move them down
    # and with them clean and cut every text a second time.
    once = F.struct(F.col("clean_text"), tx.remove_stopwords(tx.tokenize(F.col("clean_text")), stopwords).alias("tokens"))
    others = [c for c in cleaned.columns if c not in ("clean_text", "tokens")]
    prepared = cleaned.select(*others, F.inline_outer(F.array(once)))
    if lemmas is not None:
        prepared = lemmatize(prepared, lemmas, id_col)
    prepared = (
        prepared
        .withColumn("processed_text", F.array_join("tokens", " "))
        .withColumn("text_length", F.length("clean_text"))
        .withColumn("word_count", tx.word_count(F.col("processed_text")))
    )
    return prepared if min_words is None else prepared.where(F.col("word_count") >= min_words)


def long_enough(df: DataFrame, stopwords: Iterable[str] | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows that ``preprocess`` keeps, with ``clean_text`` only.

    Mostly the first words show that a text has enough: between spaces, a run of ASCII letters of which no three
    in a row are alike is a token by itself, whatever stands around it. Texts of which that does not show
    are cut whole.
    """
    stopwords = sorted(default_stopwords() if stopwords is None else stopwords)
    clean = F.col("clean_text")
    words = tx.remove_stopwords(tx.tokenize(clean), stopwords)
    plain = F.filter(
        F.split(F.substring_index(clean, " ", HEAD_WORDS), " "),
        lambda w: w.rlike(PLAIN_WORD) & ~F.lower(w).isin(stopwords),
    )
    enough = F.when(F.size(plain) >= min_words, True).otherwise(
        tx.word_count(F.array_join(words, " ")) >= min_words
    )
    # As in ``preprocess``: the filter stays above the generator, so each text is cleaned once.
    once = F.struct(clean, enough.alias("_enough"))
    cleaned = df.withColumn("clean_text", tx.clean_text(F.col("text")))
    others = [c for c in cleaned.columns if c != "clean_text"]
    return cleaned.select(*others, F.inline_outer(F.array(once))).where("_enough").drop("_enough")
