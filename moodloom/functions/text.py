"""Text columns: cleaning, tokens, stopwords, n-grams.

Character classes follow Unicode text rules: a word character is any letter,
any number or the underscore, and whitespace is the full Unicode set. Java's
own ``\\w`` and ``\\s`` are ASCII only, so the classes are spelled out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inner parts of bracket expressions; Java and RE2 read them alike.
WORD = r"\p{L}\p{N}_"
LETTER = r"\p{L}\p{Nl}\p{No}"
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# What cleaning removes or replaces.
URL = rf"http[^{SPACE}]+|www[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#([{WORD}]+)"
ENTITY = "&amp;|&lt;|&gt;"
NOT_WORD = rf"[^{WORD}']+"
# The same runs for Java but a single space, which would be replaced by itself.
SYMBOLS = rf"[^{WORD}'](?:(?<! )[^{WORD}']*|[^{WORD}']+)"

# Emoticons that survive cleaning: eyes 8, optional nose, mouth; either direction.
EMOTICON = "8[o']?[dDpP]|[dDpP][o']?8"
PHONE = r"(?:[01] *)?(?:\p{Nd}{3} *)?\p{Nd}{3} *\p{Nd}{4}"
# First match wins: phone-like digit groups, emoticons, words of three or more
# letters that may hold apostrophes, dashes and underscores, runs of word
# characters, anything else.
TOKEN = rf"{PHONE}|{EMOTICON}|[{LETTER}][{LETTER}'_-]+[{LETTER}]|[{WORD}]+|[^{SPACE}]"

FEATURE_TOKEN = rf"[{WORD}]{{2,}}"


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def remove_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "")


def unwrap_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, HASHTAG, "$1")


def blank_entities(text: Column) -> Column:
    return F.regexp_replace(text, ENTITY, " ")


def blank_symbols(text: Column) -> Column:
    """Symbols and whitespace become one space per run; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, SYMBOLS, " "))


def clean_text(text: Column) -> Column:
    """URLs, mentions, hashtag marks, three entities and symbols go, in this order.

    The two patterns with alternatives, the slow ones, are tried only on texts that hold their characters; no
    step before the entities can bring an ``&`` into a text.
    """
    raw = F.coalesce(text, F.lit(""))
    linked = F.when(raw.contains("http") | raw.contains("www"), remove_urls(raw)).otherwise(raw)
    unwrapped = unwrap_hashtags(remove_mentions(linked))
    return blank_symbols(F.when(raw.contains("&"), blank_entities(unwrapped)).otherwise(unwrapped))


def squeeze_repeats(text: Column) -> Column:
    """Three or more of the same character become three."""
    return F.regexp_replace(text, r"(.)\1{2,}", "$1$1$1")


def tokenize(cleaned: Column) -> Column:
    """Tokens of *cleaned* text, lower-cased unless they hold an emoticon such as ``8D``.

    Forms that cleaning removes (URLs, handles, hashtags, punctuation faces,
    emoji, decimals) have no pattern here.
    """
    tokens = F.regexp_extract_all(squeeze_repeats(cleaned), F.lit(TOKEN), F.lit(0))
    return F.transform(
        tokens,
        lambda t: F.when(t.contains("8") & t.rlike(EMOTICON), t).otherwise(F.lower(t)),
    )


def remove_stopwords(tokens: Column, stopwords: Iterable[str], min_length: int = 3) -> Column:
    words = sorted(stopwords)
    return F.filter(tokens, lambda t: (F.length(t) >= min_length) & ~t.isin(words))


def word_count(text: Column) -> Column:
    """Number of space-separated words; 0 for the empty string."""
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(HASHTAG), F.lit(1))


def with_terms(df: DataFrame, text_col: str, out: str = "terms") -> DataFrame:
    """Add unigrams followed by bigrams over runs of two or more word characters."""
    unigrams = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(FEATURE_TOKEN), F.lit(0))
    pairs = F.greatest(F.size("_uni") - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice("_uni", F.lit(1), pairs),
        F.slice("_uni", F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return df.withColumn("_uni", unigrams).withColumn(out, F.concat("_uni", bigrams)).drop("_uni")


def with_term_counts(df: DataFrame, terms_col: str = "terms", out: str = "term_counts") -> DataFrame:
    """Add ``array<struct<term, tf>>``, the distinct terms of a row with their counts.

    Works inside the row: sort, find where each run of equal terms starts, and
    take the distance to the next start. Counting by (row, term) would shuffle
    every term of the corpus instead. Explode the result with ``inline_outer``:
    the inner form infers a filter on it, which would compute it once more.
    """
    n = F.size("_sorted")
    numbered = F.arrays_zip(
        F.col("_sorted").alias("term"),
        F.slice(F.concat(F.array(F.lit(None).cast("string")), "_sorted"), F.lit(1), n).alias("before"),
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")).alias("at"),
    )
    starts = F.filter("_numbered", lambda t: ~t["term"].eqNullSafe(t["before"]))
    next_at = F.concat(F.slice("_starts.at", F.lit(2), F.size("_starts")), F.array(F.size("_numbered") + 1))
    counts = F.zip_with(
        F.col("_starts"),
        F.slice(next_at, F.lit(1), F.size("_starts")),
        lambda start, end: F.struct(start["term"].alias("term"), (end - start["at"]).alias("tf")),
    )
    return (
        df.withColumn("_sorted", F.sort_array(terms_col))
        .withColumn("_numbered", numbered)
        .withColumn("_starts", starts)
        .withColumn(out, counts)
        .drop("_sorted", "_numbered", "_starts")
    )
