"""Collection: which posts enter the raw table, and in what form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from moodloom.functions.topics import detect_topic, is_retweet
from moodloom.schemas import TWEET_COLUMNS

def drop_retweets(df: DataFrame) -> DataFrame:
    return df.where(~is_retweet(F.col("text")))


def with_defaults(df: DataFrame) -> DataFrame:
    """Missing language, time and counts get their defaults."""
    return df.withColumns(
        {
            "tweet_id": F.col("tweet_id").cast("string"),
            "lang": F.coalesce("lang", F.lit("en")),
            "created_at": F.coalesce("created_at", F.current_timestamp()),
            "retweet_count": F.coalesce(F.col("retweet_count").cast("int"), F.lit(0)),
            "like_count": F.coalesce(F.col("like_count").cast("int"), F.lit(0)),
        }
    )


def with_topic(df: DataFrame) -> DataFrame:
    return df.withColumn("topic", detect_topic(F.col("text")))


def is_valid() -> Column:
    """Rows an insert can take; the others go to quarantine."""
    return F.col("tweet_id").isNotNull() & F.col("text").isNotNull()


def first_arrivals(df: DataFrame) -> DataFrame:
    """One row per ``tweet_id``, the one with the lowest ``arrival_seq``.

    An aggregate, not a window: map tasks already reduce copies of an id to one
    row, so an id that makes up a third of the input does not land in one task.
    The result is hash partitioned by ``tweet_id``.
    """
    others = [c for c in df.columns if c != "tweet_id"]
    return (
        df.groupBy("tweet_id")
        .agg(F.min_by(F.struct(*others), F.col("arrival_seq")).alias("row"))
        .select(*[F.col("tweet_id") if c == "tweet_id" else F.col(f"row.{c}") for c in df.columns])
    )


def new_arrivals(df: DataFrame, existing: DataFrame) -> DataFrame:
    """First arrivals whose id is not in ``existing`` yet: insert, on conflict do nothing."""
    return first_arrivals(df).join(existing.select("tweet_id"), "tweet_id", "left_anti").select(df.columns)


def _eligible(df: DataFrame) -> DataFrame:
    return with_defaults(drop_retweets(df.where(is_valid())))


def collect(df: DataFrame) -> DataFrame:
    """The whole collection step over arriving rows, before the conflict check.

    Topics follow from the text, so they come after the dedup: a plan that does not read them is spared their search.
    """
    return with_topic(first_arrivals(_eligible(df)))


def collect_english(df: DataFrame, lang: str = "en") -> DataFrame:
    """``english(collect(df))``. Rows in other languages decide who came first, but leave their text behind."""
    rows = _eligible(df).withColumn("text", F.when(F.col("lang") == lang, F.col("text")))
    return english(with_topic(first_arrivals(rows)), lang)


def cap(df: DataFrame, target: int) -> DataFrame:
    """The first ``target`` distinct rows by arrival; the collection target of a run, if it has one."""
    return df.orderBy("arrival_seq").limit(target)


def english(df: DataFrame, lang: str = "en") -> DataFrame:
    """Columns and rows read for preprocessing; unordered, as every consumer is."""
    return df.where(F.col("lang") == lang).select(*TWEET_COLUMNS)


def newest_first(df: DataFrame) -> DataFrame:
    """Global order by creation time, missing times first."""
    return df.orderBy(F.col("created_at").desc_nulls_first(), "tweet_id")


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows plus a row counter that fills during the next action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
