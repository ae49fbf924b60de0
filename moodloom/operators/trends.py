"""Volume, trending terms and author reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.functions.numeric import exact_avg, total
from moodloom.functions.text import hashtags


def volume_over_time(df: DataFrame) -> DataFrame:
    return df.groupBy(F.date_trunc("hour", "created_at").alias("hour"), "topic").agg(
        F.count(F.lit(1)).alias("tweet_count")
    )


def _top_per_day(df: DataFrame, items: Column, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent items of each day, ties by item.

    Counts combine on the map side, and the rank filter drops all but ``k`` rows
    per day and partition before they are shuffled by day.
    """
    counts = (
        df.select(F.to_date("created_at").alias("date"), F.explode(items).alias(name))
        .groupBy("date", name)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("date").orderBy(F.desc("n"), name)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def trending_keywords(df: DataFrame, k: int = 10) -> DataFrame:
    return _top_per_day(df, F.col("tokens"), "keyword", k)


def trending_hashtags(df: DataFrame, k: int = 10) -> DataFrame:
    """Tags of the raw text, lower-cased."""
    return _top_per_day(df, F.transform(hashtags(F.col("text")), F.lower), "hashtag", k)


def influencer_sentiment(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` authors with the most likes and reposts, and how they feel."""
    return (
        df.where(F.col("username").isNotNull())
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("tweets"),
            exact_avg(F.col("vader_compound")).alias("avg_vader"),
            (total(F.col("like_count")) + total(F.col("retweet_count"))).alias("engagement"),
        )
        .orderBy(F.desc("engagement"), "username")
        .limit(k)
    )
