"""The report tables as sums over one small relation of mergeable counts.

A cube has a row for each date, hour, topic and sentiment that occurs, a missing one being a group of its own, with
whole-number sums. Cubes of disjoint sets of posts add up to the cube of all, and a cube with its sums negated takes
posts back, so reports need no second look at old posts. Its rows are bounded by the calendar, not by the posts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.functions.numeric import exact_sum, percent
from moodloom.schemas import SENTIMENTS

KEYS = ["date", "day_of_week", "hour_of_day", "topic", "sentiment"]
SUMS = ["posts", "ids", "vader", "n_vader", "confidence", "n_confidence", "likes", "retweets"]
UNITS = 10_000


def cube(labeled: DataFrame) -> DataFrame:
    """The cube of labeled posts with their time columns."""
    return labeled.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("posts"),
        F.count("tweet_id").alias("ids"),
        F.coalesce(exact_sum(F.col("vader_compound"), 4), F.lit(0)).alias("vader"),
        F.count("vader_compound").alias("n_vader"),
        F.coalesce(exact_sum(F.col("confidence"), 4), F.lit(0)).alias("confidence"),
        F.count("confidence").alias("n_confidence"),
        F.coalesce(F.sum(F.col("like_count").cast("long")), F.lit(0)).alias("likes"),
        F.coalesce(F.sum(F.col("retweet_count").cast("long")), F.lit(0)).alias("retweets"),
    )


def negated(partial: DataFrame, sums: list[str] = SUMS) -> DataFrame:
    return partial.withColumns({c: -F.col(c) for c in sums})


def added(parts: list[DataFrame], keys: list[str] = KEYS, sums: list[str] = SUMS) -> DataFrame:
    """The sum of partial relations; groups of which nothing is left are gone."""
    both = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return both.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums]))


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total) / (F.col(n) * F.lit(UNITS)))


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def daily_sentiment(total: DataFrame) -> DataFrame:
    of_day = F.sum("ids").over(Window.partitionBy("date", "topic"))
    return _sums(total, "date", "topic", "sentiment").select(
        "date",
        "topic",
        "sentiment",
        F.col("ids").alias("tweet_count"),
        _mean("vader", "n_vader").alias("avg_vader"),
        _mean("confidence", "n_confidence").alias("avg_confidence"),
        F.col("likes").alias("total_likes"),
        F.col("retweets").alias("total_retweets"),
        percent(F.col("ids"), of_day).alias("pct"),
    )


def topic_kpis(total: DataFrame) -> DataFrame:
    labeled = F.col("sentiment").isNotNull()
    split = [F.sum(F.when(F.col("sentiment") == s, F.col("ids")).otherwise(0)).alias(s) for s in SENTIMENTS]
    parts = F.col("positive") + F.col("negative") + F.col("neutral")
    rolled = total.where("topic is not null").groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.sum(F.when(labeled, F.col("posts")).otherwise(0)).alias("labeled"), *split
    )
    return rolled.where(F.col("labeled") > 0).select(
        "topic",
        F.col("ids").alias("total_tweets"),
        _mean("vader", "n_vader").alias("avg_vader"),
        F.col("likes").alias("total_likes"),
        F.col("retweets").alias("total_retweets"),
        *SENTIMENTS,
        *[percent(F.col(s), parts).alias(f"pct_{s}") for s in SENTIMENTS],
    )


def hourly_heatmap(total: DataFrame) -> DataFrame:
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    numbers = F.create_map(*[F.lit(x) for i, day in enumerate(days) for x in (day, i)])
    return _sums(total, "day_of_week", "hour_of_day", "sentiment").select(
        "day_of_week",
        "hour_of_day",
        "sentiment",
        F.col("ids").alias("tweet_count"),
        F.element_at(numbers, F.col("day_of_week")).alias("day_num"),
    )


def sentiment_distribution(total: DataFrame) -> DataFrame:
    everything = F.sum("tweet_count").over(Window.partitionBy())
    counts = _sums(total, "sentiment").select("sentiment", F.col("posts").alias("tweet_count"))
    return counts.withColumn("pct", percent(F.col("tweet_count"), everything)).orderBy(F.desc("tweet_count"), "sentiment")


# Without the table of posts themselves, which grows by what each batch brings.
REPORTS = {"Daily_Sentiment": daily_sentiment, "Topic_KPIs": topic_kpis, "Hourly_Heatmap": hourly_heatmap}
