"""Fixed schemas at every boundary; nothing is inferred.

Fixed values: the column names and their order in ``RAW_TWEETS``, ``TWEET_COLUMNS`` and
``FACT_COLUMNS`` are the output contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TWEETS = T.StructType(
    [
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("tweet_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("retweet_count", T.IntegerType()),
        T.StructField("like_count", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("collected_at", T.TimestampType()),
    ]
)

# What a post source delivers, before defaults and topic are filled in.
ARRIVING_TWEETS = T.StructType(
    [f for f in RAW_TWEETS.fields if f.name not in ("topic", "collected_at")]
)

# Columns read for preprocessing.
TWEET_COLUMNS = [
    "tweet_id",
    "username",
    "text",
    "topic",
    "lang",
    "retweet_count",
    "like_count",
    "created_at",
]

PREPROCESSED = T.StructType(
    [RAW_TWEETS[name] for name in TWEET_COLUMNS]
    + [
        T.StructField("clean_text", T.StringType()),
        T.StructField("processed_text", T.StringType()),
        T.StructField("text_length", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
    ]
)

FACT_COLUMNS = [
    "tweet_id",
    "topic",
    "sentiment",
    "vader_compound",
    "confidence",
    "retweet_count",
    "like_count",
    "word_count",
    "created_at",
    "date",
    "hour_of_day",
    "day_of_week",
    "week",
    "month",
]

PIPELINE_RUNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("tweet_count", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error_msg", T.StringType()),
    ]
)

# The three classes; also the fixed row and column order of the reports.
SENTIMENTS = ["positive", "negative", "neutral"]
