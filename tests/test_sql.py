"""The functions in SQL text against their column forms."""

import datetime as dt

from pyspark.sql import functions as F

from moodloom.functions import sql, topics
from moodloom.functions import text as tx
from moodloom.functions.dates import with_time_columns
from moodloom.operators import sentiment
from moodloom.plans import catalog

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "RT @a_b http://x.y/z", "www.é.com #ß-½ &amp; don't", "a　b\u001cc 😀 #tag #Tag2", "  NBA  goal ", '"quoted" \\d+ $1',
]


def posts(spark):
    rows = [(i, t, dt.datetime(2014 + i, 1, 1 + i, i)) for i, t in enumerate(ODD)]
    odd = spark.createDataFrame(rows, "arrival_seq long, text string, created_at timestamp")
    own = catalog.posts(spark, SF).select("arrival_seq", "text", F.col("created_at").cast("timestamp").alias("created_at"))
    return odd.unionByName(own)


def test_scalar_functions_equal_the_columns(spark):
    sql.register(spark, "m_")
    rows = posts(spark)
    called = spark.sql(
        "SELECT text, m_clean_tweet(text) c, m_topic(text) t, m_hashtags(text) h, m_is_retweet(text) r FROM {p}", p=rows
    )
    plain = rows.select(
        "text",
        tx.clean_text(F.col("text")).alias("c"),
        topics.detect_topic(F.col("text")).alias("t"),
        tx.hashtags(F.col("text")).alias("h"),
        topics.is_retweet(F.col("text")).alias("r"),
    )
    assert sorted(map(repr, called.collect())) == sorted(map(repr, plain.collect()))
    scores = spark.createDataFrame([(x,) for x in (0.05, 0.0499, -0.05, -0.0499, 0.0, None)], "c double")
    labels = spark.sql("SELECT c, m_vader_label(c) l FROM {s}", s=scores).collect()
    assert labels == scores.select("c", sentiment.label(F.col("c")).alias("l")).collect()


def test_the_table_function_gives_the_time_columns(spark):
    sql.register(spark)
    rows = posts(spark)
    called = spark.sql("SELECT arrival_seq, created_at, t.* FROM {p}, LATERAL time_columns(created_at) t", p=rows)
    plain = with_time_columns(rows.select("arrival_seq", "created_at"))
    assert sorted(map(repr, called.collect())) == sorted(map(repr, plain.select(called.columns).collect()))


def test_calls_are_expressions_of_the_plan(spark):
    assert len(sql.register(spark, "again_")) == len(sql.register(spark, "again_")) == 7
    events = spark.read.parquet(f"{SF}/documents.parquet")
    found = spark.sql("SELECT again_clean_tweet(text) c FROM {d} WHERE doc_id < 5 AND again_topic(text) = 'AI'", d=events)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "again_" not in plan and "LessThan(doc_id,5)" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_keywords_of_ones_own(spark):
    sql.register(spark, "own_", {"Tea": ["green tea"], "Drinks": ["tea"]})
    got = spark.sql("SELECT own_topic('Green TEA'), own_topic('team'), own_topic(null)").first()
    assert tuple(got) == ("Tea", "Drinks", "General")
