from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moodloom.operators import evaluation, marts, split, trends


def labeled(spark, rows):
    """rows: (topic, sentiment, compound, likes)."""
    full = [
        (str(i), t, s, c, 0.5, None, likes, 4, datetime(2024, 1, 7, 3))
        for i, (t, s, c, likes) in enumerate(rows)
    ]
    from moodloom.functions.dates import with_time_columns

    return with_time_columns(
        spark.createDataFrame(
            full,
            "tweet_id string, topic string, sentiment string, vader_compound double, confidence double, "
            "retweet_count int, like_count int, word_count int, created_at timestamp",
        )
    )


def test_half_even_shares_and_null_keys(spark):
    rows = [("A", "positive", 0.5, None)] + [("A", "negative", -0.5, None)] * 5 + [("A", "neutral", 0.0, None)] * 26
    df = labeled(spark, rows + [(None, "positive", 0.1, 1), ("B", None, 0.1, 7)])
    daily = {(r.topic, r.sentiment): r for r in marts.daily_sentiment(df).collect()}
    assert daily["A", "positive"].pct == 3.12 and daily["A", "negative"].pct == 15.62
    assert daily["A", "positive"].total_likes == 0 and len(daily) == 3
    assert daily["A", "positive"].date == date(2024, 1, 7)
    kpis = {r.topic: r for r in marts.topic_kpis(df).collect()}
    assert set(kpis) == {"A"} and kpis["A"].pct_neutral == 81.25 and kpis["A"].total_tweets == 32


def test_pivot_fills_missing_columns(spark):
    (row,) = marts.sentiment_pivot(labeled(spark, [("A", "neutral", 0.0, 1)])).collect()
    assert (row.positive, row.negative, row.neutral) == (0, 0, 1)


def test_fact_and_heatmap(spark):
    df = labeled(spark, [("A", "neutral", 0.25, 1)] * 2)
    assert marts.fact_tweets(df).first().sentiment_score == 0.25
    (cell,) = marts.hourly_heatmap(df).collect()
    assert (cell.day_of_week, cell.hour_of_day, cell.day_num, cell.tweet_count) == ("Sunday", 3, 6, 2)


def test_shares_add_up(spark):
    rows = [("T", x, 0.1, 1) for x in ["positive"] * 3 + ["negative"] * 3 + ["neutral"]]
    total = marts.daily_sentiment(labeled(spark, rows)).agg(F.sum("pct")).first()[0]
    assert total == pytest.approx(100, abs=0.05)


def test_trending_hashtags(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), "#A #b #a"), (datetime(2024, 1, 1), "#b#c"), (datetime(2024, 1, 2), None)],
        "created_at timestamp, text string",
    )
    got = trends.trending_hashtags(df, 2).orderBy("rank").collect()
    assert [(r.hashtag, r.n) for r in got] == [("a", 2), ("b", 2)]


def largest_remainder(counts, share=0.2):
    import math

    n = sum(counts.values())
    n_train = n - math.ceil(n * share)
    floor = {k: c * n_train // n for k, c in counts.items()}
    order = sorted(counts, key=lambda k: (-(counts[k] * n_train % n), k))
    for k in order[: n_train - sum(floor.values())]:
        floor[k] += 1
    return {k: counts[k] - floor[k] for k in counts}


@pytest.mark.parametrize("counts", [{"a": 7, "b": 5, "c": 1}, {"a": 900, "b": 90, "c": 11}, {"a": 1, "b": 1}])
def test_split_counts_and_order(spark, counts):
    import hashlib

    rows = [(f"{k}{i}", k) for k, c in counts.items() for i in range(c)]
    df = spark.createDataFrame(rows, "tweet_id string, sentiment string")
    got = split.stratified_split(df).collect()
    assert len(got) == len(rows)
    for k, want in largest_remainder(counts).items():
        ranked = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i, c in rows if c == k)
        assert {r.tweet_id for r in got if r.sentiment == k and r.split == "test"} == {i for _, i in ranked[:want]}


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "sentiment string")
    assert {r.sentiment: r.weight for r in split.class_weights(df).collect()} == {"a": 8 / 12, "b": 2.0}


def test_evaluation(spark):
    pairs = [("positive", "positive")] * 3 + [("positive", "negative")] + [("negative", "negative")] * 2
    df = spark.createDataFrame(pairs, "sentiment string, prediction string")
    assert evaluation.accuracy(df).first().accuracy == pytest.approx(5 / 6)
    matrix = [tuple(r)[1:] for r in evaluation.confusion_matrix(df).orderBy("position").collect()]
    assert matrix == [("positive", 3, 1, 0), ("negative", 0, 2, 0), ("neutral", 0, 0, 0)]
    report = {r["class"]: r for r in evaluation.classification_report(df).collect()}
    assert report["neutral"].f1 == 0 and report["positive"].recall == 0.75
    assert report["negative"].precision == pytest.approx(2 / 3) and report["macro avg"].support == 6
    assert report["weighted avg"].recall == pytest.approx(5 / 6)
