import re
from datetime import datetime

from pyspark.sql import functions as F

from moodloom.functions import topics
from moodloom.operators import ingest
from moodloom.operators.preprocess import lemmatize, seed_lemmas
from moodloom.schemas import ARRIVING_TWEETS
from moodloom.sources import tables

T0 = datetime(2024, 1, 1)


def arriving(spark, rows):
    """rows: (seq, tweet_id, text) and optionally lang."""
    full = [(r[0], r[1], "u", r[2], r[3] if len(r) > 3 else "en", None, None, T0) for r in rows]
    return spark.createDataFrame(full, ARRIVING_TWEETS)


def test_first_arrival_wins_for_a_hot_id(spark):
    rows = [(i, "hot" if i % 3 == 0 else str(i), f"t{i}") for i in range(300)]
    kept = ingest.first_arrivals(arriving(spark, rows).orderBy(F.desc("arrival_seq")))
    got = {r.tweet_id: r.arrival_seq for r in kept.collect()}
    assert got["hot"] == 0 and len(got) == 201


def test_new_arrivals_skip_existing(spark):
    held = arriving(spark, [(0, "a", "x")])
    fresh = ingest.new_arrivals(arriving(spark, [(5, "a", "y"), (6, "b", "z"), (7, "b", "w")]), held)
    assert [(r.tweet_id, r.arrival_seq) for r in fresh.collect()] == [("b", 6)]
    assert fresh.columns == ARRIVING_TWEETS.fieldNames()


def test_defaults_and_filters(spark):
    df = arriving(spark, [(1, "a", "RT hi", None), (2, "b", "RTFM", None), (3, None, "x"), (4, "d", None)])
    df = df.withColumn("created_at", F.lit(None).cast("timestamp"))
    (row,) = ingest.collect(df).collect()
    assert (row.tweet_id, row.lang, row.retweet_count, row.like_count) == ("b", "en", 0, 0)
    assert row.created_at is not None and row.topic == "General"


def test_first_topic_wins(spark):
    texts = ["ChatGPT election", "devoted fans", "goalless", "BITCOIN", "weather", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r.t for r in df.select("i", topics.detect_topic(F.col("text")).alias("t")).orderBy("i").collect()]
    assert got == ["AI", "Politics", "Sports", "Crypto", "General", "General"]


def test_stream_rules(spark):
    rows = [
        ("openai and NBA", "en"), ("climate will change", "en"), ("changeclimate", "en"),
        ("RT LLM", "en"), ("ChatGPT", "de"), ("LLM", "de"), ("devotesenate", "en"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, lang string")
    tags = topics.matched_tags(F.col("text"), F.col("lang"))
    strict = topics.matched_tags(F.col("text"), F.col("lang"), precedence="strict")
    got = df.select("i", tags.alias("t"), strict.alias("s")).orderBy("i").collect()
    assert [r.t for r in got] == [["AI", "Sports"], ["Climate"], [], [], [], [], []]
    assert [r.s for r in got] == [["AI", "Sports"], ["Climate"], [], [], ["AI"], [], []]


def test_cap_and_order(spark):
    df = arriving(spark, [(i, str(i), "x") for i in (5, 3, 9, 1)])
    assert [r.arrival_seq for r in ingest.cap(df, 2).collect()] == [1, 3]
    late = df.withColumn("created_at", F.when(F.col("arrival_seq") != 3, F.col("created_at")))
    assert ingest.newest_first(late).first().created_at is None


def test_raw_table_appends_once(spark):
    tables.init_raw_table(spark, "raw_test", buckets=4)
    batch = ingest.with_topic(ingest.with_defaults(arriving(spark, [(1, "a", "x"), (2, "b", "y"), (3, "a", "z")])))
    assert tables.append_new(spark, batch, "raw_test") == 2
    assert tables.append_new(spark, batch, "raw_test") == 0
    assert spark.table("raw_test").count() == 2


def test_stored_side_of_the_conflict_check_is_not_shuffled(spark):
    tables.init_raw_table(spark, "raw_stored", buckets=8)
    batch = ingest.collect(arriving(spark, [(i, str(i), "x") for i in range(50)]))
    tables.append_new(spark, batch, "raw_stored")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = tables.fresh_rows(spark, batch, "raw_stored")
        join = fresh._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = join[: join.index("raw_stored")].splitlines()[-4:]
    assert "Bucketed: true" in join and not any("Exchange" in line for line in stored)


def test_bucketed_table_spares_the_exchange(spark):
    tables.init_raw_table(spark, "raw_plan", buckets=4)
    # Larger than the lemmas, which are then the side that is sent around.
    tables.append_new(spark, ingest.collect(arriving(spark, [(i, str(i), "word " * 400) for i in range(5000)])), "raw_plan")
    df = spark.table("raw_plan").select("tweet_id", F.split("text", " ").alias("tokens"))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = lemmatize(df, seed_lemmas(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "hashpartitioning(tweet_id" not in plan


def test_csv_keeps_nulls_quotes_and_line_breaks(spark, tmp_path):
    schema = "a string, b int, c timestamp"
    rows = [('say "hi", ok', 1, datetime(2024, 1, 1, 2, 3, 4, 5006)), ("two\nlines", None, None), ("", 3, None), (None, 4, None)]
    df = spark.createDataFrame(rows, schema)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv_back(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_texts_of_other_languages_stay_behind_at_the_dedup(spark):
    rows = [
        (1, "a", "erst", "de"), (2, "a", "then", "en"), (3, "b", "first", None), (4, "b", "puis", "fr"),
        (5, "c", "RT no", "de"), (6, "c", "one", "en"), (7, "c", "two", "en"), (8, None, "x", "en"), (9, "d", None, "en"),
    ]
    df = spark.createDataFrame(
        [(i, t, "u", x, lang, None, None, datetime(2024, 1, 1)) for i, t, x, lang in rows],
        "arrival_seq long, tweet_id string, username string, text string, lang string, retweet_count int, "
        "like_count int, created_at timestamp",
    )
    got = ingest.collect_english(df)
    assert sorted(got.collect()) == sorted(ingest.english(ingest.collect(df)).collect())
    assert sorted((r.tweet_id, r.text) for r in got.collect()) == [("b", "first"), ("c", "one")]
    # What the dedup exchanges has a text only where it can be read later.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "= en) THEN text" in re.sub(r"#\d+L?", "", plan)
