"""The registered queries, each over whole tables of a data folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.functions import dictionaries, sql, topics
from moodloom.functions import text as tx
from moodloom.functions.dates import with_time_columns
from moodloom.operators import evaluation, features, ingest, marts, rules, sentiment, split, trends
from moodloom.operators.classifiers import SentimentModel, decided, predict_sentiment
from moodloom.operators.preprocess import lemmatize, long_enough, preprocess, seed_lemmas
from moodloom.plans import scheduled_run, training
from moodloom.schemas import PREPROCESSED, SENTIMENTS
from moodloom.session import materialize, workspace
from moodloom.sources.posts import posts
from moodloom.sources.tables import append_new, init_raw_table, read_csv_back, write_csv
from moodloom.streaming import posts as stream
from moodloom.streaming.runs import run_pending

# The collection target of the capped query; the other queries have none.
CAP = 500
# Files of a table that one batch of a stream takes; all that wait if None.
FILES_PER_BATCH = None


def joined(items: Column) -> Column:
    return F.array_join(items, "|")


# Shared steps


def collected(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.collect(posts(spark, sf))


def prepared(spark: SparkSession, sf: str, lemmas: bool = True) -> DataFrame:
    """Prepared English posts, partitioned by id since the dedup."""
    return preprocess(ingest.collect_english(posts(spark, sf)), seed_lemmas(spark) if lemmas else None)


def scored(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Prepared posts with scores and label, of their columns only ``keep``."""
    if {"tokens", "processed_text", "text_length", "word_count"} & set(keep):
        ready = prepared(spark, sf, lemmas="processed_text" in keep)
    else:
        ready = long_enough(ingest.collect_english(posts(spark, sf)))
    return sentiment.with_sentiment(ready, dictionaries.seed_lexicon(spark), keep=["tweet_id", *keep])


def reported(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The input of the reports, labeled by the lexicon; ``more`` columns of the posts are kept."""
    rows = scored(spark, sf, "topic", "retweet_count", "like_count", "created_at", *more)
    return with_time_columns(marts.with_lexicon_confidence(rows))


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    """The input of the classifiers; written, since the split reads it several times."""
    rows = scored(spark, sf, "processed_text").select("tweet_id", "processed_text", "sentiment")
    return materialize(rows, "labeled")


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = posts(spark, sf).select("arrival_seq", tx.clean_text(F.col("text")).alias("clean_text"))
    return rows.select("arrival_seq", tx.tokenize(F.col("clean_text")).alias("tokens"))


def kept_tokens(spark: SparkSession, sf: str) -> DataFrame:
    stop = dictionaries.default_stopwords()
    return tokens(spark, sf).withColumn("tokens", tx.remove_stopwords(F.col("tokens"), stop))


# Collection


def load_english(spark, sf):
    return ingest.newest_first(ingest.english(collected(spark, sf)))


def ingest_filter(spark, sf):
    return ingest.drop_retweets(posts(spark, sf)).select("arrival_seq", "tweet_id", "text")


def ingest_defaults(spark, sf):
    return ingest.with_defaults(posts(spark, sf)).select(
        "arrival_seq", "tweet_id", "lang", "retweet_count", "like_count", "created_at"
    )


def ingest_dedup(spark, sf):
    return ingest.first_arrivals(posts(spark, sf)).select(
        "arrival_seq", "tweet_id", "username", "text", "lang", "created_at"
    )


def ingest_conflict(spark, sf):
    """Arrivals against a table that already holds the reposts' ids."""
    everything = posts(spark, sf)
    held = everything.where(topics.is_retweet(F.col("text")))
    return ingest.new_arrivals(everything, held).select("arrival_seq", "tweet_id")


def ingest_cap(spark, sf):
    return ingest.cap(collected(spark, sf), CAP).select("arrival_seq", "tweet_id", "topic")


def topic_detect(spark, sf):
    return ingest.with_topic(posts(spark, sf)).select("arrival_seq", "topic")


def stream_rules(spark, sf):
    """The tags of the rules as text, in both readings."""
    rows = ingest.with_defaults(posts(spark, sf))
    for out, precedence in (("tags", "intended"), ("strict_tags", "strict")):
        table = rules.rule_table(spark, topics.STREAM_RULE_TEXTS, precedence)
        rows = rules.with_rule_tags(rows, table, out=out)
    return rows.select("arrival_seq", joined(F.col("tags")).alias("tags"), joined(F.col("strict_tags")).alias("strict_tags"))


# Text


def clean_tweet(spark, sf):
    return posts(spark, sf).select("arrival_seq", tx.clean_text(F.col("text")).alias("clean_text"))


def tokenize(spark, sf):
    return tokens(spark, sf).select("arrival_seq", joined("tokens").alias("tokens"))


def remove_stopwords(spark, sf):
    return kept_tokens(spark, sf).select("arrival_seq", joined("tokens").alias("tokens"))


def lemmatize_tokens(spark, sf):
    return lemmatize(kept_tokens(spark, sf), seed_lemmas(spark), "arrival_seq").select(
        "arrival_seq", joined("tokens").alias("tokens")
    )


def preprocess_posts(spark, sf):
    return prepared(spark, sf).select("tweet_id", "clean_text", "processed_text", "text_length", "word_count")


def ngrams(spark, sf):
    return tx.with_terms(prepared(spark, sf), "processed_text").select("tweet_id", joined("terms").alias("terms"))


# Sentiment


def vader_scores(spark, sf):
    rows = clean_tweet(spark, sf)
    return sentiment.sentiment_scores(rows, dictionaries.seed_lexicon(spark), "arrival_seq")


def vader_raw_scores(spark, sf):
    raw = posts(spark, sf).select(
        "arrival_seq", sentiment.describe_emoji(F.col("text"), dictionaries.SEED_EMOJI).alias("text")
    )
    return sentiment.sentiment_scores(raw, dictionaries.seed_lexicon(spark), "arrival_seq", "text")


def vader_label(spark, sf):
    return scored(spark, sf).select("tweet_id", "vader_compound", "sentiment")


# Reports


def time_columns(spark, sf):
    return with_time_columns(posts(spark, sf).select("arrival_seq", "created_at"))


def fact_tweets(spark, sf):
    return marts.fact_tweets(reported(spark, sf, "word_count"))


def daily_sentiment(spark, sf):
    return marts.daily_sentiment(reported(spark, sf)).orderBy("date", "topic", "sentiment")


def topic_kpis(spark, sf):
    return marts.topic_kpis(reported(spark, sf)).orderBy("topic")


def sentiment_pivot(spark, sf):
    return marts.sentiment_pivot(reported(spark, sf)).orderBy("topic")


def hourly_heatmap(spark, sf):
    return marts.hourly_heatmap(reported(spark, sf)).orderBy("day_num", "hour_of_day", "sentiment")


def sentiment_distribution(spark, sf):
    return marts.sentiment_distribution(reported(spark, sf))


def volume_over_time(spark, sf):
    return trends.volume_over_time(ingest.with_topic(posts(spark, sf)))


def trending_keywords(spark, sf):
    return trends.trending_keywords(prepared(spark, sf))


def trending_hashtags(spark, sf):
    return trends.trending_hashtags(posts(spark, sf))


def influencer_sentiment(spark, sf):
    return trends.influencer_sentiment(scored(spark, sf, "username", "like_count", "retweet_count"))


# Features and models


def _terms(spark, sf):
    return materialize(features.document_terms(prepared(spark, sf)), "terms")


def _weights(spark, sf):
    terms = _terms(spark, sf)
    vocab = materialize(features.vocabulary(terms), "vocabulary")
    return features.weights(terms, vocab)


def tfidf_vocab(spark, sf):
    return features.vocabulary(_terms(spark, sf)).select(
        "term", "df", "cf", "idx", F.round("idf", 6).alias("idf")
    )


def tfidf_weights(spark, sf):
    return _weights(spark, sf).select("tweet_id", "term", "idx", F.round("weight", 6).alias("weight"))


def maxabs_scale(spark, sf):
    weighted = materialize(_weights(spark, sf), "weights")
    return features.scale(weighted, features.max_abs(weighted)).select(
        "tweet_id", "idx", F.round("scaled", 6).alias("scaled")
    )


def stratified_split(spark, sf):
    return split.stratified_split(labeled(spark, sf)).select("tweet_id", "sentiment", "split")


def class_weights(spark, sf):
    return split.class_weights(scored(spark, sf)).select(
        "sentiment", "n", F.round("weight", 6).alias("weight")
    )


def train_nb(spark, sf):
    theta, _ = training.naive_bayes_tables(training.training_set(labeled(spark, sf)))
    return theta.select(
        "term", "idx", *[F.round(s, 6).alias(s) for s in ("positive", "negative", "neutral")]
    )


def predict_nb(spark, sf):
    return training.naive_bayes_predictions(training.training_set(labeled(spark, sf)))


def accuracy(spark, sf):
    return evaluation.accuracy(predict_nb(spark, sf))


def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(predict_nb(spark, sf)).orderBy("position")


def classification_report(spark, sf):
    measures = ("precision", "recall", "f1")
    return evaluation.classification_report(predict_nb(spark, sf)).select(
        "class", *[F.round(m, 6).alias(m) for m in measures], "support"
    )


def _rounded(prefix: str) -> list[Column]:
    return [F.round(f"{prefix}_{s}", 3).alias(f"{prefix}_{s}") for s in SENTIMENTS]


def train_lr(spark, sf):
    """The test rows with the class and the probabilities of the fitted model."""
    predicted = training.fit_linear(training.training_set(labeled(spark, sf)), "logistic")[1]
    return predicted.select("tweet_id", "sentiment", "prediction", *_rounded("prob"))


def train_svc(spark, sf):
    """The test rows with the margins, and the class where the solver's error bound decides it."""
    predicted = training.fit_linear(training.training_set(labeled(spark, sf)), "svc")[1]
    return predicted.select(
        "tweet_id", "sentiment", F.when(decided(), F.col("prediction")).alias("prediction"), *_rounded("margin")
    )


def model_metrics(spark, sf):
    """The comparison of the models by their figures on the test rows."""
    return training.train_models(labeled(spark, sf))[1]


def _saved_model(spark, sf) -> SentimentModel:
    path = workspace(spark, "model")
    training.fit_linear(training.training_set(labeled(spark, sf)), "logistic")[0].save(path)
    return SentimentModel.load(spark, path)


def predict_batch(spark, sf):
    """Raw texts of all first arrivals through a model that was saved and loaded."""
    texts = ingest.first_arrivals(posts(spark, sf)).select("tweet_id", "text")
    predicted = predict_sentiment(
        texts, _saved_model(spark, sf), dictionaries.seed_lexicon(spark), seed_lemmas(spark)
    )
    return predicted.select(
        "tweet_id", "text", "sentiment", F.round("confidence", 3).alias("confidence"), "vader_compound", *_rounded("prob")
    )


# SQL text


def sql_functions(spark, sf):
    """The functions called in SQL text, over all posts."""
    sql.register(spark)
    return spark.sql(
        """SELECT arrival_seq, clean_tweet(text) AS clean_text, topic(text) AS topic, is_retweet(text) AS is_retweet,
        size(hashtags(text)) AS n_tags, t.*
        FROM {posts}, LATERAL time_columns(CAST(created_at AS TIMESTAMP)) t""",
        posts=posts(spark, sf),
    )


def sql_labels(spark, sf):
    """Posts by topic and label, both from functions in SQL text."""
    sql.register(spark)
    return spark.sql(
        """SELECT topic(text) AS topic, vader_label(vader_compound) AS sentiment, count(*) AS n
        FROM {scored} GROUP BY topic(text), vader_label(vader_compound)""",
        scored=scored(spark, sf, "text"),
    )


# Sinks and runs


def csv_roundtrip(spark, sf):
    path = workspace(spark, "csv")
    write_csv(prepared(spark, sf).select(PREPROCESSED.fieldNames()), path)
    return read_csv_back(spark, path, PREPROCESSED)


def export_manifest(spark, sf):
    """All five report tables."""
    rows = materialize(reported(spark, sf, "word_count"), "reported")
    metrics = training.train_models(labeled(spark, sf))[1]
    return scheduled_run.export_marts(rows, workspace(spark, "marts"), metrics)


def _run_twice(spark, sf, out_dir) -> None:
    """A run over all posts, then one that finds nothing new."""
    raw = materialize(collected(spark, sf), "raw")
    model = _saved_model(spark, sf)
    words = dictionaries.seed_lexicon(spark), seed_lemmas(spark)
    scheduled_run.run(spark, raw, model, *words, out_dir)
    scheduled_run.run(spark, raw.where(F.lit(False)), model, *words, out_dir)


def scheduled(spark, sf):
    """Counts of the daily report that a scheduled run publishes, by the labels of its classifier."""
    out_dir = workspace(spark, "run")
    _run_twice(spark, sf, out_dir)
    daily = spark.read.parquet(f"{out_dir}/Daily_Sentiment")
    return daily.select("date", "topic", "sentiment", "tweet_count", "total_likes", "total_retweets", "pct")


def run_log(spark, sf):
    out_dir = workspace(spark, "run")
    _run_twice(spark, sf, out_dir)
    return spark.read.parquet(f"{out_dir}/runs").select("tweet_count", "success", "error_msg")


def _raw_table(spark) -> str:
    """A new raw table with a bucket for each shuffle partition, which are chosen for the data's size."""
    name = f"raw_{uuid.uuid4().hex}"
    init_raw_table(spark, name, int(spark.conf.get("spark.sql.shuffle.partitions")), workspace(spark, "raw"))
    return name


def raw_table(spark, sf):
    """Posts of even number come first, then all: an id that is there is not taken again."""
    name, rows = _raw_table(spark), posts(spark, sf)
    append_new(spark, ingest.collect(rows.where("arrival_seq % 2 = 0")), name)
    append_new(spark, ingest.collect(rows), name)
    return spark.table(name).select("arrival_seq", "tweet_id", "topic")


# Streams, each run until its input is used up


def stream_ingest(spark, sf):
    base, name = workspace(spark, "ingest"), _raw_table(spark)
    source = stream.read_posts_stream(spark, sf, FILES_PER_BATCH)
    stream.ingest_stream(source, name, f"{base}/bad", f"{base}/progress").start().awaitTermination()
    return spark.table(name).select("arrival_seq", "tweet_id", "topic", "lang", "retweet_count", "like_count")


def stream_dedup(spark, sf):
    """Each id once, with its first arrival."""
    base = workspace(spark, "dedup")
    source = stream.read_posts_stream(spark, sf, FILES_PER_BATCH).select("tweet_id", "arrival_seq")
    stream.write_unique(source, f"{base}/ids", f"{base}/progress").start().awaitTermination()
    return spark.read.schema("tweet_id string, arrival_seq long").parquet(f"{base}/ids").drop("batch_id")


def stream_target(spark, sf):
    """A stream that ends at its target."""
    base, name = workspace(spark, "target"), _raw_table(spark)
    source = stream.read_posts_stream(spark, sf, FILES_PER_BATCH)
    stream.collect_until(source, name, f"{base}/bad", f"{base}/progress", CAP)
    return spark.table(name).select("arrival_seq", "tweet_id", "topic")


def stream_volume(spark, sf):
    base = workspace(spark, "volume")
    source = ingest.with_topic(stream.read_posts_stream(spark, sf, FILES_PER_BATCH))
    stream.volume_stream(source, f"{base}/windows", f"{base}/progress").start().awaitTermination()
    return stream.volume(spark, f"{base}/windows")


def stream_score(spark, sf):
    """The incremental run over all that waits; its labeled rows."""
    out_dir = workspace(spark, "incremental")
    words = dictionaries.seed_lexicon(spark), seed_lemmas(spark)
    source = stream.read_posts_stream(spark, sf, FILES_PER_BATCH)
    log = run_pending(source, _raw_table(spark), _saved_model(spark, sf), *words, out_dir).first()
    if not log.success:
        raise RuntimeError(log.error_msg)
    rows = spark.read.parquet(f"{out_dir}/labeled")
    return rows.select("tweet_id", "vader_compound", "vader_sentiment", "sentiment")


QUERIES = {
    "load_english": load_english,
    "ingest_filter": ingest_filter,
    "ingest_defaults": ingest_defaults,
    "ingest_dedup": ingest_dedup,
    "ingest_conflict": ingest_conflict,
    "ingest_cap": ingest_cap,
    "topic_detect": topic_detect,
    "stream_rules": stream_rules,
    "clean_tweet": clean_tweet,
    "tokenize": tokenize,
    "remove_stopwords": remove_stopwords,
    "lemmatize": lemmatize_tokens,
    "preprocess": preprocess_posts,
    "ngrams": ngrams,
    "vader_scores": vader_scores,
    "vader_raw_scores": vader_raw_scores,
    "vader_label": vader_label,
    "time_columns": time_columns,
    "fact_tweets": fact_tweets,
    "daily_sentiment": daily_sentiment,
    "topic_kpis": topic_kpis,
    "sentiment_pivot": sentiment_pivot,
    "hourly_heatmap": hourly_heatmap,
    "sentiment_distribution": sentiment_distribution,
    "volume_over_time": volume_over_time,
    "trending_keywords": trending_keywords,
    "trending_hashtags": trending_hashtags,
    "influencer_sentiment": influencer_sentiment,
    "tfidf_vocab": tfidf_vocab,
    "tfidf_weights": tfidf_weights,
    "maxabs_scale": maxabs_scale,
    "stratified_split": stratified_split,
    "class_weights": class_weights,
    "train_nb": train_nb,
    "predict_nb": predict_nb,
    "accuracy": accuracy,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "train_lr": train_lr,
    "train_svc": train_svc,
    "model_metrics": model_metrics,
    "predict_batch": predict_batch,
    "sql_functions": sql_functions,
    "sql_labels": sql_labels,
    "csv_roundtrip": csv_roundtrip,
    "raw_table": raw_table,
    "export_manifest": export_manifest,
    "scheduled_run": scheduled,
    "run_log": run_log,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_target": stream_target,
    "stream_volume": stream_volume,
    "stream_score": stream_score,
}
