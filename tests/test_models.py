import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodloom.functions import dictionaries as words
from moodloom.operators import classifiers, evaluation, features, naive_bayes
from moodloom.operators.classifiers import SentimentModel, predict_sentiment
from moodloom.operators.preprocess import seed_lemmas
from moodloom.plans import scheduled_run, training
from moodloom.schemas import ARRIVING_TWEETS, SENTIMENTS

TEXTS = ["good day", "good day", "good bad", "bad day", "", "rare word"]


def docs(spark, texts=TEXTS):
    rows = [(str(i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "tweet_id string, processed_text string")


def test_vocabulary_bounds_and_ties(spark):
    terms = features.document_terms(docs(spark))
    vocab = features.vocabulary(terms, features.TfidfParams(min_df=2, max_df=0.5)).orderBy("idx").collect()
    assert [(r.term, r.df, r.cf, r.n_docs) for r in vocab] == [
        ("bad", 2, 2, 6), ("day", 3, 3, 6), ("good", 3, 3, 6), ("good day", 2, 2, 6),
    ]
    assert vocab[0].idf == pytest.approx(math.log(7 / 3) + 1)
    top = features.vocabulary(terms, features.TfidfParams(max_features=3, min_df=2, max_df=0.5))
    assert {r.term for r in top.collect()} == {"bad", "day", "good"}


def test_no_terms_is_an_error(spark):
    vocab = features.vocabulary(features.document_terms(docs(spark)), features.TfidfParams(min_df=9))
    with pytest.raises(ValueError):
        features.require_terms(vocab)


def test_weights_vectors_and_scale(spark):
    terms = features.document_terms(docs(spark, [*TEXTS, "good good good day"]))
    vocab = features.vocabulary(terms, features.TfidfParams(min_df=2, max_df=0.9))
    weighted = features.weights(terms, vocab).cache()
    norms = weighted.groupBy("tweet_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r.n == pytest.approx(1) for r in norms)
    idf = {r.term: r.idf for r in vocab.collect()}
    raw = {"good": (1 + math.log(3)) * idf["good"], "day": idf["day"], "good day": idf["good day"]}
    got = {r.term: r.weight for r in weighted.where("tweet_id = '6'").collect()}
    length = math.sqrt(sum(x * x for x in raw.values()))
    assert got == pytest.approx({t: x / length for t, x in raw.items()})
    vectors = {r.tweet_id: r.features for r in features.vectors(docs(spark), weighted, vocab.count()).collect()}
    assert vectors["4"].numNonzeros() == 0 and vectors["0"].numNonzeros() == 3
    scaled = features.scale(weighted, features.max_abs(weighted)).groupBy("idx").agg(F.max("scaled").alias("m"))
    assert all(r.m == 1 for r in scaled.collect())


def test_naive_bayes_scores_empty_documents_by_prior(spark):
    labels = spark.createDataFrame(
        [("0", "positive"), ("1", "positive"), ("2", "negative"), ("3", "negative"), ("4", "negative"), ("5", "negative")],
        "tweet_id string, sentiment string",
    )
    terms = features.document_terms(docs(spark))
    vocab = features.vocabulary(terms, features.TfidfParams(min_df=2, max_df=0.9))
    weighted = features.weights(terms, vocab)
    theta, prior = naive_bayes.fit(weighted, labels, vocab, ["positive", "negative"])
    got = naive_bayes.predict(labels, weighted, theta, prior, ["positive", "negative"])
    assert {r.tweet_id: r.prediction for r in got.collect()} == {
        "0": "positive", "1": "positive", "2": "negative", "3": "negative", "4": "negative", "5": "negative",
    }


def posts(spark):
    lines = ["I love great machine learning", "terrible bad sad weather report", "plain weather report today"]
    rows = [
        (i, str(i), "u", f"{lines[i % 3]} number{i % 4}", "en", 1, 2, None) for i in range(60)
    ]
    from moodloom.operators.ingest import collect

    return collect(spark.createDataFrame(rows, ARRIVING_TWEETS))


def test_train_save_predict_and_run(spark, tmp_path):
    from moodloom.operators.ingest import english
    from moodloom.operators.preprocess import preprocess
    from moodloom.operators.sentiment import with_sentiment

    lexicon, lemmas = words.seed_lexicon(spark), seed_lemmas(spark)
    labeled = with_sentiment(preprocess(english(posts(spark)), lemmas), lexicon)
    gold = labeled.withColumn("gold", F.when(F.col("tweet_id").cast("int") % 3 == 0, F.col("sentiment")).otherwise("neutral"))
    model, metrics = training.train_models(gold, gold_col="gold")
    rows = {r.model: r for r in metrics.collect()}
    assert rows["Logistic Regression"].is_primary and rows["Logistic Regression"].accuracy == 100
    assert set(rows) == {"Logistic Regression", "SVM (LinearSVC)", "Naive Bayes", "VADER only"}
    assert 0 < rows["VADER only"].accuracy < 100 and not rows["VADER only"].is_primary

    model.save(str(tmp_path / "model"))
    loaded = SentimentModel.load(spark, str(tmp_path / "model"))
    texts = spark.createDataFrame([("a", "love great machine learning"), ("b", "")], "tweet_id string, text string")
    got = {r.tweet_id: r for r in predict_sentiment(texts, loaded, lexicon, lemmas).collect()}
    assert got["a"].sentiment == "positive" and got["a"].vader_compound > 0.8
    for r in got.values():
        probs = [r.prob_positive, r.prob_negative, r.prob_neutral]
        assert sum(probs) == pytest.approx(1) and r.confidence == max(probs)

    out = str(tmp_path / "run")
    run = scheduled_run.run(spark, posts(spark), loaded, lexicon, lemmas, out, metrics, fmt="csv").first()
    assert run.success and run.tweet_count == 60 and run.error_msg is None
    counts = {r.table_name: r.rows for r in spark.read.parquet(f"{out}/manifest").collect()}
    assert counts["Fact_Tweets"] == 60 and counts["Model_Metrics"] == 4
    empty = scheduled_run.run(spark, posts(spark).where(F.lit(False)), loaded, lexicon, lemmas, out).first()
    assert empty.success and empty.tweet_count == 0
    # Texts are split into words for the scores once.
    plan = scheduled_run.label_posts(posts(spark), loaded, lexicon, lemmas)._jdf.queryExecution().toString()
    assert "posexplode" not in plan and plan.count("Scan parquet") >= 1
    failed = scheduled_run.run(spark, texts, loaded, lexicon, lemmas, out).first()
    assert not failed.success and failed.error_msg
    assert spark.read.parquet(f"{out}/runs").count() == 3


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    """The training set of the smallest tables, as relations and as sparse rows."""
    from moodloom.plans import catalog

    data = training.training_set(catalog.labeled(spark, SF))
    terms, parts = {}, {}
    for r in data.weighted.collect():
        terms.setdefault(r.tweet_id, []).append((r.idx, r.weight))
    for r in data.rows.collect():
        parts.setdefault(r.split, {})[r.tweet_id] = r.sentiment
    return data, terms, parts


def scaled_rows(terms, ids, scale):
    """(features, values) of each id, the intercept last."""
    rows = {}
    for i in ids:
        own = [(j, w / scale[j]) for j, w in terms.get(i, []) if j in scale]
        rows[i] = np.array([j for j, _ in own] + [-1]), np.array([x for _, x in own] + [1.0])
    return rows


def test_svc_equals_dual_descent_on_all_decided_rows(trained):
    data, terms, parts = trained
    train, test = parts["train"], parts["test"]
    scale = {}
    for i in train:
        for j, w in terms.get(i, []):
            scale[j] = max(scale.get(j, 0.0), w)
    rows = scaled_rows(terms, train, scale)
    ids, size = list(train), max(scale) + 2
    n_class = {s: sum(v == s for v in train.values()) for s in SENTIMENTS}
    cost = np.array([len(ids) / (3 * n_class[train[i]]) for i in ids])
    square = np.array([(rows[i][1] ** 2).sum() for i in ids]) + 1 / (2 * cost)
    weights = {}
    for s in SENTIMENTS:
        y = np.array([1.0 if train[i] == s else -1.0 for i in ids])
        alpha, w = np.zeros(len(ids)), np.zeros(size)
        for _ in range(5000):
            moved = 0.0
            for n, i in enumerate(ids):
                j, x = rows[i]
                new = max(0.0, alpha[n] - (y[n] * (x @ w[j]) - 1 + alpha[n] / (2 * cost[n])) / square[n])
                if new != alpha[n]:
                    moved = max(moved, abs(new - alpha[n]))
                    w[j] += (new - alpha[n]) * y[n] * x
                    alpha[n] = new
            if moved < 1e-9:
                break
        weights[s] = w
    model, predicted = training.fit_linear(data, "svc")
    assert model.error**2 / 2 < 1e-6  # the duality gap
    held_out, decided = scaled_rows(terms, test, scale), 0
    for r in predicted.withColumn("decided", classifiers.decided()).collect():
        j, x = held_out[r.tweet_id]
        margins = {s: x @ weights[s][j] for s in SENTIMENTS}
        for s in SENTIMENTS:
            assert r[f"margin_{s}"] == pytest.approx(margins[s], abs=1e-4)
        if r.decided:
            decided += 1
            assert r.prediction == max(margins, key=margins.get)
    assert decided > 0.95 * len(test)


def test_metrics_equal_plain_counts(trained):
    data, _, _ = trained
    predictions = {
        "Logistic Regression": training.fit_linear(data, "logistic")[1],
        "Naive Bayes": training.naive_bayes_predictions(data),
    }
    for name, predicted in predictions.items():
        rows = [(r.sentiment, r.prediction) for r in predicted.collect()]
        row = evaluation.model_row(predicted, name).first()
        n, figures = len(rows), [0.0, 0.0, 0.0]
        for s in SENTIMENTS:
            hit = sum(a == b == s for a, b in rows)
            actual, chosen = sum(a == s for a, _ in rows), sum(b == s for _, b in rows)
            for k, (over, under) in enumerate([(hit, chosen), (hit, actual), (2 * hit, actual + chosen)]):
                figures[k] += actual * (over / under if under else 0.0) / n
        assert row.accuracy == pytest.approx(100 * sum(a == b for a, b in rows) / n, abs=0.051)
        assert [row.precision, row.recall, row.f1] == pytest.approx([100 * f for f in figures], abs=0.051)
        assert row.accuracy > 100 * max(sum(a == s for a, _ in rows) for s in SENTIMENTS) / n


def test_weights_carry_label_and_split_so_that_training_joins_nothing_by_id(trained):
    data, _, parts = trained
    theta = training.naive_bayes_tables(data)[0]
    plan = theta._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # of the vocabulary and the sums by term
    for r in data.weighted.select("tweet_id", "sentiment", "split").distinct().collect():
        assert parts[r.split][r.tweet_id] == r.sentiment


def test_the_registered_comparison(spark):
    from moodloom.plans import catalog

    rows = {r.model: r for r in catalog.model_metrics(spark, SF).collect()}
    assert set(rows) == {"Logistic Regression", "SVM (LinearSVC)", "Naive Bayes"}
    assert [r.is_primary for r in rows.values()].count(True) == 1 and rows["Logistic Regression"].is_primary
    assert all(50 < r.accuracy <= 100 and 0 < r.f1 <= 100 for r in rows.values())
    tested = catalog.train_svc(spark, SF).collect()
    share = 100 * sum(r.prediction == r.sentiment for r in tested) / len(tested)
    assert rows["SVM (LinearSVC)"].accuracy == pytest.approx(share, abs=0.051)
