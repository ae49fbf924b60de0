"""Reports from partial sums against the reports of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from moodloom.functions import dictionaries as words
from moodloom.functions.dates import with_time_columns
from moodloom.operators import cube, marts
from moodloom.operators.preprocess import seed_lemmas
from moodloom.plans import catalog
from moodloom.schemas import SENTIMENTS
from moodloom.sources.tables import init_raw_table
from moodloom.streaming import partials, runs
from tests.test_streaming import same_rows

SF = "/root/testdata/sf0.001"


def labeled(spark, seed, n=300):
    """Labeled posts with every column missing now and then."""
    rng = random.Random(seed)

    def some(value):
        return None if rng.random() < 0.08 else value

    rows = [
        (
            some(str(i)), some(rng.choice(["AI", "Sports"])), some(rng.choice(SENTIMENTS)), some(round(rng.uniform(-1, 1), 4)),
            some(round(rng.random(), 4)), some(rng.randint(0, 9)), some(rng.randint(0, 9)), 5,
            some(dt.datetime(2024, 1, rng.randint(1, 4), rng.randrange(24))),
        )
        for i in range(n)
    ]
    names = (
        "tweet_id string, topic string, sentiment string, vader_compound double, confidence double, "
        "like_count int, retweet_count int, word_count int, created_at timestamp"
    )
    return with_time_columns(spark.createDataFrame(rows, names)).persist()


REPORTS = {**cube.REPORTS, "distribution": cube.sentiment_distribution}
PLAIN = {**marts.MARTS, "distribution": marts.sentiment_distribution}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_of_summed_cubes(spark, name):
    rows = labeled(spark, 1)
    cut = [rows.where(F.coalesce(F.col("like_count"), F.lit(0)) % 3 == k) for k in range(3)]
    extra = labeled(spark, 2, 50)
    parts = [cube.cube(c) for c in cut] + [cube.cube(extra), cube.negated(cube.cube(extra))]
    total = cube.added(parts)
    report, plain = REPORTS[name](total), PLAIN[name](rows)
    assert same_rows(report, plain)
    assert same_rows(total, cube.cube(rows))
    assert [f.dataType for f in report.select(sorted(report.columns)).schema] == [
        f.dataType for f in plain.select(sorted(plain.columns)).schema
    ]


def test_no_posts(spark):
    none = labeled(spark, 1).limit(0)
    for name, report in REPORTS.items():
        assert report(cube.cube(none)).collect() == PLAIN[name](none).collect() == []


def test_parts_are_added_up_level_by_level(spark, tmp_path):
    sums = partials.PartialStore(spark, str(tmp_path), ["k"], ["n"], fan=2)
    assert sums.total() is None and not sums.settled(0)
    expected, most = {}, 0
    for batch in range(6):
        rows = [(f"k{batch % 4}", batch), (None, 1), (f"only{batch}", 1)]
        table = spark.createDataFrame(rows, "k string, n long")
        sums.put(batch, table)
        if batch % 3 == 1:
            sums.put(batch, table)  # run again
        for k, n in rows:
            expected[k] = expected.get(k, 0) + n
        most = max(most, len(sums.parts()))
        assert not sums.settled(batch)
    assert {r.k: r.n for r in sums.total().collect()} == {k: n for k, n in expected.items() if n}
    assert most <= 8 and max(p.level for p in sums.parts()) >= 2 and sums.settled(0)
    assert len(list((tmp_path / "parts").iterdir())) == len(sums.parts())
    assert len(list((tmp_path / "listing").iterdir())) == 1
    sums.put(6, spark.createDataFrame([("only3", -1)], "k string, n long"), "taken back")
    assert "only3" not in {r.k for r in sums.total().collect()}


@pytest.fixture(scope="module")
def words_and_model(spark):
    return catalog._saved_model(spark, SF), words.seed_lexicon(spark), seed_lemmas(spark)


def test_five_batches_equal_the_batch_reports(spark, words_and_model, tmp_path, monkeypatch):
    monkeypatch.setattr(partials, "FAN", 2)
    monkeypatch.setattr(runs, "report_sums", lambda s, out: partials.PartialStore(s, f"{out}/cube", cube.KEYS, cube.SUMS, 2))
    model, lexicon, lemmas = words_and_model
    init_raw_table(spark, "raw_five", 4, str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    posts = catalog.posts(spark, SF).persist()
    write = runs.label_batch("raw_five", model, lexicon, lemmas, out)
    counted = []
    for batch in range(5):
        rows = posts.where(F.col("arrival_seq") % 5 == batch)
        write(rows, batch)
        if batch == 2:
            write(rows, batch)
        counted.append(spark.read.parquet(f"{out}/labeled").count())
        if batch in (1, 4):
            runs.publish(spark, out)
            check(spark, out)
    assert counted == sorted(counted) and counted[-1] > 800
    write(posts, 0)  # long settled
    check(spark, out)
    assert spark.read.parquet(f"{out}/labeled").count() == counted[-1]


def check(spark, out):
    """The published tables against the reports of all labeled rows."""
    rows = spark.read.parquet(f"{out}/labeled").drop("batch_id")
    for name in cube.REPORTS:
        assert same_rows(spark.read.parquet(f"{out}/marts/{name}"), marts.MARTS[name](rows)), name
    assert same_rows(spark.read.parquet(f"{out}/marts/Fact_Tweets").drop("batch_id"), marts.fact_tweets(rows))
    assert partials.folders(spark, f"{out}/touched") == []


def test_a_run_writes_only_touched_dates_and_reads_no_old_post(spark, words_and_model, tmp_path):
    model, lexicon, lemmas = words_and_model
    init_raw_table(spark, "raw_touched", 4, str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    posts = catalog.posts(spark, SF)
    late = F.to_date("created_at") >= "2024-01-20"
    write = runs.label_batch("raw_touched", model, lexicon, lemmas, out)
    write(posts.where(~late), 0)
    runs.publish(spark, out)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/marts/Daily_Sentiment").rglob("*.parquet")}
    write(posts.where(late), 1)
    hidden = tmp_path / "out/labeled/batch_id=0"
    for part in hidden.glob("*.parquet"):
        part.write_bytes(b"unreadable")
    runs.publish(spark, out)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out/marts/Daily_Sentiment").rglob("*.parquet")}
    assert set(before) < set(after) and all(after[p] == t for p, t in before.items())
    days = spark.read.parquet(f"{out}/marts/Daily_Sentiment").select("date").distinct().count()
    assert days == posts.select(F.to_date("created_at")).distinct().count()


def test_relabeling_takes_the_old_labels_back(spark, words_and_model, tmp_path):
    model, lexicon, lemmas = words_and_model
    init_raw_table(spark, "raw_relabel", 4, str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    posts = catalog.posts(spark, SF).persist()
    write = runs.label_batch("raw_relabel", model, lexicon, lemmas, out)
    for batch in range(3):
        write(posts.where(F.col("arrival_seq") % 3 == batch), batch)
    runs.publish(spark, out)
    # All texts become neutral.
    swapped = model.coefficients.withColumn("neutral", F.col("neutral") + F.when(F.col("idx") == -1, 1e6).otherwise(0.0))
    other = type(model)(model.vocabulary, swapped, model.kind, model.error)
    first = runs.report_sums(spark, out).total().collect()
    for _ in range(2):  # the second changes nothing
        runs.relabel(spark, 0, "neutral", other, lexicon, lemmas, out)
    runs.publish(spark, out)
    check(spark, out)
    rows = spark.read.parquet(f"{out}/labeled")
    assert {r[0] for r in rows.where("batch_id = 0").select("sentiment").distinct().collect()} == {"neutral"}
    runs.relabel(spark, 0, "back", model, lexicon, lemmas, out)
    runs.publish(spark, out)
    check(spark, out)
    assert sorted(map(repr, runs.report_sums(spark, out).total().collect())) == sorted(map(repr, first))
