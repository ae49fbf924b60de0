import json
import time

from pyspark.sql import functions as F

import pytest

from moodloom.functions import dictionaries as words
from moodloom.operators.ingest import with_topic
from moodloom.operators.preprocess import seed_lemmas
from moodloom.plans import catalog
from moodloom.sources.tables import init_raw_table
from moodloom.streaming import posts as stream
from moodloom.streaming import runs

SF = "/root/testdata/sf0.001"


def write_files(folder, batches):
    folder.mkdir()
    for i, lines in enumerate(batches):
        (folder / f"{i}.json").write_text("\n".join(lines))
        time.sleep(0.02)


def post(seq, tweet_id, text="hello NBA", hour=1, lang="en"):
    return json.dumps(
        {"arrival_seq": seq, "tweet_id": tweet_id, "username": "u", "text": text, "lang": lang,
         "retweet_count": 1, "created_at": f"2024-01-01T{hour:02d}:00:00Z"}
    )


def test_ingest_across_batches(spark, tmp_path):
    write_files(
        tmp_path / "in",
        [
            [post(1, "a"), post(2, "a", "later"), "{not json", post(3, "b", lang=None)],
            [post(4, "a", "again"), post(5, "c", "RT no"), post(6, None), post(7, "d")],
        ],
    )
    report = stream.StreamReport()
    spark.streams.addListener(report)
    source = stream.read_json_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    bad = str(tmp_path / "bad")
    init_raw_table(spark, "raw_batches", 4, str(tmp_path / "out"))
    query = stream.ingest_stream(source, "raw_batches", bad, str(tmp_path / "progress")).start()
    query.awaitTermination()
    rows = spark.table("raw_batches").orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.tweet_id, r.lang, r.topic) for r in rows] == [
        (1, "a", "en", "Sports"), (3, "b", "en", "Sports"), (7, "d", "en", "Sports"),
    ]
    assert rows[0].like_count == 0 and rows[0].collected_at is not None
    assert spark.read.parquet(bad).count() == 2
    assert report.total(query) == 8 and report.ended[str(query.id)] is None
    spark.streams.removeListener(report)


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    source = spark.createDataFrame([(1, "a", "hello"), (2, None, "x")], "arrival_seq long, tweet_id string, text string")
    for name, kind in (("username", "string"), ("lang", "string"), ("retweet_count", "int"), ("like_count", "int"), ("created_at", "timestamp")):
        source = source.withColumn(name, F.lit(None).cast(kind))
    init_raw_table(spark, "raw_repeated", 4, str(tmp_path / "out"))
    write = stream.ingest_batch("raw_repeated", str(tmp_path / "bad"))
    for _ in range(2):
        write(source, 7)
    assert spark.table("raw_repeated").count() == 1 and spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_collection_ends_at_its_target_over_files_and_a_restart(spark, tmp_path):
    lines = [[post(10 * f + i, f"{f}-{i}") for i in range(3)] + [post(10 * f + 5, "0-0"), "{bad"] for f in range(4)]
    write_files(tmp_path / "in", lines[:1])
    init_raw_table(spark, "raw_target", 4, str(tmp_path / "out"))
    source = stream.read_json_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    where = "raw_target", str(tmp_path / "bad"), str(tmp_path / "p")

    def rows():
        return [r.tweet_id for r in spark.table("raw_target").orderBy("arrival_seq").collect()]

    # The first call ends with its input, the next goes on where it stopped.
    assert stream.collect_until(source, *where, target=5) == 3 and len(rows()) == 3
    for i, file in enumerate(lines[1:], 1):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(file))
        time.sleep(0.02)
    assert stream.collect_until(source, *where, target=5, interval="100 milliseconds") == 5
    assert rows() == ["0-0", "0-1", "0-2", "1-0", "1-1"] and not spark.streams.active
    # Once reached, nothing is started.
    assert stream.collect_until(source, *where, target=5) == 5 and len(rows()) == 5


def test_a_repeated_batch_does_not_pass_the_target(spark, tmp_path):
    source = spark.read.schema(stream.ARRIVING_TWEETS)
    (tmp_path / "in.json").write_text("\n".join(post(i, str(i)) for i in range(6)))
    batch = source.json(str(tmp_path / "in.json"))
    init_raw_table(spark, "raw_target_again", 4, str(tmp_path / "out"))
    goal = stream.Target(spark, "raw_target_again", str(tmp_path / "bad"), str(tmp_path / "state"), 4)
    goal.write(batch.where("arrival_seq < 3"), 0)
    for _ in range(2):
        goal.write(batch, 1)
        assert goal.reached and goal.total == 4
        assert [r.arrival_seq for r in spark.table("raw_target_again").orderBy("arrival_seq").collect()] == [0, 1, 2, 3]
    again = stream.Target(spark, "raw_target_again", str(tmp_path / "bad"), str(tmp_path / "state"), 4)
    assert again.reached


def test_an_id_comes_once_for_ever(spark, tmp_path):
    """Over batches, restarts and any time of the posts; of a batch's copies the first stays."""
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    (tmp_path / "in").mkdir()
    files = [
        [post(3, "a"), post(2, "a", "first"), post(4, "b")],
        [post(1, "a", "earlier, but later"), post(5, "c")],
        [post(6, "b"), post(7, None), post(8, None)],
        [post(9, None), post(10, "a"), post(11, "d"), post(12, "d")],
    ]
    for i, lines in enumerate(files):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(lines))
        source = stream.read_json_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        source = source.select("tweet_id", "arrival_seq", "text")
        stream.write_unique(source, out, progress).start().awaitTermination()
    rows = sorted(((r.tweet_id or "", r.arrival_seq) for r in spark.read.parquet(out).collect()))
    assert rows == [("", 7), ("a", 2), ("b", 4), ("c", 5), ("d", 11)]
    state = spark.read.format("statestore").load(progress).count()
    assert state == 5


def test_volume_sums_batches(spark, tmp_path):
    write_files(tmp_path / "in", [[post(1, "a", hour=9), post(2, "b", hour=2)], [post(3, "c"), post(4, "d", "x", 2), post(5, "e", hour=9)]])
    source = with_topic(stream.read_json_stream(spark, str(tmp_path / "in"), files_per_batch=1))
    out = str(tmp_path / "out")
    stream.volume_stream(source, out, str(tmp_path / "p")).start().awaitTermination()
    got = {(r.hour.hour, r.topic): r.tweet_count for r in stream.volume(spark, out).collect()}
    assert got == {(9, "Sports"): 2, (2, "Sports"): 1, (1, "Sports"): 1, (2, "General"): 1}


@pytest.fixture(scope="module")
def four_files(spark, tmp_path_factory):
    """The smallest tables with ``events`` as a folder of files in mixed time order; a pair of copies stays in a file."""
    folder = tmp_path_factory.mktemp("tables")
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("part", F.floor(F.col("event_id") / 2) * 7 % 4)
    (folder / "events.parquet").mkdir()
    for part in (2, 0, 3, 1):
        piece = folder / f"part{part}"
        events.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(str(piece))
        (next(piece.glob("part-*.parquet"))).rename(folder / "events.parquet" / f"{part}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def same_rows(a, b):
    columns = sorted(a.columns)
    return sorted(map(repr, a.select(columns).collect())) == sorted(map(repr, b.select(columns).collect()))


def test_streams_of_several_files_equal_their_batch_forms(spark, four_files, monkeypatch):
    monkeypatch.setattr(catalog, "FILES_PER_BATCH", 1)
    assert spark.read.parquet(f"{four_files}/events.parquet").count() == 1000
    volume = catalog.stream_volume(spark, four_files)
    assert same_rows(volume, catalog.volume_over_time(spark, SF))
    assert volume.agg(F.sum("tweet_count")).first()[0] == 1000
    ids = [r.tweet_id for r in catalog.stream_dedup(spark, four_files).collect()]
    assert len(ids) == len(set(ids)) == 980
    raw = catalog.collected(spark, SF).select("arrival_seq", "tweet_id", "topic", "lang", "retweet_count", "like_count")
    assert same_rows(catalog.stream_ingest(spark, four_files), raw)


def test_incremental_run_equals_the_batch_form(spark, four_files, tmp_path):
    expected = catalog.vader_label(spark, SF)
    model = catalog._saved_model(spark, SF)
    lexicon, lemmas = words.seed_lexicon(spark), seed_lemmas(spark)
    init_raw_table(spark, "raw_incremental", 4, str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    metrics = spark.createDataFrame([("m", 1.0)], "model string, accuracy double")

    def run():
        source = stream.read_posts_stream(spark, four_files, files_per_batch=1)
        return runs.run_pending(source, "raw_incremental", model, lexicon, lemmas, out, metrics).first()

    log = run()
    assert (log.success, log.tweet_count, log.error_msg) == (True, 1000, None)
    labeled = spark.read.parquet(f"{out}/labeled")
    assert labeled.select("batch_id").distinct().count() == 4
    assert same_rows(labeled.select("tweet_id", "vader_compound", F.col("vader_sentiment").alias("sentiment")), expected)
    counts = {r.table_name: r.rows for r in spark.read.parquet(f"{out}/manifest").collect()}
    assert counts["Fact_Tweets"] == 819 and counts["Model_Metrics"] == 1 and len(counts) == 5
    # Nothing new waits: nothing is labeled again. A batch that comes twice finds its rows written.
    again = run()
    assert (again.success, again.tweet_count) == (True, 0) and labeled.count() == 819
    batch = catalog.posts(spark, SF).limit(0)
    runs.label_batch("raw_incremental", model, lexicon, lemmas, out)(batch, 0)
    assert spark.read.parquet(f"{out}/labeled").count() == 819 and spark.table("raw_incremental").count() == 923
    assert spark.read.parquet(f"{out}/runs").count() == 2


def test_failure_of_an_incremental_run_is_logged(spark, four_files, tmp_path):
    source = stream.read_posts_stream(spark, four_files)
    log = runs.run_pending(source, "no_such_table", None, None, None, str(tmp_path / "out")).first()
    assert not log.success and "no_such_table" in log.error_msg
