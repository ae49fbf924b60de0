"""The incremental run: label what arrived since the last one, bring the reports up to date, log.

A batch adds its posts to the table of posts and its cube (see ``operators.cube``) to the partial sums. A run then
reads the cube, not the posts, and of the daily report it writes the dates that the batches touched.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodloom.operators import cube as cubes
from moodloom.operators.classifiers import SentimentModel
from moodloom.operators.ingest import collect
from moodloom.operators.marts import fact_tweets
from moodloom.plans.scheduled_run import label_posts, log_run
from moodloom.sources.tables import append_new, fresh_rows
from moodloom.streaming.partials import PartialStore, delete, folders, written
from moodloom.streaming.posts import StreamReport, _sound


def report_sums(spark: SparkSession, out_dir: str) -> PartialStore:
    return PartialStore(spark, f"{out_dir}/cube", cubes.KEYS, cubes.SUMS)


def _put(spark: SparkSession, out_dir: str, batch_id: int, partial: DataFrame, name: str | None = None) -> None:
    """The sums of a batch or change; the dates it touches are noted first, so a failure cannot hide them."""
    partial = partial.persist()  # a few rows for each date
    noted = f"{out_dir}/touched/{batch_id if name is None else name}"
    partial.select("date").distinct().coalesce(1).write.mode("overwrite").parquet(noted)
    report_sums(spark, out_dir).put(batch_id, partial, name)
    partial.unpersist()


def _write_labeled(labeled: DataFrame, out_dir: str, batch_id: int) -> DataFrame:
    """The batch's labeled posts and its part of the table of posts; returns the former as written."""
    path = f"{out_dir}/labeled/batch_id={batch_id}"
    labeled.write.mode("overwrite").parquet(path)
    rows = labeled.sparkSession.read.schema(labeled.schema).parquet(path)
    fact_tweets(rows).write.mode("overwrite").parquet(f"{out_dir}/marts/Fact_Tweets/batch_id={batch_id}")
    return rows


def label_batch(
    table: str, model: SentimentModel, lexicon: DataFrame, lemmas: DataFrame, out_dir: str
):
    """A micro-batch: its first arrivals to the raw table, their labels to a folder of the batch, its sums.

    The batch's new rows are written before the table takes them, and read from there if
    the batch is run again, so a failure at any point loses and repeats nothing. A batch whose sums have been added
    up with others came to its end long ago; nothing is done for it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if report_sums(spark, out_dir).settled(batch_id):
            return
        fresh = f"{out_dir}/fresh/batch_id={batch_id}"
        if not written(spark, fresh):
            batch = batch.persist()
            arriving = collect(_sound(batch, f"{out_dir}/quarantine", batch_id))
            fresh_rows(spark, arriving, table).write.mode("overwrite").parquet(fresh)
            batch.unpersist()
        rows = spark.read.schema(spark.table(table).schema).parquet(fresh)
        append_new(spark, rows.drop("collected_at"), table)
        labeled = _write_labeled(label_posts(rows, model, lexicon, lemmas), out_dir, batch_id)
        _put(spark, out_dir, batch_id, cubes.cube(labeled))

    return write


def relabel(
    spark: SparkSession,
    batch_id: int,
    change: str,
    model: SentimentModel,
    lexicon: DataFrame,
    lemmas: DataFrame,
    out_dir: str,
) -> None:
    """Label a batch anew: its old sums are taken back, the new ones added, and its posts replaced.

    ``change`` names the change. It can be run again under its name after a failure at any point.
    """
    name = f"{change}-{batch_id}"
    ready = f"{out_dir}/relabeled/{name}"
    if written(spark, f"{ready}/done"):
        return
    fresh = spark.read.parquet(f"{out_dir}/fresh/batch_id={batch_id}")
    if not written(spark, f"{ready}/rows"):
        label_posts(fresh, model, lexicon, lemmas).write.mode("overwrite").parquet(f"{ready}/rows")
    new = spark.read.parquet(f"{ready}/rows")
    if not written(spark, f"{ready}/sums"):
        # The old labels stay until these are written.
        old = spark.read.schema(new.schema).parquet(f"{out_dir}/labeled/batch_id={batch_id}")
        both = cubes.added([cubes.cube(new), cubes.negated(cubes.cube(old))])
        both.write.mode("overwrite").parquet(f"{ready}/sums")
    if not written(spark, f"{ready}/put"):
        sums = spark.read.parquet(f"{ready}/sums")
        _put(spark, out_dir, batch_id, sums, name)
        spark.range(1).write.mode("overwrite").parquet(f"{ready}/put")
    _write_labeled(new, out_dir, batch_id)
    spark.range(1).write.mode("overwrite").parquet(f"{ready}/done")


def publish(spark: SparkSession, out_dir: str, metrics: DataFrame | None = None) -> DataFrame:
    """Bring the report tables up to date from the sums; returns the manifest ``(table_name, rows)``.

    Only the touched dates of the daily report are written. The other reports have as many rows as there are
    topics and hours. Reads no post.
    """
    marts, touched = f"{out_dir}/marts", f"{out_dir}/touched"
    total = report_sums(spark, out_dir).total()
    total = total.coalesce(1).persist()  # bounded by the calendar
    noted = folders(spark, touched)
    dates = set()
    for name in noted:
        dates |= {r["date"] for r in spark.read.schema("date date").parquet(f"{touched}/{name}").collect()}
    dates = sorted(d for d in dates if d is not None)
    daily = cubes.daily_sentiment(total)
    if dates:
        now = daily.where(F.col("date").isin(dates)).coalesce(1).persist()
        now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(
            f"{marts}/Daily_Sentiment"
        )
        left = {r["date"] for r in now.select("date").distinct().collect()}
        for gone in set(dates) - left:
            delete(spark, f"{marts}/Daily_Sentiment/date={gone}")
        now.unpersist()
    tables = {"Topic_KPIs": cubes.topic_kpis(total), "Hourly_Heatmap": cubes.hourly_heatmap(total)}
    if metrics is not None:
        tables["Model_Metrics"] = metrics
    manifest = [("Fact_Tweets", total.agg(F.sum("posts")).first()[0] or 0), ("Daily_Sentiment", daily.count())]
    for name, report in tables.items():
        report.coalesce(1).write.mode("overwrite").parquet(f"{marts}/{name}")
        manifest.append((name, spark.read.parquet(f"{marts}/{name}").count()))
    total.unpersist()
    for name in noted:
        delete(spark, f"{touched}/{name}")
    return spark.createDataFrame(manifest, "table_name string, rows long")


def run_pending(
    stream: DataFrame,
    table: str,
    model: SentimentModel,
    lexicon: DataFrame,
    lemmas: DataFrame,
    out_dir: str,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """Process all that waits in the stream, bring the report tables up to date and log the run.

    Only new rows are prepared, scored, classified and counted; the reports cover every labeled row so far, of
    which none is read again. Returns the log row, with the count of rows read and, after a failure, its text.
    """
    spark, started = stream.sparkSession, datetime.now(timezone.utc)
    report = StreamReport()
    spark.streams.addListener(report)
    try:
        query = (
            StreamReport.counted(stream)
            .writeStream.foreachBatch(label_batch(table, model, lexicon, lemmas, out_dir))
            .option("checkpointLocation", f"{out_dir}/progress")
            .trigger(availableNow=True)
            .start()
        )
        error = None
        try:
            query.awaitTermination()
            # Also after a run that ended between its batches and its reports.
            if folders(spark, f"{out_dir}/touched"):
                publish(spark, out_dir, metrics).write.mode("overwrite").parquet(f"{out_dir}/manifest")
        except Exception as failure:  # logged, as in a scheduled run
            error = str(failure)
        return log_run(spark, f"{out_dir}/runs", started, report.total(query), error is None, error)
    finally:
        spark.streams.removeListener(report)
