"""Structured Streaming forms of collection, deduplication, scoring and volume."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from moodloom.operators.ingest import cap, collect, is_valid
from moodloom.operators.trends import volume_over_time
from moodloom.schemas import ARRIVING_TWEETS
from moodloom.sources.posts import posts_from
from moodloom.sources.tables import append_new, fresh_rows
from moodloom.streaming.partials import PartialStore, folders, written

CORRUPT = "_corrupt_record"


def read_json_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Arriving posts as JSON lines; unreadable lines keep their text in ``_corrupt_record``."""
    schema = StructType([*ARRIVING_TWEETS.fields, StructField(CORRUPT, StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Arriving posts from Kafka; needs the Kafka connector on the classpath."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    value = F.col("value").cast("string")
    return raw.select(
        F.from_json(value, ARRIVING_TWEETS).alias("post"), value.alias(CORRUPT)
    ).select("post.*", F.when(F.col("post").isNull(), F.col(CORRUPT)).alias(CORRUPT))


def read_posts_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The derived posts with ``events`` as the stream and ``documents`` as a static side.

    The pattern in the path lets the table be one file or a folder of part files.
    """
    reader = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(f"{sf_dir}/event[s].parquet")
    return posts_from(events, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sound(batch: DataFrame, quarantine_dir: str, batch_id: int) -> DataFrame:
    """The rows an insert can take; the others go to quarantine, in a folder of the batch."""
    good = is_valid()
    if CORRUPT in batch.columns:
        good = good & F.col(CORRUPT).isNull()
    batch.where(~good).write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}")
    return batch.where(good).select(ARRIVING_TWEETS.fieldNames())


def ingest_batch(table: str, quarantine_dir: str) -> Callable:
    """A micro-batch of collection: bad rows to quarantine, new first arrivals to the raw table.

    A batch that is run again after a failure adds nothing twice: ids already in the
    table are left out, and its quarantine folder is written anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read once for the quarantine and once for the insert.
        batch = batch.persist()
        append_new(batch.sparkSession, collect(_sound(batch, quarantine_dir, batch_id)), table)
        batch.unpersist()

    return write


def ingest_stream(
    stream: DataFrame,
    table: str,
    quarantine_dir: str,
    checkpoint_dir: str,
) -> DataStreamWriter:
    """Collect into the raw table ``table`` (see ``init_raw_table``), which knows ids of any age."""
    return (
        StreamReport.counted(stream).writeStream.foreachBatch(ingest_batch(table, quarantine_dir))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )


class Target:
    """Collection of the first ``target`` arrivals: what each batch added is kept beside the batches.

    The running total is a number for each batch, so no batch counts the table. A batch's rows are chosen and
    written before the table takes them, and read from there if the batch is run again.
    """

    def __init__(self, spark: SparkSession, table: str, quarantine_dir: str, state_dir: str, target: int):
        self.spark, self.table, self.quarantine_dir = spark, table, quarantine_dir
        self.state_dir, self.target = state_dir, target
        self.total = self._totals(None)

    def _totals(self, before: int | None) -> int:
        """What the batches before this one added, or all of them."""
        rows = 0
        for name in folders(self.spark, f"{self.state_dir}/added"):
            number = int(name.split("=")[1])
            if before is None or number < before:
                rows += self.spark.read.parquet(f"{self.state_dir}/added/{name}").first()["n"]
        return rows

    @property
    def reached(self) -> bool:
        return self.total >= self.target

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark, chosen = self.spark, f"{self.state_dir}/chosen/batch_id={batch_id}"
        added = f"{self.state_dir}/added/batch_id={batch_id}"
        before = self._totals(batch_id)
        if before >= self.target:
            self.total = before
            return
        if not written(spark, chosen):
            batch = batch.persist()
            fresh = fresh_rows(spark, collect(_sound(batch, self.quarantine_dir, batch_id)), self.table)
            cap(fresh, self.target - before).write.mode("overwrite").parquet(chosen)
            batch.unpersist()
        rows = spark.read.schema(spark.table(self.table).schema).parquet(chosen)
        append_new(spark, rows.drop("collected_at"), self.table)
        n = rows.count()
        spark.createDataFrame([(n,)], "n long").write.mode("overwrite").parquet(added)
        self.total = before + n


def collect_until(
    stream: DataFrame,
    table: str,
    quarantine_dir: str,
    checkpoint_dir: str,
    target: int,
    interval: str | None = None,
) -> int:
    """Collect until the table has had ``target`` first arrivals from this stream, then end the query.

    They are the first in the order of batches, and in a batch by ``arrival_seq``. The query also ends when all that
    waits is read, unless ``interval`` (as ``"10 seconds"``) makes it look for more. A later call goes on from the
    checkpoint, and starts nothing once the target is reached; posts read beyond a target are not collected later.
    Returns how many were collected over all calls.
    """
    spark = stream.sparkSession
    goal = Target(spark, table, quarantine_dir, f"{checkpoint_dir}-target", target)
    if goal.reached:
        return goal.total
    ended = _StopAtTarget(goal)
    spark.streams.addListener(ended)
    try:
        writer = stream.writeStream.foreachBatch(goal.write).option("checkpointLocation", checkpoint_dir)
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        query = writer.trigger(**trigger).start()
        while not query.awaitTermination(1):
            # The progress event of a batch says that it has been committed.
            if ended.seen.get(str(query.id)):
                query.stop()
        return goal.total
    finally:
        spark.streams.removeListener(ended)


FIRST, LAST = "first_batch", "last_batch"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of streams in RocksDB, with its changes as checkpoints: for state that grows with the stream."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def dedup_stream(stream: DataFrame) -> DataFrame:
    """One row per ``tweet_id`` for ever: that with the lowest ``arrival_seq`` of the batch in which the id first comes.

    To be written in update mode, which gives the ids that a batch touches; an id from an earlier batch is told by the
    times of the first and the last batch it came in, and left out. Null ids are one id. The state has a row for each id, with the columns of
    ``stream``: select few, and keep it on disk (``keep_state_on_disk``). Copies combine before the
    shuffle, so a hot id is no hot task.
    """
    others = [c for c in stream.columns if c != "tweet_id"]
    seen = stream.withColumn("_batch", F.current_timestamp()).groupBy("tweet_id").agg(
        F.min_by(F.struct(F.lit(0).alias("_"), *others), F.struct("_batch", "arrival_seq")).alias("row"),
        F.min("_batch").alias(FIRST),
        F.max("_batch").alias(LAST),
    )
    new = seen.where(F.col(FIRST) == F.col(LAST))
    return new.select(*[F.col("tweet_id") if c == "tweet_id" else F.col(f"row.{c}") for c in stream.columns])


def write_unique(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> DataStreamWriter:
    """The rows of ``dedup_stream``, a folder for each batch; one that is run again replaces its folder."""
    keep_state_on_disk(stream.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (
        dedup_stream(stream).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )


def volume_sums(spark: SparkSession, out_dir: str) -> PartialStore:
    return PartialStore(spark, out_dir, ["hour", "topic"], ["tweet_count"])


def volume_stream(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> DataStreamWriter:
    """Posts per hour and topic as partial counts of the batches, which ``volume`` sums.

    There is no state and no late row; a repeated batch replaces its counts, and counts of older batches are added up
    as they become many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = volume_sums(batch.sparkSession, out_dir)
        if not sums.settled(batch_id):
            sums.put(batch_id, volume_over_time(batch))

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )


def volume(spark: SparkSession, out_dir: str) -> DataFrame:
    """Posts per hour and topic over all batches so far."""
    total = volume_sums(spark, out_dir).total()
    return total if total is not None else spark.createDataFrame([], "hour timestamp, topic string, tweet_count long")


class StreamReport(StreamingQueryListener):
    """Counts observed rows and keeps how each query ended, for the run log."""

    @staticmethod
    def counted(stream: DataFrame) -> DataFrame:
        return stream.observe("arrived", F.count(F.lit(1)).alias("rows"))

    def total(self, query: StreamingQuery, patience: float = 30.0) -> int:
        """Rows of an ended query; waits until the events of its end have come in."""
        deadline = time.monotonic() + patience
        while str(query.id) not in self.ended and time.monotonic() < deadline:
            time.sleep(0.05)
        return self.rows.get(str(query.id), 0)

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self.rows[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:
        for metrics in event.progress.observedMetrics.values():
            self.rows[str(event.progress.id)] = self.rows.get(str(event.progress.id), 0) + metrics["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception


class _StopAtTarget(StreamReport):
    """Notes the queries that have committed a batch after the target was reached."""

    def __init__(self, goal: Target) -> None:
        super().__init__()
        self.goal, self.seen = goal, {}

    def onQueryProgress(self, event) -> None:
        self.seen[str(event.progress.id)] = self.goal.reached
