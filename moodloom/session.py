"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Of local sessions without a shared folder; removed when the interpreter ends.
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def get_spark(app: str = "moodloom", cpus: int | None = None) -> SparkSession:
    """The session of a run.

    With ``cpus`` a local one of that many threads. Without, master, memory and
    shuffle partitions stay what spark-submit or the cluster's defaults say.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if cpus is not None:
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g")
            .config("spark.sql.shuffle.partitions", str(cpus))
        )
    return builder.getOrCreate()


def _session_folder(spark: SparkSession) -> str:
    """This session's folder under ``spark.checkpoint.dir``, which all executors share."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.TemporaryDirectory(prefix="moodloom-", ignore_cleanup_errors=True)
        base = _local_folders[app].name
    return f"{base.rstrip('/')}/moodloom-{context.applicationId}"


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder path for intermediate tables.

    Lies under the shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to the machine's temporary folder.
    """
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release_workspace(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session; call it when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a relation that several later steps read, and read it back.

    The written table cuts the lineage: a lost executor costs a re-read, not a
    re-run of everything upstream.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
