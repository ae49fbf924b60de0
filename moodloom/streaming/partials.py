"""Partial sums of a stream's batches, kept as few written parts.

Each batch puts one part. When a level has ``FAN`` parts, they are added up into one of the next level, so n batches
leave about FAN log n parts, and a row is written once for each level. The newest batch stays by itself: it is the
only one that a stream can run again, and its part is then replaced. Which parts count is said by the
newest listing; listings are written whole, and parts are deleted only after the one without them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from moodloom.operators.cube import added

FAN = 8


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    at, files = _path(spark, f"{path}/_SUCCESS")
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, files = _path(spark, path)
    files.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables under a folder that were written to their end."""
    at, files = _path(spark, path)
    names = [str(s.getPath().getName()) for s in files.listStatus(at)] if files.exists(at) else []
    return sorted(n for n in names if written(spark, f"{path}/{n}"))


@dataclass(frozen=True)
class Part:
    name: str  # of the batch or change; of the folder if it was added up
    folder: str
    level: int
    last_batch: int


class PartialStore:
    """Parts of sums (``sums``) by ``keys`` under a folder; one stream writes at a time."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: list[str], fan: int = FAN):
        self.spark, self.path, self.keys, self.sums, self.fan = spark, path, keys, sums, fan

    def _versions(self) -> list[int]:
        return sorted(map(int, folders(self.spark, f"{self.path}/listing")))

    def parts(self) -> list[Part]:
        """The parts that count; there are few."""
        versions = self._versions()
        if not versions:
            return []
        rows = self.spark.read.parquet(f"{self.path}/listing/{versions[-1]}").collect()
        return sorted((Part(*r) for r in rows), key=lambda p: (p.level, p.last_batch, p.name))

    def _list(self, parts: list[Part]) -> None:
        versions = self._versions()
        version = versions[-1] + 1 if versions else 0
        rows = [(p.name, p.folder, p.level, p.last_batch) for p in parts]
        table = self.spark.createDataFrame(rows, "name string, folder string, level int, last_batch long")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/listing/{version}")
        for old in versions:
            delete(self.spark, f"{self.path}/listing/{old}")

    def _write(self, partial: DataFrame) -> str:
        folder = f"{self.path}/parts/{uuid.uuid4().hex}"
        partial.select(*self.keys, *self.sums).write.parquet(folder)
        return folder

    def _added(self, parts: list[Part]) -> DataFrame:
        return added([self.spark.read.parquet(p.folder) for p in parts], self.keys, self.sums)

    def settled(self, batch_id: int) -> bool:
        """Whether the batch's part has been added up with others, so that it can be replaced no more."""
        parts = self.parts()
        return any(p.level > 0 and batch_id <= p.last_batch for p in parts) and not any(
            p.name == str(batch_id) for p in parts
        )

    def put(self, batch_id: int, partial: DataFrame, name: str | None = None) -> None:
        """Adds a part, in place of one of the same name: that of the batch unless another is given."""
        name = str(batch_id) if name is None else name
        parts = self.parts()
        replaced = [p for p in parts if p.name == name]
        kept = [p for p in parts if p.name != name] + [Part(name, self._write(partial), 0, batch_id)]
        self._list(kept)
        for p in replaced:
            delete(self.spark, p.folder)
        self._compact(kept)

    def _compact(self, parts: list[Part]) -> None:
        newest = max(p.last_batch for p in parts)
        for level in range(max(p.level for p in parts) + 1):
            full = [p for p in parts if p.level == level and (level or p.last_batch < newest)]
            if len(full) < self.fan:
                continue
            folder = self._write(self._added(full).coalesce(1 + len(full) // self.fan))
            merged = Part(folder.rsplit("/", 1)[-1], folder, level + 1, max(p.last_batch for p in full))
            parts = [p for p in parts if p not in full] + [merged]
            self._list(parts)
            for p in full:
                delete(self.spark, p.folder)

    def total(self) -> DataFrame | None:
        """The sums of all that was put, or None before the first part."""
        parts = self.parts()
        return self._added(parts) if parts else None
