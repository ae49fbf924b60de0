"""Line dedup: repeated runs of lines found with a suffix array over line IDs.

Every line with a word gets an ID by its trimmed text, so a document is a sequence of IDs.
Suffixes of all documents are ranked by prefix doubling: rank k is the place of a suffix
in the order of its first 2^k lines. A round joins each rank with the one 2^k lines on, sorts
the distinct pairs over all machines and numbers them in that order. A pair that occurs once
leaves the race, since no repeated run begins there; the tables shrink fast.

Suffixes that share their first m lines are neighbours in the suffix array: a
longest-common-prefix interval. For each line the shortest run of ``min_words`` words that
begins there, and the one that ends there, are looked up as an interval: with 2^k <= m < 2^(k+1)
it is the suffixes with equal ranks k at the run's first line and at its last 2^k lines. The
first member of an interval is kept, later ones that do not overlap it are marked. A
maximal repeated run is the union of such runs, so the marked lines are those of all
maximal repeated runs of ``min_words`` words or more that have an earlier copy.

A run has at most ``min_words`` lines, which bounds the number of rounds. All tables but
the texts have a few numbers per line; those for line IDs and pairs are aggregated before joins, and
hot lines are rows of the larger side of a join only, which Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.session import materialize

HOT_SHARE = 1_000
MIN_WORDS = 50


def _min_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the last line of the shortest run from it, the first line of the shortest run to it.

    The count of lines and -1 stand for runs that do not exist.
    """
    after = np.cumsum(words)
    before = after - words
    last = np.searchsorted(after, before + min_words, side="left")
    first = np.searchsorted(before, after - min_words, side="right") - 1
    return last, np.where(after >= min_words, first, -1)


def line_runs(docs: DataFrame, id_col: str, min_words: int) -> DataFrame:
    """A row for each line with a word: its ID and the two shortest runs at it."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        "doc {0}, ver bigint, seq int, hi bigint, lo bigint, runs array<struct<seq:int,m:int,first:int,last:int>>"
    ).format(id_type)
    run_type = pa.list_(
        pa.struct([("seq", pa.int32()), ("m", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                owner, seqs, names, runs = [], [], [], []
                for row, text in enumerate(part.column(2).to_pylist()):
                    lines, counts, places = [], [], []
                    every = text.split("\n")
                    for place, line in enumerate(every):
                        n = len(line.split())
                        if n:
                            lines.append(xxhash.xxh3_128_digest(line.strip().encode()))
                            counts.append(n)
                            places.append(place)
                    if not lines:
                        continue
                    places.append(len(every))
                    last, first = _min_runs(np.array(counts), min_words)
                    for i, (end, start) in enumerate(zip(last.tolist(), first.tolist())):
                        found = []
                        if end < len(lines):
                            found.append((i, end - i + 1, places[i], places[end + 1] - 1))
                        if start >= 0 and last[start] != i:
                            found.append((start, i - start + 1, places[start], places[i + 1] - 1))
                        runs.append([dict(zip(("seq", "m", "first", "last"), f)) for f in found])
                    owner += [row] * len(lines)
                    seqs += range(len(lines))
                    names += lines
                pair = np.frombuffer(b"".join(names), dtype=np.int64).reshape(-1, 2)
                take = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(take),
                        part.column(1).take(take),
                        pa.array(seqs, pa.int32()),
                        pa.array(pair[:, 0].copy()),
                        pa.array(pair[:, 1].copy()),
                        pa.array(runs, run_type),
                    ],
                    names=["doc", "ver", "seq", "hi", "lo", "runs"],
                )

    texts = docs.where(F.col("text").isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64("text").alias("ver"), "text"
    )
    return texts.mapInArrow(split, schema)


def _rank(rows: DataFrame, names: list[str], label: str) -> DataFrame:
    """Rank of each value of ``names`` that occurs more than once, in their order over all machines."""
    repeated = rows.groupBy(*names).count().where("count > 1").drop("count")
    return materialize(repeated.orderBy(*names).withColumn("rank", F.monotonically_increasing_id()), label)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, ver, lines): the numbers of the lines to delete from a document; none, no row."""
    key = ["doc", "ver"]
    # The same row twice is one document, not a copy of another.
    lines = materialize(line_runs(docs, id_col, min_words).dropDuplicates([*key, "seq"]), "lines")
    ranks = _rank(lines, ["hi", "lo"], "rank0")
    level = materialize(lines.join(ranks, ["hi", "lo"]).select(*key, "seq", "rank"), "level0")
    runs = lines.select(*key, F.explode("runs").alias("run")).select(*key, "run.*")
    named, k = None, 0
    while True:
        span = 1 << k
        sized = runs.where((F.col("m") >= span) & (F.col("m") < 2 * span))
        sized = sized.withColumn("tail", F.col("seq") + F.col("m") - span)
        head = level.withColumnRenamed("rank", "a").withColumnRenamed("doc", "d")
        tail = level.withColumnRenamed("rank", "b").withColumnRenamed("seq", "tail")
        at_head = F.col("doc").eqNullSafe(F.col("d")) & (F.col("ver") == F.col("v")) & (F.col("seq") == F.col("s"))
        found = sized.join(head.withColumnRenamed("ver", "v").withColumnRenamed("seq", "s"), at_head).drop("d", "v", "s")
        tail = tail.select(F.col("doc").alias("d"), F.col("ver").alias("v"), F.col("tail").alias("t"), "b")
        at_tail = F.col("doc").eqNullSafe(F.col("d")) & (F.col("ver") == F.col("v")) & (F.col("tail") == F.col("t"))
        found = found.join(tail, at_tail).select(*key, "seq", "m", "first", "last", "a", "b")
        named = found if named is None else named.unionByName(found)
        if 2 * span > min_words:
            break
        ahead = level.select(
            F.col("doc").alias("d"), F.col("ver").alias("v"), (F.col("seq") - span).alias("s"), F.col("rank").alias("b")
        )
        follows = F.col("doc").eqNullSafe(F.col("d")) & (F.col("ver") == F.col("v")) & (F.col("seq") == F.col("s"))
        pairs = materialize(
            level.join(ahead, follows).select(*key, "seq", F.col("rank").alias("a"), "b"), f"pairs{k}"
        )
        k += 1
        ranks = _rank(pairs, ["a", "b"], f"rank{k}")
        level = materialize(pairs.join(ranks, ["a", "b"]).select(*key, "seq", "rank"), f"level{k}")
    named = materialize(named, "runs")
    interval = ["m", "a", "b"]
    place = F.struct(*key, "seq")
    firsts = (
        named.groupBy(*interval)
        .agg(F.min(place).alias("kept"), F.max(place).alias("end"), F.count(F.lit(1)).alias("n"))
        .where("kept <> end")
        .drop("end")
    )
    firsts = materialize(firsts, "firsts")
    # An interval with more than a thousandth of all runs would be a task of its own; there are less than a thousand.
    is_hot = F.col("n") * HOT_SHARE > named.count()
    hot = firsts.where(is_hot).select(*interval, "kept")
    marked = named.join(F.broadcast(hot), interval, "left")
    others = marked.where("kept is null").drop("kept").join(firsts.where(~is_hot).drop("n"), interval)
    same = F.col("doc").eqNullSafe(F.col("kept.doc")) & (F.col("ver") == F.col("kept.ver"))
    copies = marked.where("kept is not null").unionByName(others)
    later = copies.where(~same | (F.col("seq") >= F.col("kept.seq") + F.col("m")))
    deleted = later.select(*key, F.explode(F.sequence("first", "last")).alias("line"))
    return deleted.groupBy(*key).agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, later copies of repeated line runs deleted from ``text``.

    Adds ``n_lines`` (of the input, blank ones included) and ``n_deleted``; these and, where
    present, ``n_chars`` are set anew. The order of documents is that of the id, then of a hash
    of the text; a null id comes first. Null texts stay null, with 0 lines. A text without a run
    of ``min_words`` words, an empty one too, is never changed. Blank lines after a deleted
    line go with it. The same row (id and text) twice is one document: both copies are
    changed alike. Other columns pass through; an empty table gives an empty result.
    """
    deleted = repeated_lines(docs, id_col, min_words)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    marks = deleted.select(F.col("doc").alias("_doc"), F.col("ver").alias("_ver"), F.col("lines").alias("_lines"))
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_ver"))
    # The texts go to Python only where lines are deleted.
    joined = docs.select(*columns).join(marks, same, "left").drop("_doc", "_ver")
    hit = F.col("_lines").isNotNull()

    parts = F.split("text", "\n")
    flags = F.transform(parts, lambda line, i: F.when(F.array_contains(F.col("_lines"), i), F.lit(None)).otherwise(line))
    cleaned = F.when(hit, F.array_join(flags, "\n")).otherwise(F.col("text"))
    result = joined.withColumns(
        {
            "n_lines": F.coalesce(F.size(F.when(F.col("text").isNotNull(), parts)), F.lit(0)).cast("long"),
            "n_deleted": F.when(hit, F.size("_lines")).otherwise(0).cast("long"),
            "text": cleaned,
        }
    )
    if "n_chars" in columns:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*columns, "n_lines", "n_deleted")
