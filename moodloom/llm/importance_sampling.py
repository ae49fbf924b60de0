"""Resampling of documents towards a target's distribution of n-grams (Xie et al. 2023).

N-grams fall into hashed buckets. How often a bucket occurs in the documents and in the target gives its gain,
a scaled and floored log ratio; a document's weight is the sum over its n-grams. Gumbel noise from a hash of its id
is added, and the highest scores are drawn: a sample without replacement, in proportion to the weights' exponentials,
that does not depend on how the rows are dealt.

Each batch interns its n-grams in an open-addressed NumPy table: XXH64 keys, linear probing, and a comparison of
the bytes, so that n-grams with equal keys stay apart. A slot holds the n-gram's bucket and count. Counting adds up the
slots; weighing gathers the gains by the occurrences' slot numbers.

Only the counts per bucket reach the driver, as many numbers as there are buckets. The ranks come from a distributed
sort: each range of scores numbers its own rows, and the sizes of the ranges before it are added.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.llm.spans import Buffer, same_bytes, xxhash64
from moodloom.session import materialize

BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SCALE = 1000
BYTES_AT_ONCE = 2 << 20
OCCURRENCES_AT_ONCE = 500_000
#: ASCII digits, letters and all bytes above ASCII.
_WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class Words:
    """Words of several texts: their bytes joined by one space, where each word lies, and the text it is from."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
        inside = _WORD_BYTES[raw]
        before = np.concatenate([[False], inside[:-1]])
        starts = np.flatnonzero(inside & ~before)
        size = np.flatnonzero(before & ~inside) - starts
        kept = np.where(inside, raw, np.uint8(0x20))[inside | before]
        self.buffer = Buffer(kept.tobytes())
        self.size = size
        self.start = np.cumsum(size + 1) - (size + 1)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        self.text = np.searchsorted(ends, starts, "right")
        self.n_texts = len(texts)

    def n_grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (start, size, text) of all runs of so many words within a text."""
        last = len(self.size) - order + 1
        for low in range(0, max(last, 0), OCCURRENCES_AT_ONCE):
            first = np.arange(low, min(low + OCCURRENCES_AT_ONCE, last))
            first = first[self.text[first] == self.text[first + order - 1]]
            end = self.start[first + order - 1] + self.size[first + order - 1]
            yield self.start[first], end - self.start[first], self.text[first]


class Table:
    """Open-addressed table of the distinct n-grams among many occurrences."""

    def __init__(self, buffer: Buffer, start: np.ndarray, size: np.ndarray, buckets: int):
        places = 1 << max(4, (2 * len(start)).bit_length())
        mask = places - 1
        keys = xxhash64(buffer, start, size)
        key = np.zeros(places, np.uint64)
        owner = np.full(places, -1, np.int64)  # the occurrence that took the slot
        #: The slot of each occurrence.
        self.slot = np.empty(len(start), np.int64)
        open_, at = np.arange(len(start)), (keys & np.uint64(mask)).astype(np.int64)
        while len(open_):
            free = owner[at] < 0
            owner[at[free]] = open_[free]  # of several, one stays
            key[at[free]] = keys[owner[at[free]]]
            holder = owner[at]
            same = (key[at] == keys[open_]) & (size[holder] == size[open_])
            other = np.flatnonzero(same & (holder != open_))
            same[other] = same_bytes(buffer, start[holder[other]], buffer, start[open_[other]], size[open_[other]])
            self.slot[open_[same]] = at[same]
            open_, at = open_[~same], (at[~same] + 1) & mask
        used = np.flatnonzero(owner >= 0)
        #: How often each slot's n-gram occurs, and its bucket.
        self.count = np.bincount(self.slot, minlength=places)
        self.bucket = np.zeros(places, np.int64)
        low = start[owner[used]]
        data = memoryview(buffer.bytes)
        spans = zip(low.tolist(), (low + size[owner[used]]).tolist())
        self.bucket[used] = [zlib.crc32(data[a:b]) % buckets for a, b in spans]
        self.used = used


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts with a bounded number of bytes, or a single one, and where they begin in the batch."""
    values = batch.column(column).cast(pa.large_string()).cast(pa.large_binary())
    own, total, low = [], 0, 0
    for i, value in enumerate(values):
        text = value.as_py() or b""
        if own and total + len(text) > BYTES_AT_ONCE:
            yield low, own
            own, total, low = [], 0, i
        own.append(text)
        total += len(text)
    if own:
        yield low, own


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How many n-grams of 1 to ``max_n`` words fall into each bucket, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, own in _texts(batch, 0):
                words = Words(own)
                for order in range(1, max_n + 1):
                    for start, size, _ in words.n_grams(order):
                        table = Table(words.buffer, start, size, buckets)
                        np.add.at(total, table.bucket[table.used], table.count[table.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    partial = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    result = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket at most
        result[row["bucket"]] = row["n"]
    return result


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets, in doubles."""
    n = len(source)
    all_s, all_t = float(source.sum() + n), float(target.sum() + n)
    ratios = [(t + 1.0) * all_s / ((s + 1.0) * all_t) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_n: int = 1, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) of each whole text; null texts have no words and the weight 0."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            for low, own in _texts(batch, 1):
                words = Words(own)
                n_features = np.zeros(len(own), np.int64)
                weight = np.zeros(len(own), np.int64)
                for order in range(1, max_n + 1):
                    for start, size, text in words.n_grams(order):
                        table = Table(words.buffer, start, size, len(gains))
                        gain = gains[table.bucket][table.slot]
                        n_features += np.bincount(text, minlength=len(own))
                        np.add.at(weight, text, gain)
                n_words = np.bincount(words.text, minlength=len(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(own)), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                    names=names,
                )

    names = [id_col, "n_words", "n_features", "weight"]
    schema = f"`{id_col}` {id_type}, n_words bigint, n_features bigint, weight bigint"
    return docs.select(F.col(id_col), F.col("text")).mapInArrow(work, schema)


def add_noise(weighed: DataFrame, seed: str, id_col: str = "doc_id") -> DataFrame:
    """With ``score``: the weight plus Gumbel noise from SHA-256 of seed and id; a null id counts as ''."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, id_col: str = "doc_id") -> DataFrame:
    """With ``rank`` 1, 2, 3... of the floor(percent N / 100) highest scores of the N rows with enough words.

    Ties go to the smaller id (null last), then the fewer features; equal rows take ranks in no fixed order. All
    rows are returned, the others with a null rank.
    """
    rows = materialize(scored.withColumn("row_no", F.monotonically_increasing_id()), "scored")
    # The row number lets a range end within rows that are equal in all else.
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("n_features"), F.asc("row_no")]
    ranged = rows.where(F.col("n_words") >= min_words).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number has the partition above 33 bits, and counts its rows from 0 below.
    ranged = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a partition
    before, total = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        before.append((row["part"], total))
        total += row["n"]
    offsets = scored.sparkSession.createDataFrame(before, "part bigint, before bigint")
    rank = F.col("before") + place + 1
    drawn = ranged.withColumn("part", part.cast("long")).join(F.broadcast(offsets), "part", "left")
    drawn = drawn.withColumn("rank", F.when(rank <= percent * total // 100, rank))
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [*scored.columns, "rank"]
    return drawn.select(*columns).unionByName(rest.select(*columns))


def resample(
    docs: DataFrame,
    target: DataFrame,
    max_n: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = "2024",
    id_col: str = "doc_id",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; see ``draw`` for ranks.

    Words are runs of ASCII digits, letters (A-Z lower-cased) and characters above ASCII, over whole texts of any
    length; null and empty texts have none, weight 0, and no rank while ``min_words`` is above 0. Repeated rows count,
    and are drawn, one by one; rows that repeat an id share its noise. Other columns are ignored, whatever their
    names. Without documents the result is empty; without a target all counts of it are 0.
    """
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    return draw(add_noise(weigh(docs, gains, max_n, id_col), seed, id_col), percent, min_words, id_col)


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns, for tables with one row for each id."""
    chosen = ranked.where("rank is not null").select(F.col(id_col).alias("_drawn"))
    return docs.join(chosen, F.col(id_col).eqNullSafe(F.col("_drawn")), "left_semi")
