"""Groups of spelling variants: words within one edit of each other, led by their most frequent form.

Pairs of words within one edit are found without comparing all words. A letter is hashed to one of a few symbols,
so a word becomes a shorter-alphabet one, and an edit of the word is at most one edit of that. Each distinct
reduced word generates its one-edit neighbourhood; those of its neighbours that are in the reduced vocabulary
come out of a join, and the words behind both are compared as they are written. Being a neighbour works both ways, so each
pair of reduced words is generated from one side only: by a deletion from the longer, by a
replacement with a larger symbol from the other, or by nothing where the two are equal.

A reduced word travels as a 64-bit hash that is a polynomial of its symbols, so a neighbour's hash comes from those of a
head and a tail in constant time. Equal hashes of different words only cost a comparison: every pair is
verified on the words.

A word's form is its near word of largest count, if that is ``ratio`` times its own or more. Counts grow along forms by that
factor, so chains are short, and doubling the steps reaches their ends in a few joins.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from moodloom.session import materialize

NOISE = 199
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
SYMBOLS = 8
#: Letters of the words' alphabet: a-z in lower case, and U+00C0 to U+00FF as they are.
LETTERS = "".join(map(chr, [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
COUNTED = 300_000
CELLS = 1 << 21
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def noisy(run: bytes, h: int, noise: int) -> bytes:
    """The run without one of its code points, if the noise divides h."""
    if h % noise:
        return run
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def count_words(
    docs: DataFrame,
    noise: int = NOISE,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    id_col: str = "doc_id",
) -> DataFrame:
    """(word, n): words of enough code points and occurrences, over all whole texts.

    Tasks add up what they read in a table of bounded size, so a frequent word comes once from each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                runs = Counter(_RUN.findall((text.as_py() or "").encode().lower()))
                head = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for run, n in runs.items():
                    if len(run) >= min_chars:
                        h = zlib.crc32(run, head)
                        total[run if h % noise else noisy(run, h, noise)] += n
                if len(total) > COUNTED:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    partial = docs.select(ids, F.col("text")).mapInArrow(work, "word string, n bigint")
    enough = partial.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.sum("n").alias("n"))
    return enough.where(F.col("n") >= min_count)


def _finish(hashes: np.ndarray, length: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(length * 0x632BE59BD9B4E019 & (2**64 - 1))) * _MIX
    return (mixed ^ (mixed >> np.uint64(31))).astype(np.int64)


def _symbols(words: list[bytes]) -> np.ndarray:
    """Symbols (from 0) of reduced words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.int64) - ord("0")


def _powers(length: int) -> np.ndarray:
    """The base to the power of length - 1, ..., 1, 0."""
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(length - 1, 0), _BASE))])[:length][::-1]


def own_hashes(symbols: np.ndarray) -> np.ndarray:
    rows, length = symbols.shape
    terms = (symbols + 1).astype(np.uint64) * _powers(length)
    return _finish(terms.sum(axis=1, dtype=np.uint64), length)


def neighbour_hashes(symbols: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all words one deletion, or one replacement with a larger symbol, away."""
    rows, length = symbols.shape
    powers = _powers(length)
    terms = (symbols + 1).astype(np.uint64) * powers
    total = terms.sum(axis=1, dtype=np.uint64)
    made_row, made = [], []
    # Without place i: the head before it moves down by one power, the tail stays.
    head = np.zeros((rows, length), np.uint64)
    if length > 1:
        lower = (symbols[:, :-1] + 1).astype(np.uint64) * powers[1:]
        head[:, 1:] = np.cumsum(lower, axis=1, dtype=np.uint64)
    tail = total[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
    again = np.zeros((rows, length), bool)  # dropping either of two equal neighbours gives one word
    again[:, 1:] = symbols[:, 1:] == symbols[:, :-1]
    row, at = np.nonzero(~again)
    made_row.append(row)
    made.append(_finish((head + tail)[row, at], length - 1))
    for symbol in range(1, n_symbols):
        row, at = np.nonzero(symbols < symbol)
        step = (symbol - symbols[row, at]).astype(np.uint64) * powers[at]
        made_row.append(row)
        made.append(_finish(total[row] + step, length))
    return np.concatenate(made_row), np.concatenate(made)


def _by_length(words: list[bytes], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, symbols) of words of one length, at most about so many cells at once."""
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes).tolist():
        found = np.flatnonzero(sizes == length)
        step = max(1, cells // max(length, 1))
        for low in range(0, len(found), step):
            part = found[low : low + step]
            yield part, _symbols([words[i] for i in part.tolist()])


def reduce_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``words`` with ``reduced``, the word in symbols, and ``own``, the hash of that."""
    if not 2 <= symbols <= 10:
        raise ValueError("symbols are written as digits")
    digits = "".join(str(zlib.crc32(c.encode()) % symbols) for c in LETTERS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reduced = batch.column(2).cast(pa.binary()).to_pylist()
            own = np.zeros(len(reduced), np.int64)
            for part, rows in _by_length(reduced, CELLS):
                own[part] = own_hashes(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=["word", "n", "reduced", "own"])

    plain = words.select("word", "n", F.translate("word", LETTERS, digits).alias("reduced"))
    return plain.mapInArrow(work, "word string, n bigint, reduced string, own bigint")


def neighbourhoods(reduced: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(own, key): each reduced word's hash and those of its neighbours, itself included."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).cast(pa.binary()).to_pylist()
            for _, rows in _by_length(words, CELLS // (4 * symbols)):
                own = own_hashes(rows)
                row, key = neighbour_hashes(rows, symbols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([own, own[row]])), pa.array(np.concatenate([own, key]))],
                    names=["own", "key"],
                )

    return reduced.select("reduced").mapInArrow(work, "own bigint, key bigint")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, n_a, b, n_b): each pair of distinct words (word, n) that differ by one edit, once."""
    vocabulary = materialize(reduce_words(words, symbols), "reduced")
    known = vocabulary.select(F.col("own").alias("key")).distinct()
    near = neighbourhoods(vocabulary.select("reduced").distinct(), symbols).join(known, "key", "left_semi")
    classes = near.select(F.least("own", "key").alias("x"), F.greatest("own", "key").alias("y")).distinct()
    a = vocabulary.select(F.col("own").alias("x"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = vocabulary.select(F.col("own").alias("class_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.col("x") != F.col("y")) | (F.col("a") < F.col("b"))
    verified = (F.levenshtein("a", "b", 1) == 1) & once
    pairs = classes.join(a, "x").join(b, (F.col("y") == F.col("class_b")) & verified)
    return pairs.select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last word that forms lead to."""
    state, before = materialize(forms.select("word", F.col("form").alias("root")), "forms"), None
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        moved = state.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = moved.observe(seen, F.count_if("moved").alias("n"))
        state = materialize(moved.select("word", "root", "moved"), "roots").drop("moved")
        if not seen.get["n"]:
            return state


def group_variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of each row (word, n).

    ``form`` is the near word of largest n, the smallest in code-point order of equal ones, if its n is ``ratio``
    times the word's or more; otherwise it is null and the word is its own ``root``. Words must be distinct and of the
    letters in ``LETTERS``; a ratio above 1 keeps chains from closing.
    """
    if ratio <= 1:
        raise ValueError("forms must grow")
    words = materialize(words.select("word", "n"), "words")
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")),
    )
    near = near_pairs(words, symbols).select(F.explode(sides).alias("s")).select("s.*")
    # Strings compare by their UTF-8 bytes, which is the order of code points.
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near")))
    summary = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    rows = words.join(summary, "word", "left").select(
        "word",
        "n",
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
    rows = materialize(rows, "variants")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame,
    noise: int = NOISE,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    symbols: int = SYMBOLS,
    id_col: str = "doc_id",
) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of every word of the documents; see ``group_variants``.

    Null and empty texts have no words, a null id counts as '', repeated rows are counted one by one, and other columns
    are ignored, whatever their names. A run of letters of any length is one word. An empty table, or one
    without frequent words, gives an empty result.
    """
    return group_variants(count_words(docs, noise, min_chars, min_count, id_col), ratio, symbols)
