"""The most frequent terms of a corpus whose distinct terms have no bound.

Counting every distinct term would shuffle a long tail of terms that occur once. Instead each task keeps a summary of
at most ``capacity`` counters (Misra and Gries 1982, in its mergeable form): when there are more, the largest count
outside is taken off all, and those that fall to nothing go. What was taken off bounds how much any count is too low.
Summaries add up by term, and so do their errors. A second pass then counts only the terms that can be among the
kept ones, exactly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodloom.session import materialize

# Code in tasks travels with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 200_000
GROWTH = 8


def _added(table: pa.Table) -> pa.Table:
    sums = table.group_by("term").aggregate([("cf", "sum"), ("df", "sum")])
    return pa.table({"term": sums["term"], "cf": sums["cf_sum"], "df": sums["df_sum"]})


def _trimmed(table: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """At most ``capacity`` terms, and what was taken off their counts."""
    if table.num_rows <= capacity:
        return table, 0
    counts = table["cf"].to_numpy()
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts - off
    kept = left > 0
    table = table.set_column(1, "cf", pa.array(left)).filter(pa.array(kept))
    return table, off


def summarize(terms: DataFrame, capacity: int) -> DataFrame:
    """(term, cf, df) from ``term_counts``, arrays of (term, tf): lower bounds of how often and in how many rows.

    At most ``capacity`` rows come from each task. The row with a null term holds the error that adds up to: no cf is
    more than its ``cf`` too low, and no df. Its ``df`` is the number of rows read.
    """
    empty = pa.schema([("term", pa.string()), ("cf", pa.int64()), ("df", pa.int64())]).empty_table()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, n_waiting, error, n_rows = empty, [], 0, 0, 0

        def merged() -> tuple[pa.Table, int]:
            return _trimmed(_added(pa.concat_tables([total, *waiting])), capacity)

        for batch in batches:
            n_rows += batch.num_rows
            term, tf = batch.column(0).flatten().flatten()
            own = pa.table({"term": term.cast(pa.string()), "cf": tf.cast(pa.int64()), "df": np.ones(len(tf), np.int64)})
            waiting.append(own.filter(own["term"].is_valid()))
            n_waiting += len(tf)
            if n_waiting > capacity:
                total, off = merged()
                waiting, n_waiting, error = [], 0, error + off
        total, off = merged()
        about = pa.table({"term": pa.array([None], pa.string()), "cf": [error + off], "df": [n_rows]})
        yield from pa.concat_tables([total, about]).to_batches()

    return terms.select("term_counts").mapInArrow(work, "term string, cf bigint, df bigint")


@dataclass(frozen=True)
class TermTotals:
    """(term, df, cf), exact, of all terms that can be kept, and the number of rows of the corpus."""

    counts: DataFrame
    n_docs: int
    error: int  # of the summary that ruled the others out; 0 if it had room for all


def term_totals(
    terms: DataFrame, keep: int, min_df: int, max_df: float, capacity: int = CAPACITY
) -> TermTotals:
    """Exact counts of every term that can be among the ``keep`` most frequent ones within the df bounds.

    Summaries grow until their error is below the least count that a kept term can have, so the result does
    not depend on ``capacity``; it holds every kept term and may hold more.
    """
    while True:
        partial = summarize(terms, capacity).groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
        summary = materialize(partial, "summary")
        about = summary.where("term is null").first()
        error, n_docs = (about["cf"], about["df"]) if about else (0, 0)
        found = summary.where("term is not null")
        if error == 0:
            return TermTotals(found, n_docs, 0)
        # Terms that keep their place whatever the error is: the last of them bounds the others from below.
        certain = found.where((F.col("df") >= min_df) & (F.col("df") + error <= max_df * n_docs))
        last = certain.orderBy(F.desc("cf")).limit(keep).agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("cf")).first()
        least = last["cf"] if last["n"] == keep else min_df
        if error < least:
            break
        capacity *= GROWTH
    possible = materialize(found.where(F.col("cf") + error >= least).select("term"), "possible")
    exact = (
        terms.select(F.inline_outer("term_counts"))
        .join(possible, "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))
    )
    return TermTotals(exact, n_docs, error)
