"""The vocabulary of a corpus with a long tail, by summaries and by counting everything."""

import random
from collections import Counter

import pytest

from moodloom.operators import features, frequent


def corpus(seed, rows=400):
    """Rows of (term, tf): common terms, and a tail of terms that occur once."""
    rng = random.Random(seed)
    common = [f"w{i:02d}" for i in range(60)]
    made = []
    for r in range(rows):
        own = Counter(common[min(59, int(rng.expovariate(0.08)))] for _ in range(rng.randint(0, 12)))
        own["every"] = 1 + r % 2
        own.update({f"tail{r}-{i}": 1 for i in range(rng.randint(0, 15))})
        made.append(own)
    return made


def as_table(spark, rows, parts=3):
    data = [([(t, n) for t, n in r.items()],) for r in rows] + [([],), (None,)]
    return spark.createDataFrame(data, "term_counts array<struct<term:string,tf:int>>").repartition(parts).persist()


def counted(rows):
    cf, df = Counter(), Counter()
    for r in rows:
        cf.update(r)
        df.update(r.keys())
    return cf, df


def kept(rows, n_docs, params):
    cf, df = counted(rows)
    able = [t for t in cf if params.min_df <= df[t] <= params.max_df * n_docs]
    top = sorted(able, key=lambda t: (-cf[t], t))[: params.max_features]
    return {(t, df[t], cf[t]) for t in top}


@pytest.mark.parametrize("capacity", [1, 5, 40, 100_000])
@pytest.mark.parametrize("max_features", [3, 25, 500])
def test_vocabulary_does_not_depend_on_the_summary(spark, capacity, max_features):
    rows = corpus(max_features)
    table = as_table(spark, rows)
    params = features.TfidfParams(max_features=max_features, min_df=3, max_df=0.9)
    got = features.vocabulary(table, params, capacity).collect()
    assert {(r.term, r.df, r.cf) for r in got} == kept(rows, len(rows) + 2, params)
    assert {r.n_docs for r in got} == {len(rows) + 2}


@pytest.mark.parametrize("capacity", [1, 2, 10, 70])
def test_summary_bounds(spark, capacity):
    rows = corpus(capacity)
    cf, df = counted(rows)
    table = as_table(spark, rows, 4)
    summary = frequent.summarize(table, capacity)
    # What is exchanged: a task's counters, and the row about its error.
    assert summary.count() <= 4 * (capacity + 1) < len(cf)
    low = {}
    for r in summary.collect():
        n, d = low.get(r.term, (0, 0))
        low[r.term] = n + r.cf, d + r.df
    error, n_rows = low.pop(None)
    assert n_rows == len(rows) + 2
    assert error <= 4 + sum(cf.values()) / (capacity + 1)
    for t in cf:
        n, d = low.get(t, (0, 0))
        assert n <= cf[t] <= n + error and d <= df[t] <= d + error


def test_the_tail_is_ruled_out(spark):
    rows = corpus(9)
    table = as_table(spark, rows)
    totals = frequent.term_totals(table, keep=10, min_df=3, max_df=0.9, capacity=60)
    assert totals.error > 0
    terms = {r.term for r in totals.counts.collect()}
    assert len(terms) < 100 and not any(t.startswith("tail") for t in terms)


def test_a_corpus_without_terms(spark):
    table = as_table(spark, [])
    assert features.vocabulary(table).collect() == []
    assert features.vocabulary(table.limit(0)).collect() == []
