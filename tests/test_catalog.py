"""Registered queries against their SQL twins on the smallest tables."""

import functools

import pytest

import __spark_entry__ as entry
from check import compare, connect
from moodloom.plans import catalog, oracles

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    # The squared hinge has no solver in SQL; test_newton and test_models compare it with solvers of another kind.
    assert set(catalog.QUERIES) - set(oracles.oracle_sql()) == {"train_svc", "model_metrics"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def one_model():
    """The queries that only apply a model share one."""
    saved = functools.cache(catalog._saved_model)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "_saved_model", saved)
        yield


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    df = catalog.QUERIES[name](spark, SF)
    assert compare(df, tables, oracles.oracle_sql()[name]).startswith("ok")


def test_reports_shuffle_the_posts_once(spark):
    def exchanges(key):
        plan = catalog.daily_sentiment(spark, SF)._jdf.queryExecution().executedPlan().toString()
        return plan.count(f"Exchange hashpartitioning({key}#")

    assert (exchanges("tweet_id"), exchanges("id")) == (1, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # A lexicon joined by shuffle scatters the words: one more exchange, of short rows.
        assert (exchanges("tweet_id"), exchanges("id")) == (1, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
