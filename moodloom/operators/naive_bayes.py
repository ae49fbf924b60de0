"""Multinomial naive Bayes as joins and sums over the weight relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodloom.schemas import SENTIMENTS

ALPHA = 0.1


def fit(
    weighted: DataFrame,
    labels: DataFrame,
    vocab: DataFrame,
    classes: Sequence[str] = SENTIMENTS,
    alpha: float = ALPHA,
    id_col: str = "tweet_id",
    label_col: str = "sentiment",
) -> tuple[DataFrame, DataFrame]:
    """``theta (term, idx, <class>...)`` and ``prior (<class>...)``, logs of probabilities.

    ``weighted`` has the training rows only, ``labels`` their ids and labels; weights that
    carry the label are not joined with it. Both
    results are bounded: one row per vocabulary term, and one row.
    """
    known = weighted if label_col in weighted.columns else weighted.join(labels.select(id_col, label_col), id_col)
    sums = (
        known.groupBy("idx")
        .agg(*[F.sum(F.when(F.col(label_col) == c, F.col("weight"))).alias(c) for c in classes])
    )
    per_term = vocab.select("term", "idx").join(sums, "idx", "left").fillna(0.0, list(classes))
    every = Window.partitionBy()
    n_terms = F.count(F.lit(1)).over(every)
    theta = per_term.select(
        "term",
        "idx",
        *[
            F.log((F.col(c) + alpha) / (F.sum(c).over(every) + alpha * n_terms)).alias(c)
            for c in classes
        ],
    )
    prior = labels.agg(
        *[
            F.log(F.count(F.when(F.col(label_col) == c, 1)) / F.count(label_col)).alias(f"prior_{c}")
            for c in classes
        ]
    )
    return theta, prior


def predict(
    ids: DataFrame,
    weighted: DataFrame,
    theta: DataFrame,
    prior: DataFrame,
    classes: Sequence[str] = SENTIMENTS,
    id_col: str = "tweet_id",
) -> DataFrame:
    """Rows of ``ids`` with ``prediction``, the class of the highest score (ties by label).

    ``weighted`` holds one document's terms in one place, so the sums shuffle one
    row per document. A document without known terms is scored by the prior alone.
    """
    sums = (
        weighted.join(theta.drop("term"), "idx")
        .groupBy(id_col)
        .agg(*[F.sum(F.col("weight") * F.col(c)).alias(f"sum_{c}") for c in classes])
    )
    ordered = sorted(classes)
    priors = prior.select(F.struct("*")).scalar()
    scored = ids.join(sums, id_col, "left").withColumn("_prior", priors)
    scores = [
        F.coalesce(F.col(f"sum_{c}"), F.lit(0.0)) + F.col("_prior")[f"prior_{c}"] for c in ordered
    ]
    best = F.greatest(*scores)
    choice = F.coalesce(*[F.when(s == best, c) for s, c in zip(scores, ordered)])
    return scored.select(*ids.columns, choice.alias("prediction"))
