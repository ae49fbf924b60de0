"""Quality of predictions, from one grouped count per (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodloom.schemas import SENTIMENTS


def accuracy(df: DataFrame, label_col: str = "sentiment", pred_col: str = "prediction") -> DataFrame:
    right = (F.col(label_col) == F.col(pred_col)).cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n"), (F.sum(right) / F.count(F.lit(1))).alias("accuracy")
    )


def confusion_matrix(
    df: DataFrame,
    classes: Sequence[str] = SENTIMENTS,
    label_col: str = "sentiment",
    pred_col: str = "prediction",
) -> DataFrame:
    """One row per actual class in the given order, one count column per predicted class."""
    counts = df.groupBy(F.col(label_col).alias("actual")).agg(
        *[F.count(F.when(F.col(pred_col) == c, 1)).alias(c) for c in classes]
    )
    order = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(classes)], "position int, actual string"
    )
    return order.join(counts, "actual", "left").fillna(0, list(classes)).select(
        "position", "actual", *classes
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def classification_report(
    df: DataFrame,
    classes: Sequence[str] = SENTIMENTS,
    label_col: str = "sentiment",
    pred_col: str = "prediction",
) -> DataFrame:
    """``(class, precision, recall, f1, support)`` per class, then accuracy, macro and weighted means."""
    y, p = F.col(label_col), F.col(pred_col)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(y == p, 1)).alias("right"),
        *[F.count(F.when((y == c) & (p == c), 1)).alias(f"hit_{c}") for c in classes],
        *[F.count(F.when(y == c, 1)).alias(f"actual_{c}") for c in classes],
        *[F.count(F.when(p == c, 1)).alias(f"chosen_{c}") for c in classes],
    )
    rows = []
    for c in classes:
        hit, actual, chosen = (F.col(f"{k}_{c}") for k in ("hit", "actual", "chosen"))
        rows.append(
            F.struct(
                F.lit(c).alias("class"),
                _ratio(hit, chosen).alias("precision"),
                _ratio(hit, actual).alias("recall"),
                _ratio(2 * hit, actual + chosen).alias("f1"),
                actual.alias("support"),
            )
        )
    per_class = counts.withColumn("rows", F.array(*rows))
    measures = ("precision", "recall", "f1")

    def mean(name: str, weighted: bool) -> Column:
        total = sum(
            (F.col("rows")[i][name] * (F.col("rows")[i]["support"] if weighted else 1)
             for i in range(len(classes))),
            F.lit(0.0),
        )
        return _ratio(total, F.col("n")) if weighted else total / len(classes)

    share = _ratio(F.col("right"), F.col("n"))
    n = F.col("n")
    summary = [
        F.struct(F.lit("accuracy").alias("class"), *[share.alias(m) for m in measures], n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"),
                 *[mean(m, False).alias(m) for m in measures], n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[mean(m, True).alias(m) for m in measures], n.alias("support")),
    ]
    return per_class.select(F.inline(F.concat("rows", F.array(*summary))))


def model_row(
    df: DataFrame, model: str, primary: bool = False, label_col: str = "sentiment", pred_col: str = "prediction"
) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 of one model, in percent with one decimal."""
    report = classification_report(df, label_col=label_col, pred_col=pred_col)

    def pick(row: str, measure: str) -> Column:
        return F.bround(F.max(F.when(F.col("class") == row, F.col(measure))) * 100, 1).alias(measure)

    return report.agg(
        F.lit(model).alias("model"),
        pick("accuracy", "precision").alias("accuracy"),
        *[pick("weighted avg", m) for m in ("precision", "recall", "f1")],
        F.lit(primary).alias("is_primary"),
    )
