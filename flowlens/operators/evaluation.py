"""Quality of predictions against labels, computed from stored predictions.

Each function aggregates to one row per (label, predicted label) first; that step alone reads
the predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.cleaning import evaluable
from flowlens.schema import BENIGN, MALICIOUS

ACTUAL, PREDICTED = "label", "predicted_label"


def confusion_counts(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    return (
        df.groupBy(actual, predicted)
        .agg(F.count("*").alias("count"))
        .orderBy(F.asc_nulls_first(actual), F.asc_nulls_first(predicted))
    )


def _hits(df: DataFrame, key: str, actual: str, predicted: str, total: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count_if(F.col(actual) == F.col(predicted)).alias("tp"), F.count("*").alias(total)
    )


def recall_by_label(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Share of each label's rows that were predicted as such."""
    # The names of the result's columns, here and below.
    hits = _hits(df, actual, actual, predicted, "support")
    return hits.withColumn("recall", F.col("tp") / F.col("support")).orderBy(
        F.asc_nulls_first(actual)
    )


def precision_by_prediction(
    df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    """Share of each prediction's rows that carry that label."""
    hits = _hits(df, predicted, actual, predicted, "predicted_total")
    return hits.withColumn("precision", F.col("tp") / F.col("predicted_total")).orderBy(
        F.asc_nulls_first(predicted)
    )


def confusion_matrix(
    df: DataFrame,
    classes: tuple[str, ...] = (BENIGN, MALICIOUS),
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
) -> DataFrame:
    """One row per class, one column per predicted class, in the given order.

    Rows with another value on either side drop out; a class without rows keeps its zeros.
    """
    cells = [
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{i}_{j}")
        for i, a in enumerate(classes)
        for j, p in enumerate(classes)
    ]
    rows = [
        F.struct(
            F.lit(a).alias(actual),
            *[F.col(f"c{i}_{j}").alias(f"Pred_{p}") for j, p in enumerate(classes)],
        )
        for i, a in enumerate(classes)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def classification_report(
    df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    """Precision, recall, F1 and support per class, and three summary rows.

    Classes are those seen on either side. A ratio with an empty denominator counts as 0. The
    summary rows are ``accuracy`` (same value in all three columns), ``macro avg`` and
    ``weighted avg``.
    """
    pairs = evaluable(df, actual, predicted).groupBy(actual, predicted).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0)
    nothing = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col(actual).alias("class"),
            F.col("n").alias("support"),
            nothing.alias("predicted"),
            hit.alias("tp"),
        ),
        F.struct(
            F.col(predicted).alias("class"),
            nothing.alias("support"),
            F.col("n").alias("predicted"),
            nothing.alias("tp"),
        ),
    )
    zero = F.lit(0.0)
    tp, support = F.col("tp"), F.col("support")
    precision, recall = F.col("precision"), F.col("recall")
    per_class = (
        pairs.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide(tp, F.col("predicted")), zero),
                "recall": F.coalesce(F.try_divide(tp, support), zero),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero),
        )
    )
    scores = ["precision", "recall", "f1"]
    # One grouping per class and one over all classes, in the same aggregate.
    totals = per_class.groupingSets([["class"], []], "class").agg(
        F.grouping_id().alias("level"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(s).alias(s) for s in scores],
        *[
            F.try_divide(F.sum(F.col(s) * support), F.sum("support")).alias(f"weighted_{s}")
            for s in scores
        ],
    )

    def line(name, columns):
        return F.struct(
            name.alias("class"),
            *[F.col(c).alias(s) for s, c in zip(scores, columns)],
            F.col("support"),
        )

    own = F.array(line(F.col("class"), scores))
    summary = F.array(
        line(F.lit("accuracy"), ["accuracy"] * 3),
        line(F.lit("macro avg"), scores),
        line(F.lit("weighted avg"), [f"weighted_{s}" for s in scores]),
    )
    return totals.select(F.inline(F.when(F.col("level") == 0, own).otherwise(summary)))


def accuracy_and_f1(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """Accuracy and weighted F1 as one row."""
    report = classification_report(df, actual, predicted)
    value = F.max(F.when(F.col("class") == "accuracy", F.col("f1")))
    weighted = F.max(F.when(F.col("class") == "weighted avg", F.col("f1")))
    return report.agg(value.alias("accuracy"), weighted.alias("f1"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight per label, inverse to its frequency; an even table gives 1 to each label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    even = counts.agg(F.try_divide(F.sum("n"), F.count("*"))).scalar()
    return counts.select(label, (even / F.col("n")).alias("weight"))
