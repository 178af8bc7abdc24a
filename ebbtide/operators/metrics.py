"""Confusion counts and the metrics that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import binary_value, safe_ratio

CONFUSION_CELLS = ("tn", "fp", "fn", "tp")
MODEL_KEYS = ("ordinal", "model")


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """TN, FP, FN, TP as one row (per group of ``by``); absent cells are 0.

    Values other than 0 and 1, nulls included, fail the query.
    """
    actual, predicted = binary_value(label), binary_value(prediction)
    paired = df.select(*by, actual.alias("_actual"), predicted.alias("_predicted"))
    cells = [
        F.count_if((F.col("_actual") == a) & (F.col("_predicted") == p)).alias(cell)
        for cell, (a, p) in zip(CONFUSION_CELLS, ((0, 0), (0, 1), (1, 0), (1, 1)))
    ]
    return (paired.groupBy(*by) if by else paired).agg(*cells)


def binary_metrics(counts: DataFrame) -> DataFrame:
    """Add accuracy, positive-class precision, recall and F1, and balanced accuracy.

    Ratios over nothing are 0.0. ``balanced_accuracy`` is the area under the
    ROC curve of the hard predictions; it is null if only one class occurs.
    """
    tn, fp, fn, tp = map(F.col, CONFUSION_CELLS)
    precision, recall = F.col("precision"), F.col("recall")
    both_classes = (tp + fn > 0) & (tn + fp > 0)
    return (
        counts.withColumns(
            {
                "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
                "precision": safe_ratio(tp, tp + fp),
                "recall": safe_ratio(tp, tp + fn),
                "balanced_accuracy": F.when(both_classes, (tp / (tp + fn) + tn / (tn + fp)) / F.lit(2.0)),
            }
        )
        .withColumn("f1", safe_ratio(F.lit(2.0) * precision * recall, precision + recall))
    )


def metrics_by_model(scored: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    """Counts and metrics of several models from tagged predictions, in one aggregation.

    ``scored`` has a row per model and example with ``ordinal`` (run order) and ``model``.
    """
    return binary_metrics(confusion_counts(scored, label, prediction, by=MODEL_KEYS))


def confusion_matrix(counts: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """2x2 layout of confusion counts: a row per true class, a column per predicted class."""
    rows = F.array(
        F.struct(F.lit(0).alias("label"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit(1).alias("label"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")),
    )
    return counts.select(*by, F.inline(rows))


def best_model(metrics: DataFrame, measure: str = "balanced_accuracy") -> DataFrame:
    """The row with the highest measure; the earlier model on a tie."""
    return metrics.orderBy(F.desc_nulls_last(measure), "ordinal").limit(1)


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Comparison table in run order: metrics rounded to 4 places, counts, card texts, and the best model's mark.

    ``roc_auc`` is there if the metrics have it. The mark comes from a window over the rows, which are one per model.
    """
    best_first = Window.orderBy(F.desc_nulls_last("balanced_accuracy"), "ordinal")
    rounded = {
        "accuracy": "accuracy",
        "f1_score": "f1",
        "precision": "precision",
        "recall": "recall",
        "auc": "balanced_accuracy",
        **({"roc_auc": "roc_auc"} if "roc_auc" in metrics.columns else {}),
    }
    placed = metrics.withColumn("best", F.row_number().over(best_first) == 1)
    return placed.orderBy("ordinal").select(
        "model",
        *[F.round(source, 4).alias(name) for name, source in rounded.items()],
        "tp",
        "tn",
        "fp",
        "fn",
        F.format_string("AUC %.3f", "balanced_accuracy").alias("auc_text"),
        F.format_string("Acc %.3f", "accuracy").alias("accuracy_text"),
        "best",
    )
