import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ebbtide.operators.metrics import (
    best_model,
    binary_metrics,
    confusion_counts,
    confusion_matrix,
    metrics_by_model,
    metrics_report,
)
from ebbtide.operators.models import score_models
from ebbtide.operators.roc import roc_auc
from ebbtide.operators.segments import rate_by_category

# Published counts and metrics of three models.
GOLDENS = [
    ("Logistic Regression", 219, 17, 32, 90,
     0.8631284916201117, 0.7860262008733624, 0.8411214953271028, 0.7377049180327869, 0.8328355098638511),
    ("Decision Tree", 203, 33, 47, 75,
     0.776536312849162, 0.6521739130434782, 0.6944444444444444, 0.6147540983606558, 0.7374617949430397),
    ("Random Forest", 211, 25, 40, 82,
     0.8184357541899442, 0.7161572052401747, 0.7663551401869159, 0.6721311475409836, 0.7830994720755766),
]


def golden_counts(spark):
    rows = [(i, *golden[:5]) for i, golden in enumerate(GOLDENS)]
    return spark.createDataFrame(rows, "ordinal int, model string, tn long, fp long, fn long, tp long")


def test_published_metrics(spark):
    rows = binary_metrics(golden_counts(spark)).orderBy("ordinal").collect()
    for row, golden in zip(rows, GOLDENS, strict=True):
        got = (row.accuracy, row.f1, row.precision, row.recall, row.balanced_accuracy)
        assert got == pytest.approx(golden[5:], abs=1e-12)


def test_best_model_and_report(spark):
    metrics = binary_metrics(golden_counts(spark))
    assert best_model(metrics).first().model == "Logistic Regression"
    report = metrics_report(metrics).collect()
    assert [row.model for row in report] == [golden[0] for golden in GOLDENS]
    assert [row.best for row in report] == [True, False, False]
    assert report[0].f1_score == 0.786 and report[0].auc == 0.8328
    assert report[0].auc_text == "AUC 0.833" and report[0].accuracy_text == "Acc 0.863"


def test_first_of_equal_models_is_best(spark):
    rows = [(0, "b", 5, 5, 5, 5), (1, "a", 5, 5, 5, 5), (2, "c", 0, 0, 5, 5)]
    counts = spark.createDataFrame(rows, "ordinal int, model string, tn long, fp long, fn long, tp long")
    assert best_model(binary_metrics(counts)).first().model == "b"


def test_counts_and_evaluators_agree(spark):
    df = spark.range(500).select(
        (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 5 < 2).cast("double").alias("p")
    )
    row = binary_metrics(confusion_counts(df, "y", "p")).first()
    accuracy = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName="accuracy")
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p", metricName="areaUnderROC")
    f1 = MulticlassClassificationEvaluator(
        labelCol="y", predictionCol="p", metricName="fMeasureByLabel", metricLabel=1.0
    )
    assert row.tn + row.fp + row.fn + row.tp == 500
    assert row.accuracy == pytest.approx(accuracy.evaluate(df), abs=1e-12)
    assert row.balanced_accuracy == pytest.approx(area.evaluate(df), abs=1e-12)
    assert row.f1 == pytest.approx(f1.evaluate(df), abs=1e-12)


def test_nothing_predicted_positive(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0)], "y int, p double")
    row = binary_metrics(confusion_counts(df, "y", "p")).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 0, 1, 0)
    assert (row.precision, row.recall, row.f1, row.accuracy, row.balanced_accuracy) == (0.0, 0.0, 0.0, 0.5, 0.5)


def test_single_class_and_empty(spark):
    one = spark.createDataFrame([(0, 0.0)], "y int, p double")
    assert binary_metrics(confusion_counts(one, "y", "p")).first().balanced_accuracy is None
    none = binary_metrics(confusion_counts(one.where("y = 5"), "y", "p")).first()
    assert (none.tn, none.accuracy, none.f1) == (0, 0.0, 0.0)


@pytest.mark.parametrize("row", [(None, 0.0), (0, None), (2, 0.0)])
def test_values_other_than_0_and_1_fail(spark, row):
    df = spark.createDataFrame([(0, 0.0), row], "y int, p double")
    with pytest.raises(PySparkException, match="must be 0 or 1"):
        confusion_counts(df, "y", "p").collect()


def test_all_models_in_one_aggregation(spark, plan_text):
    scored = spark.range(60).select(
        (F.col("id") % 2).cast("int").alias("ordinal"), F.concat(F.lit("m"), F.col("id") % 2).alias("model"),
        (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 4 == 0).cast("double").alias("prediction"),
    )
    metrics = metrics_by_model(scored)
    assert {row.model: row.tn + row.fp + row.fn + row.tp for row in metrics.collect()} == {"m0": 30, "m1": 30}
    assert plan_text(metrics).count("Exchange (") == 2  # once in the tree, once in the details
    matrix = confusion_matrix(metrics).collect()
    assert [(row.model, row.label) for row in sorted(matrix)] == [("m0", 0), ("m0", 1), ("m1", 0), ("m1", 1)]


@pytest.mark.parametrize("value", [2.0, -1.0, 0.7, float("nan"), None])
@pytest.mark.parametrize("operator", ["confusion", "prediction", "roc", "rate", "scored"])
def test_only_0_and_1_are_labels(spark, operator, value):
    """Compared before they are cast, in every operator that reads a label or a prediction."""
    df = spark.createDataFrame([(0.0, 0.0, 0.5, "k"), (value, 1.0, 0.6, "k")], "y double, p double, s double, k string")
    frames = {
        "confusion": lambda: confusion_counts(df, "y", "p"),
        "prediction": lambda: confusion_counts(df, "p", "y"),
        "roc": lambda: roc_auc(df, "y", "s", buckets=1),
        "rate": lambda: rate_by_category(df, "k", "y"),
        "scored": lambda: score_models(df.withColumn("predictionCol_0", F.lit(1.0)), {"m": SQLTransformer(statement="SELECT * FROM __THIS__")}, "y"),
    }
    with pytest.raises((PySparkException, Py4JJavaError), match="y must be 0 or 1"):
        frames[operator]().collect()


def test_report_scans_its_rows_once(spark, plan_text, tmp_path):
    golden_counts(spark).write.parquet(str(tmp_path / "c"))
    text = plan_text(metrics_report(binary_metrics(spark.read.parquet(str(tmp_path / "c")))))
    assert text.count("Location: InMemoryFileIndex") == 1
