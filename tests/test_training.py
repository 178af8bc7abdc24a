import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from ebbtide.operators.models import default_models, feature_importance, prediction_preview
from ebbtide.operators.roc import roc_auc
from ebbtide.operators.split import hash_split, split_frames
from ebbtide.plans.subscribers import FEATURE_COLUMNS, KEY
from ebbtide.plans.training import compare_models
from fixtures import subscribers

MODELS = ["Logistic Regression", "Decision Tree", "Random Forest"]


@pytest.fixture(scope="module")
def parts(spark):
    return split_frames(hash_split(subscribers(spark), KEY))


@pytest.fixture(scope="module")
def comparison(parts):
    with compare_models(*parts, FEATURE_COLUMNS) as run:
        yield run


def test_metrics_rows(comparison, parts):
    rows = comparison.metrics().collect()
    assert [row.model for row in rows] == MODELS
    tested = parts[1].count()
    for row in rows:
        assert row.tn + row.fp + row.fn + row.tp == tested
        assert 0.7 < row.roc_auc <= 1.0
        assert row.balanced_accuracy > 0.55


def test_scores_are_probabilities_in_line_with_predictions(comparison):
    scored = comparison.scored
    assert scored.columns == [KEY, "y", "ordinal", "model", "prediction", "score"]
    assert scored.where(~F.col("score").between(0, 1)).count() == 0
    assert scored.where((F.col("score") != 0.5) & ((F.col("score") > 0.5) != (F.col("prediction") == 1))).count() == 0


def test_every_test_row_is_scored_by_every_model(comparison, parts):
    per_model = comparison.scored.groupBy("model").agg(F.countDistinct(KEY).alias("keys"), F.count("*").alias("rows"))
    tested = parts[1].count()
    assert {(row.keys, row.rows) for row in per_model.collect()} == {(tested, tested)}


def test_importances(comparison):
    rows = comparison.importances("Random Forest").collect()
    assert len(rows) == 49
    assert sum(row.importance for row in rows) == pytest.approx(1.0)
    assert [row.importance for row in rows] == sorted((row.importance for row in rows), reverse=True)
    assert sorted(row.idx for row in rows) == list(range(49))
    with pytest.raises(ValueError):
        feature_importance(comparison.models["Random Forest"], comparison.names.where("idx < 35"))


def test_estimators_keep_their_parameters():
    lr, tree, forest = default_models("y").values()
    assert (lr.getMaxIter(), lr.getRegParam()) == (100, 0.0)
    assert (tree.getSeed(), tree.getMaxDepth()) == (42, 5)
    assert (forest.getSeed(), forest.getNumTrees(), forest.getMaxDepth()) == (42, 20, 5)


def test_a_model_without_probabilities_scores_by_its_prediction(parts):
    columns = FEATURE_COLUMNS
    svc = {"SVC": LinearSVC(featuresCol="features", labelCol=columns.label, maxIter=5)}
    with compare_models(*parts, columns, svc) as run:
        assert {row.score for row in run.scored.select("score").distinct().collect()} <= {0.0, 1.0}
        row = run.metrics().first()
        assert row.roc_auc == pytest.approx(row.balanced_accuracy)


def test_missing_feature_columns_are_skipped(parts):
    train, test = (part.drop("TechSupport", "tenure") for part in parts)
    with compare_models(train, test, FEATURE_COLUMNS, {"tree": default_models("Churn")["Decision Tree"]}) as run:
        assert run.names.count() == 49 - 3 - 1
        assert run.metrics().count() == 1


def test_nothing_stays_cached(spark, parts):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with compare_models(*parts, FEATURE_COLUMNS, {"tree": default_models("Churn")["Decision Tree"]}) as run:
        run.metrics()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_preview_of_predictions(comparison, parts):
    shown = prediction_preview(comparison.scored, MODELS, KEY, [KEY, "absent", "y", "prediction"]).collect()
    first = [row[KEY] for row in parts[1].orderBy(KEY).limit(5).collect()]
    assert [(row.model, row[KEY]) for row in shown] == [(model, key) for model in MODELS for key in first]


def test_areas_do_not_depend_on_the_layout(comparison):
    moved = comparison.scored.repartition(5)
    areas = [{row.model: row.roc_auc for row in roc_auc(df, "y", "score", ["model"], buckets=n).collect()}
             for df, n in ((comparison.scored, 3), (moved, 17))]
    assert areas[0] == areas[1]


def test_preview_reads_the_rows_once_and_limits_before_the_shuffle(spark, plan_text):
    rows = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderstatus").alias("model"), "o_orderkey", F.col("o_totalprice").alias("score")
    )
    text = plan_text(prediction_preview(rows, ["F", "O"], "o_orderkey", ["o_orderkey", "score"]))
    assert text.count("Location: InMemoryFileIndex") == 1 and "WindowGroupLimit" in text


def test_equal_keys_are_previewed_in_the_order_of_what_is_shown(spark):
    rows = spark.createDataFrame([("m", 1, v) for v in (5, 3, 9, 1)], "model string, k int, v int").repartition(3)
    assert [row.v for row in prediction_preview(rows, ["m"], "k", ["k", "v"], rows=3).collect()] == [1, 3, 5]
