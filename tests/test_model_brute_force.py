"""The classifiers against small hand-written versions on a small table."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier

from ebbtide.operators.features import FeatureColumns
from ebbtide.plans.training import compare_models
from fixtures import subscribers

COLUMNS = FeatureColumns(
    key="CustomerID", label="Churn", numeric=("tenure", "SatisfactionScore", "SupportCallsLast6Months"), categorical=()
)


@pytest.fixture(scope="module")
def table(spark):
    df = subscribers(spark, 800).select(COLUMNS.used).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def arrays(table):
    data = np.array([tuple(row)[1:] for row in table.orderBy("CustomerID").collect()], dtype=float)
    return data[:, 1:], data[:, 0]


def scored(table, estimator):
    with compare_models(table, table, COLUMNS, {"m": estimator}) as run:
        rows = run.scored.orderBy("CustomerID").collect()
    return np.array([row.score for row in rows]), np.array([row.prediction for row in rows])


def test_logistic_regression_finds_the_likelihood_maximum(table, arrays):
    x, y = arrays
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ weights))
        weights += np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]), design.T @ (y - p))
    scores, predictions = scored(table, LogisticRegression(featuresCol="features", labelCol="Churn"))
    expected = 1 / (1 + np.exp(-design @ weights))
    assert np.abs(scores - expected).max() < 1e-3
    assert (predictions == (expected > 0.5)).mean() > 0.995


def test_tree_takes_the_purest_cut(table, arrays):
    x, y = arrays

    def gini(part):
        return 2 * part.mean() * (1 - part.mean()) * len(part)

    cuts = [
        (gini(y[x[:, f] <= v]) + gini(y[x[:, f] > v]), f, v)
        for f in (1, 2)  # few enough values for every cut to be a candidate
        for v in np.unique(x[:, f])[:-1]
    ]
    _, feature, value = min(cuts)
    columns = FeatureColumns(label="Churn", key="CustomerID", numeric=COLUMNS.numeric[1:], categorical=())
    stump = DecisionTreeClassifier(featuresCol="features", labelCol="Churn", seed=42, maxDepth=1)
    with compare_models(table, table, columns, {"m": stump}) as run:
        rows = run.scored.orderBy("CustomerID").collect()
    below = x[:, feature] <= value
    expected = np.where(below, y[below].mean(), y[~below].mean())
    assert np.allclose([row.score for row in rows], expected)


def test_forest_repeats_with_its_seed(table):
    def forest():
        return RandomForestClassifier(featuresCol="features", labelCol="Churn", seed=42)

    first, second = scored(table, forest())[0], scored(table, forest())[0]
    assert np.array_equal(first, second)
