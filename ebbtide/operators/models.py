"""Classifiers on encoded features: fit, score in one pass, importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import binary_value, positive_probability
from ebbtide.operators.clean import existing_columns
from ebbtide.operators.features import FEATURES
from ebbtide.operators.forests import model_nodes, node_importances
from ebbtide.sources import staged

OUTPUT_PARAMS = ("predictionCol", "probabilityCol", "rawPredictionCol")


def default_models(label: str, seed: int = 42) -> dict[str, Estimator]:
    """The three classifiers compared, in run order, with default parameters."""
    shared = {"featuresCol": FEATURES, "labelCol": label}
    return {
        "Logistic Regression": LogisticRegression(**shared),
        "Decision Tree": DecisionTreeClassifier(**shared, seed=seed),
        "Random Forest": RandomForestClassifier(**shared, seed=seed),
    }


def fit_models(train: DataFrame, estimators: Mapping[str, Estimator]) -> dict[str, Model]:
    """Fit every estimator on the same encoded rows.

    Output columns get the model's ordinal as a suffix, so that all fitted
    models can score one frame side by side.
    """
    fitted = {}
    for ordinal, (name, estimator) in enumerate(estimators.items()):
        renamed = {
            estimator.getParam(param): f"{param}_{ordinal}" for param in OUTPUT_PARAMS if estimator.hasParam(param)
        }
        fitted[name] = estimator.fit(train, renamed)
    return fitted


def score_models(encoded: DataFrame, models: Mapping[str, Model], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Tagged predictions (ordinal, model, y, prediction, score) of all models from one scan.

    Each model adds its columns to the same row and the row is unpivoted at the
    end: the test rows are read and encoded once, not once per model.
    """
    wide = encoded
    for model in models.values():
        wide = model.transform(wide)
    outcomes = [
        F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(name).alias("model"),
            F.col(f"predictionCol_{ordinal}").alias("prediction"),
            positive_probability(wide.columns, f"probabilityCol_{ordinal}", f"predictionCol_{ordinal}").alias("score"),
        )
        for ordinal, name in enumerate(models)
    ]
    return wide.select(*keep, binary_value(label).alias("y"), F.inline(F.array(*outcomes)))


def prediction_preview(
    scored: DataFrame, models: Sequence[str], key: str, columns: Sequence[str], rows: int = 5
) -> DataFrame:
    """The first predictions of each model in key order, equal keys in the order of the shown columns.

    One scan: the rank limit is applied in every task before the shuffle, so few rows per model move.
    """
    shown = existing_columns(scored, columns)
    order = list(dict.fromkeys([key, *shown]))
    place = F.row_number().over(Window.partitionBy("model").orderBy(*order))
    run_order = F.array_position(F.array(*map(F.lit, models)), F.col("model"))
    ranked = scored.where(F.col("model").isin(list(models))).select("model", *order, place.alias("place"))
    first = ranked.where(F.col("place") <= rows).orderBy(run_order, "place")
    return first.select("model", *shown)


def feature_importance(model: Model, names: DataFrame) -> DataFrame:
    """Rows (idx, feature, importance) of a tree model, most important first; ``names`` has (idx, feature).

    Taken from the model's node table, so no list of slots passes through the driver. Fails if there are not as many
    names as vector slots.
    """
    if (named := names.count()) != model.numFeatures:
        raise ValueError(f"{named} feature names for {model.numFeatures} vector slots")
    return node_importances(staged(model_nodes(names.sparkSession, model)), names)
