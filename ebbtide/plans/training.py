"""Train several classifiers on one split and compare them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from ebbtide.operators.clean import existing_columns
from ebbtide.operators.features import (
    FEATURES,
    RAW_FEATURES,
    Encoding,
    FeatureColumns,
    feature_names,
    fit_encoding,
    vector_width,
)
from ebbtide.operators.metrics import MODEL_KEYS, metrics_by_model
from ebbtide.operators.models import default_models, feature_importance, fit_models, score_models
from ebbtide.operators.roc import roc_auc
from ebbtide.sources import staged


@dataclass(frozen=True)
class Comparison:
    """Fitted models, and their predictions on the test rows (cached until ``release``)."""

    columns: FeatureColumns
    features: Encoding
    names: DataFrame
    models: dict[str, Model]
    scored: DataFrame

    def metrics(self) -> DataFrame:
        """One row per model in run order: counts, metrics, and ROC area of the score."""
        areas = roc_auc(self.scored, "y", "score", by=MODEL_KEYS).select("ordinal", "roc_auc")
        return staged(metrics_by_model(self.scored).join(areas, "ordinal")).orderBy("ordinal")

    def importances(self, model: str) -> DataFrame:
        return feature_importance(self.models[model], self.names)

    def release(self) -> None:
        self.scored.unpersist()

    def __enter__(self) -> Comparison:
        return self

    def __exit__(self, *_exc) -> None:
        self.release()


def compare_models(
    train: DataFrame,
    test: DataFrame,
    columns: FeatureColumns,
    estimators: Mapping[str, Estimator] | None = None,
    keep: Sequence[str] = (),
) -> Comparison:
    """Fit the encoding once and every model on the same cached rows; score the test rows in one pass.

    The training table is read three times: to count the categories, to find the
    widths of their vectors, and to encode and cache the rows that the scaler and
    all models are fitted on. Forests follow the partitions of the source. The scored
    rows carry the key and those columns of ``keep`` that the test table has.
    """
    columns = columns.present_in(train)
    estimators = default_models(columns.label) if estimators is None else estimators
    source = train.select(columns.inputs)
    encoding = fit_encoding(source, columns)
    encoded = encoding.transform(source).select(columns.label, RAW_FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        names = staged(feature_names(train.sparkSession, encoding))
        width, named = vector_width(encoded, RAW_FEATURES), names.count()
        if named != width:
            raise ValueError(f"{named} feature names for {width} vector slots")
        features = encoding.with_scaler(encoded)
        scaled = features.stages.stages[-1].transform(encoded).select(columns.label, FEATURES)
        models = fit_models(scaled, estimators)
    finally:
        encoded.unpersist()

    shown = [columns.key] if columns.key else []
    shown += [name for name in existing_columns(test, keep) if name not in shown]
    tested = features.transform(test.select(list(dict.fromkeys([*columns.used, *shown]))))
    scored = score_models(tested, models, columns.label, shown).persist(StorageLevel.MEMORY_AND_DISK)
    return Comparison(columns, features, names, models, scored)
