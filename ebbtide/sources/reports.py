"""The JSON report document: metrics per model and named importances."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_FIELDS = T.StructType(
    [
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("tn", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("fn", T.LongType()),
        T.StructField("tp", T.LongType()),
        T.StructField("roc_auc", T.DoubleType()),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("results", T.MapType(T.StringType(), RESULT_FIELDS)),
        T.StructField("rf_importance", T.ArrayType(T.DoubleType())),
        T.StructField("rf_feature_names", T.ArrayType(T.StringType())),
    ]
)


def build_report(metrics: DataFrame, importances: DataFrame | None = None) -> DataFrame:
    """One-row document from metrics rows and importance rows.

    Both inputs hold one row per model or per feature slot, never per customer,
    so the lists collected here stay small. ``auc`` is the balanced accuracy of
    the hard predictions, as the document defines it; ``roc_auc``, the area of
    the score, is null where the metrics or an older document lack it.
    """
    if "roc_auc" not in metrics.columns:
        metrics = metrics.withColumn("roc_auc", F.lit(None).cast("double"))
    fields = [F.col("balanced_accuracy" if name == "auc" else name).alias(name) for name in RESULT_FIELDS.names]
    entry = F.struct("ordinal", "model", F.struct(*fields).alias("fields"))
    document = metrics.agg(F.array_sort(F.collect_list(entry)).alias("entries")).select(
        F.map_from_entries(
            F.transform("entries", lambda e: F.struct(e["model"], e["fields"].cast(RESULT_FIELDS)))
        ).alias("results")
    )
    if importances is None:
        return document.select(
            "results",
            F.lit(None).cast(T.ArrayType(T.DoubleType())).alias("rf_importance"),
            F.array().cast(T.ArrayType(T.StringType())).alias("rf_feature_names"),
        )
    slots = importances.agg(F.array_sort(F.collect_list(F.struct("idx", "feature", "importance"))).alias("slots"))
    # Both sides are one row by construction: an aggregate without keys.
    packed = slots.select(F.struct(F.col("slots.importance").alias("i"), F.col("slots.feature").alias("f")))
    return document.withColumn("packed", packed.scalar()).select(
        "results", F.col("packed.i").alias("rf_importance"), F.col("packed.f").alias("rf_feature_names")
    )


def write_report(report: DataFrame, path: str) -> None:
    """Overwrite ``path`` with the one-row document as UTF-8 JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a report, pretty-printed or on one line; absent results become an empty map."""
    try:
        document = spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no report at {path}: run the training plan first") from error
    empty = F.create_map().cast(T.MapType(T.StringType(), RESULT_FIELDS))
    return document.withColumn("results", F.coalesce("results", empty))


def report_metrics(report: DataFrame) -> DataFrame:
    """Metrics rows of a report, in the order in which the document lists the models."""
    listed = report.select(F.posexplode(F.map_entries("results")).alias("ordinal", "entry"))
    names = [
        F.col(f"entry.value.{name}").alias("balanced_accuracy" if name == "auc" else name)
        for name in RESULT_FIELDS.names
    ]
    return listed.select("ordinal", F.col("entry.key").alias("model"), *names)


def report_importances(report: DataFrame) -> DataFrame:
    """Rows (idx, feature, importance); fails if names and values do not pair up."""
    values, names = F.col("rf_importance"), F.col("rf_feature_names")
    mismatch = F.raise_error(
        F.format_string("%d importances but %d feature names", F.size(values), F.size(names))
    ).cast("array<struct<feature:string,importance:double>>")
    pairs = F.when(F.size(values) == F.size(names), F.arrays_zip(names.alias("feature"), values.alias("importance")))
    listed = report.where(values.isNotNull()).select(F.posexplode(pairs.otherwise(mismatch)).alias("idx", "slot"))
    return listed.select("idx", "slot.feature", "slot.importance")
