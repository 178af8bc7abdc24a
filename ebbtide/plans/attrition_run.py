"""The whole analysis of a subscriber table: clean, check, segment, train, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.checks import check_report, domain_violations, rule_violations
from ebbtide.operators.clean import drop_nulls
from ebbtide.operators.metrics import MODEL_KEYS, confusion_matrix, metrics_report
from ebbtide.operators.models import prediction_preview
from ebbtide.operators.roc import roc_curve
from ebbtide.operators.segments import class_distribution
from ebbtide.operators.split import TEST, TRAIN, hash_split, random_split, split_frames
from ebbtide.plans import subscribers
from ebbtide.plans.segment_report import class_report, segment_report
from ebbtide.plans.training import compare_models
from ebbtide.sources import (
    SUBSCRIBER_SCHEMA,
    Publication,
    build_report,
    input_counts,
    read_cells,
    rescued_cells,
    staged,
    table_format,
    typed,
    write_csv,
    write_report,
)

IMPORTANCE_MODEL = "Random Forest"


def split_table(df: DataFrame, split: str) -> tuple[DataFrame, DataFrame]:
    if split == "hash":
        return split_frames(hash_split(df, subscribers.KEY))
    if split == "random":
        return tuple(random_split(df))
    raise ValueError(f"unknown split {split!r}: use 'hash' or 'random'")


def run_attrition(
    spark: SparkSession, source: str, target: str, fmt: str | None = None, infer: bool = False, split: str = "hash"
) -> DataFrame:
    """Analyse the table at ``source`` and write all results to a folder of this run below ``target``.

    The run is published when everything is written: until then, and if it fails, ``published(spark, target)`` gives
    the folder of the last complete run. Returns the metrics rows. Written: ``report`` (JSON document), and as CSV
    ``model_table``, ``confusion_matrix``, ``roc_curve``, ``importances``,
    ``predictions_preview``, ``class_distribution``, ``segments``,
    ``rule_checks``, ``domain_checks``, ``skipped_checks`` (checks whose columns
    the table lacks), ``row_counts`` (rows read, kept, for training and test;
    null and unparsable cells per column), ``rescued_cells`` (file, line and
    text of every unparsable cell), ``class_shares`` (classes of the table and of
    every segment), ``check_evidence`` (all checks with keys that violate them),
    and as parquet ``cleaned``, the rows that all later steps read.
    """
    publication = Publication(spark, target)
    target = publication.folder
    cells = read_cells(spark, source, fmt=fmt, infer=infer)
    schema = None if infer else SUBSCRIBER_SCHEMA
    table = staged(drop_nulls(cells if infer else typed(cells, SUBSCRIBER_SCHEMA)), f"{target}/cleaned")

    def save(df: DataFrame, name: str) -> None:
        write_csv(df, f"{target}/{name}")

    have = set(table.columns)
    segments = [segment for segment in subscribers.SEGMENTS if segment.column in have]
    save(class_distribution(table, subscribers.LABEL), "class_distribution")
    save(segment_report(table, subscribers.LABEL, segments), "segments")
    rules = [rule for rule in subscribers.dependency_rules() if have >= rule.columns]
    domains = [rule for rule in subscribers.domain_rules() if have >= rule.columns]
    skipped = [rule.name for rule in subscribers.dependency_rules() if not have >= rule.columns]
    skipped += [rule.name for rule in subscribers.domain_rules() if not have >= rule.columns]
    save(class_report(table, subscribers.LABEL, segments), "class_shares")
    if subscribers.KEY in have:
        save(check_report(table, [*rules, *domains], F.col(subscribers.KEY)), "check_evidence")
    if not infer and table_format(source, fmt) == "csv":
        save(rescued_cells(spark, source), "rescued_cells")
    save(rule_violations(table, rules), "rule_checks")
    save(domain_violations(table, domains), "domain_checks")
    save(spark.createDataFrame([(name,) for name in skipped], "check string"), "skipped_checks")

    train, test = split_table(table, split)
    sizes = train.select(F.lit(TRAIN).alias("item")).unionByName(test.select(F.lit(TEST).alias("item")))
    parts = sizes.groupBy("item").agg(F.count("*").alias("rows"))
    counts = input_counts(cells, schema).unionByName(parts, allowMissingColumns=True)
    save(counts.coalesce(1), "row_counts")
    with compare_models(train, test, subscribers.FEATURE_COLUMNS, keep=subscribers.PREVIEW_COLUMNS) as comparison:
        metrics = comparison.metrics()
        importances = comparison.importances(IMPORTANCE_MODEL)
        first_predictions = prediction_preview(
            comparison.scored,
            list(comparison.models),
            subscribers.KEY,
            [*subscribers.PREVIEW_COLUMNS, "y", "prediction", "score"],
        )
        save(first_predictions, "predictions_preview")
        curves = roc_curve(comparison.scored, "y", "score", by=MODEL_KEYS, drop_intermediate=True)
        save(curves.orderBy("ordinal", "fpr", "tpr"), "roc_curve")
    save(metrics_report(metrics), "model_table")
    save(confusion_matrix(metrics), "confusion_matrix")
    save(importances, "importances")
    write_report(build_report(metrics, importances), f"{target}/report")
    publication.publish()
    return metrics
