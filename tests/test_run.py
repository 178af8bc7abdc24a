import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.plans.attrition_run import run_attrition
from ebbtide.sources import (
    Publication,
    published,
    read_report,
    read_table,
    report_importances,
    report_metrics,
    staged,
    write_csv,
)
from fixtures import subscribers

TABLES = {
    "class_distribution", "segments", "rule_checks", "domain_checks", "roc_curve", "model_table", "confusion_matrix",
    "importances", "predictions_preview", "report", "skipped_checks", "row_counts", "cleaned", "class_shares",
    "check_evidence", "rescued_cells",
}


def run_folder(spark, target):
    """The folder of the last complete run."""
    return Path(published(spark, str(target)).removeprefix("file:"))


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "subscribers")
    write_csv(subscribers(spark, 1500), path)
    return path


def csv(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).csv(str(path)).collect()


def test_whole_run(spark, source, tmp_path):
    metrics = run_attrition(spark, source, str(tmp_path)).collect()
    tmp_path = run_folder(spark, tmp_path)
    assert {path.name for path in tmp_path.iterdir()} == TABLES
    report = read_report(spark, str(tmp_path / "report"))
    again = report_metrics(report).collect()
    assert [(row.model, row.tn, row.tp, row.accuracy) for row in again] == [
        (row.model, row.tn, row.tp, row.accuracy) for row in metrics
    ]
    assert [row.roc_auc for row in again] == [row.roc_auc for row in metrics] and all(row.roc_auc for row in metrics)
    shown_areas = {row.model: row.roc_auc for row in csv(spark, tmp_path / "model_table")}
    assert shown_areas == {row.model: round(row.roc_auc, 4) for row in metrics}
    counts = {(row.item, row.column): row.rows for row in csv(spark, tmp_path / "row_counts")}
    assert counts["read", None] == counts["kept", None] == 1500 == counts["train", None] + counts["test", None]
    importances = report_importances(report).collect()
    assert len(importances) == 49 and sum(row.importance for row in importances) == pytest.approx(1.0)
    assert sum(row.rows for row in csv(spark, tmp_path / "class_distribution")) == 1500
    assert len(csv(spark, tmp_path / "segments")) == 5 + 5 + 3 + 5 + 4
    shares = csv(spark, tmp_path / "class_shares")
    assert sum(row.share_pct for row in shares if row.segment == "all") == pytest.approx(100)
    assert {row.check: row.violations for row in csv(spark, tmp_path / "check_evidence")} == {
        **{row.rule: row.violations for row in csv(spark, tmp_path / "rule_checks")},
        **{row.check: row.violations for row in csv(spark, tmp_path / "domain_checks")},
    }
    assert csv(spark, tmp_path / "rescued_cells") == []
    assert all(row.violations == 0 for row in csv(spark, tmp_path / "domain_checks"))
    assert len(csv(spark, tmp_path / "confusion_matrix")) == 6
    shown = csv(spark, tmp_path / "predictions_preview")
    assert len(shown) == 15 and all(row.Contract for row in shown)
    curve = csv(spark, tmp_path / "roc_curve")
    for model in {row.model for row in curve}:
        points = sorted((row.fpr, row.tpr) for row in curve if row.model == model)
        assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
        assert [y for _, y in points] == sorted(y for _, y in points)


def test_run_with_random_split_and_missing_columns(spark, source, tmp_path):
    table = read_table(spark, source).drop("TechSupport", "Unresolved_Complaints")
    write_csv(table, str(tmp_path / "in"))
    metrics = run_attrition(spark, str(tmp_path / "in"), str(tmp_path / "out"), split="random")
    assert metrics.count() == 3
    out = run_folder(spark, tmp_path / "out")
    assert {path.name for path in out.iterdir()} == TABLES
    skipped = {row.check for row in csv(spark, out / "skipped_checks")}
    assert {"TechSupport follows InternetService", "TechSupport in domain"} < skipped and len(skipped) == 4
    assert len(csv(spark, out / "rule_checks")) == 7 - 1
    with pytest.raises(ValueError, match="unknown split"):
        run_attrition(spark, source, str(tmp_path / "out"), split="other")


def test_staging_writes_into_the_sessions_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.glob("ebbtide-*"))
    table = staged(spark.range(10))
    assert len(set(folder.glob("ebbtide-*")) - before) == 1
    assert table.count() == 10


def test_bad_cells_are_counted_and_whole_numbers_may_have_a_point(spark, source, tmp_path):
    table = spark.read.option("header", True).csv(source).limit(400).withColumn("row", F.monotonically_increasing_id())
    cells = {0: "oops", 1: "", 2: "7.5"}
    tenure = F.col("tenure")
    for row, text in cells.items():
        tenure = F.when(F.col("row") == row, F.lit(text) if text else F.lit(None)).otherwise(tenure)
    changed = table.withColumn("tenure", F.when(F.col("row") > 2, F.concat(tenure, F.lit(".0"))).otherwise(tenure))
    write_csv(changed.drop("row").coalesce(1), str(tmp_path / "in"))
    run_attrition(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    out = run_folder(spark, tmp_path / "out")
    counts = {(row.item, row.column): row.rows for row in csv(spark, out / "row_counts")}
    rescued = csv(spark, out / "rescued_cells")
    assert {(row.line, row.column, str(row.raw)) for row in rescued} == {(2, "tenure", "oops"), (4, "tenure", "7.5")}
    assert counts["read", None] == 400 and counts["kept", None] == 397
    assert counts["unparsable", "tenure"] == 2 and counts["null", "tenure"] == 1 and counts["null", "Churn"] == 0
    assert spark.read.parquet(str(out / "cleaned")).count() == 397


def test_a_run_that_dies_leaves_the_last_complete_one(spark, source, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        published(spark, str(tmp_path))
    run_attrition(spark, source, str(tmp_path))
    first = run_folder(spark, tmp_path)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("ebbtide.plans.attrition_run.write_report", fail)
    with pytest.raises(RuntimeError, match="lost"):
        run_attrition(spark, source, str(tmp_path))
    assert len(list((tmp_path / "runs").iterdir())) == 2 and run_folder(spark, tmp_path) == first
    assert report_metrics(read_report(spark, str(first / "report"))).count() == 3
    publication = Publication(spark, str(tmp_path))
    publication.publish()
    assert published(spark, str(tmp_path)) == publication.folder


def test_command_line(spark, source, tmp_path):
    run = subprocess.run(
        [sys.executable, "-m", "ebbtide", source, str(tmp_path / "out"), "--split", "hash"],
        cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=600,
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[4] --conf spark.ui.enabled=false pyspark-shell"},
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert "Random Forest" in run.stdout
    document = json.loads(next((run_folder(spark, tmp_path / "out") / "report").glob("*.json")).read_text("utf-8"))
    assert set(document["results"]) == {"Logistic Regression", "Decision Tree", "Random Forest"}
