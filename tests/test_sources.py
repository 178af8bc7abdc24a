import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from ebbtide.operators.clean import drop_nulls
from ebbtide.sources import (
    SUBSCRIBER_SCHEMA,
    build_report,
    collect_small,
    read_report,
    read_table,
    report_importances,
    report_metrics,
    rescued_cells,
    small_table,
    write_csv,
    write_report,
)
from fixtures import subscribers


def test_csv_round_trip(spark, tmp_path):
    df = subscribers(spark, 200)
    write_csv(df, str(tmp_path / "t"))
    back = read_table(spark, str(tmp_path / "t"))
    assert back.schema == SUBSCRIBER_SCHEMA
    assert back.exceptAll(df).count() == 0 and back.count() == 200
    inferred = read_table(spark, str(tmp_path / "t"), infer=True)
    assert dict(inferred.dtypes) == dict(df.dtypes)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Churn,extra,CustomerID,tenure\n1,7,CUST1,12\n0,8,CUST2,3\n")
    df = read_table(spark, str(path))
    assert df.dtypes == [("Churn", "int"), ("extra", "string"), ("CustomerID", "string"), ("tenure", "int")]
    assert [tuple(row) for row in df.collect()] == [(1, "7", "CUST1", 12), (0, "8", "CUST2", 3)]


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CustomerID,tenure\nCUST1,12\n")
    (tmp_path / "b.csv").write_text("tenure,CustomerID\n12,CUST1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path), fmt="csv").collect()


def test_empty_nan_and_na_cells(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("CustomerID,MonthlyCharges,Contract\nA,1.5,x\nB,,x\nC,NaN,x\nD,2.5,NA\nE,3.5,\n")
    df = read_table(spark, str(path))
    assert [row.CustomerID for row in drop_nulls(df).collect()] == ["A", "D"]


def test_parquet_and_unknown_formats(spark, tmp_path):
    assert read_table(spark, "/root/testdata/sf0.001/orders.parquet").count() > 0
    subscribers(spark, 5).write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p"), fmt="parquet").count() == 5
    with pytest.raises(ValueError, match="unsupported"):
        read_table(spark, "x", fmt="orc")


def test_small_results_only(spark):
    assert len(collect_small(spark.range(10), 10)) == 10
    with pytest.raises(ValueError, match="more than 9"):
        collect_small(spark.range(10), 9)
    assert small_table(spark.range(3)).schema == spark.range(3).schema


METRICS = (
    "ordinal int, model string, tn long, fp long, fn long, tp long, accuracy double, precision double, "
    "recall double, balanced_accuracy double, f1 double"
)
ROWS = [(1, "B", 1, 2, 3, 4, 0.5, 0.6, 0.7, 0.8, 0.9), (0, "Ä", 5, 6, 7, 8, 0.1, 0.2, 0.3, None, 0.4)]


def test_report_round_trip(spark, tmp_path):
    metrics = spark.createDataFrame(ROWS, METRICS)
    slots = [(1, "b=x", 0.75), (0, "a", 0.25)]
    importances = spark.createDataFrame(slots, "idx int, feature string, importance double")
    path = str(tmp_path / "report")
    write_report(build_report(metrics, importances), path)
    write_report(build_report(metrics, importances), path)  # overwrites

    parts = list((tmp_path / "report").glob("*.json"))
    assert len(parts) == 1
    document = json.loads(parts[0].read_text("utf-8"))
    assert list(document) == ["results", "rf_importance", "rf_feature_names"]
    assert list(document["results"]) == ["Ä", "B"]
    assert document["results"]["B"] == {
        "accuracy": 0.5, "f1": 0.9, "precision": 0.6, "recall": 0.7, "auc": 0.8, "tn": 1, "fp": 2, "fn": 3, "tp": 4,
    }
    assert document["rf_importance"] == [0.25, 0.75] and document["rf_feature_names"] == ["a", "b=x"]

    report = read_report(spark, path)
    assert report_metrics(report).select(metrics.columns).exceptAll(metrics).count() == 0
    assert [tuple(row) for row in report_importances(report).collect()] == [(0, "a", 0.25), (1, "b=x", 0.75)]


def test_pretty_printed_report_and_missing_parts(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"rf_importance": [0.5, 0.5], "rf_feature_names": ["a"]}, indent=2))
    report = read_report(spark, str(path))
    assert report.first().results == {} and report_metrics(report).count() == 0
    with pytest.raises(PySparkException, match="2 importances but 1 feature names"):
        report_importances(report).collect()
    path.write_text(json.dumps({"results": {}}, indent=2))
    assert report_importances(read_report(spark, str(path))).count() == 0


def test_report_without_importances(spark):
    row = build_report(spark.createDataFrame(ROWS, METRICS)).first()
    assert list(row.results) == ["Ä", "B"] and row.rf_importance is None and row.rf_feature_names == []


def test_missing_report(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run the training plan first"):
        read_report(spark, str(tmp_path / "none"))


def test_rescued_cells_name_file_line_and_text(spark, tmp_path):
    """Two files of several blocks; every number of the second column that ends in 7 is spoilt."""
    folder = tmp_path / "in"
    folder.mkdir()
    want = set()
    for name in ("a.csv", "b.csv"):
        lines = ["k,v,t"]
        for i in range(3_000):
            bad = i % 10 == 7 and name == "a.csv" or i == 2_999
            lines.append(f"{i},{'x' * (i % 5) + 'bad' if bad else i},text")
            if bad:
                want.add((name, len(lines), "v", "x" * (i % 5) + "bad"))
        (folder / name).write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "4000")
        found = rescued_cells(spark, str(folder), schema)
        got = {(row.file.rsplit("/", 1)[-1], row.line, row.column, row.raw) for row in found.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == want
    text = T.StructType([T.StructField("t", T.StringType())])
    assert rescued_cells(spark, str(folder), text).collect() == []
