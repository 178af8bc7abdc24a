"""Rules for the library source: no row data on the driver, no Python row functions, no cross joins."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.clean import drop_nulls
from ebbtide.operators.scorecard import risk_scorecard
from ebbtide.operators.split import hash_split
from ebbtide.plans import catalog, catalog_sql
from ebbtide.plans.subscribers import KEY, RISK_SCORECARD
from fixtures import subscribers

ROOT = Path(__file__).resolve().parents[1]
SOURCES = sorted(path for path in (ROOT / "ebbtide").rglob("*.py") if "llm" not in path.parts)
SF_DIR = "/root/testdata/sf0.001"


def uses(pattern):
    return {path.name for path in SOURCES if re.search(pattern, path.read_text("utf-8"))}


def test_rows_reach_the_driver_only_through_the_small_result_helper():
    assert uses(r"\.collect\(\)|\.toPandas\(|\.toLocalIterator\(|\.take\(|\.first\(\)") == {"tables.py"}


def test_no_row_functions_cross_joins_or_local_checkpoints():
    assert uses(r"\budf\(|pandas_udf|mapInPandas|applyInPandas|crossJoin|localCheckpoint|\.foreach\(") == set()


def test_sessions_are_opened_by_the_command_line_only():
    assert uses(r"getOrCreate") == {"__main__.py"}


@pytest.mark.parametrize("name", sorted(catalog_sql.oracle_sql()))
def test_no_plan_pairs_rows_or_runs_python(spark, plan_text, name):
    text = plan_text(catalog.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_row_level_operators_take_streams(spark, tmp_path):
    """They hold no state, so the same code scores a stream."""
    subscribers(spark, 50).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))

    def steps(df):
        return risk_scorecard(hash_split(drop_nulls(df), KEY), RISK_SCORECARD).select(KEY, "part", F.round("risk", 9))

    query = (
        steps(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = steps(spark.read.parquet(str(tmp_path / "in")))
    assert streamed.count() == 50 and streamed.exceptAll(batch).count() == 0
