import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ebbtide.functions import (
    bin_labels,
    percent,
    percent_text,
    required,
    right_closed_bin,
    safe_ratio,
    sigmoid,
    unit_hash,
    weight_of,
)

CHARGES, TENURE = (0, 40, 60, 80, 100), (0, 6, 12, 24, 48)


@pytest.mark.parametrize(
    ("edges", "value", "expected"),
    [
        (CHARGES, 0.0, None),
        (CHARGES, -3.0, None),
        (CHARGES, None, None),
        (CHARGES, math.nan, None),
        (CHARGES, 0.01, 0),
        (CHARGES, 40.0, 0),
        (CHARGES, 40.1, 1),
        (CHARGES, 100.0, 3),
        (CHARGES, 116.0, 4),
        (CHARGES, math.inf, 4),
        (TENURE, 0.0, None),
        (TENURE, 6.0, 0),
        (TENURE, 7.0, 1),
        (TENURE, 48.0, 3),
        (TENURE, 49.0, 4),
    ],
)
def test_right_closed_bin(spark, edges, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(right_closed_bin(F.col("x"), edges)).first()[0] == expected


def test_bins_of_integers_and_labels(spark):
    df = spark.createDataFrame([(0,), (6,), (7,), (None,)], "x int")
    assert [row[0] for row in df.select(right_closed_bin(F.col("x"), TENURE)).collect()] == [None, 0, 1, None]
    assert bin_labels(TENURE) == ["(0,6]", "(6,12]", "(12,24]", "(24,48]", ">48"]


@pytest.mark.parametrize("edges", [(), (0, 0), (5, 3)])
def test_bin_edges_must_increase(edges):
    with pytest.raises(ValueError):
        bin_labels(edges)


def test_ratios(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        safe_ratio(a, b).alias("r"), safe_ratio(a, b, None).alias("n"), percent(a, b).alias("p"),
        percent_text(percent(a, b)).alias("t"),
    ).collect()
    assert [tuple(row) for row in rows] == [(0.25, 0.25, 25.0, "25.0%"), (0.0, None, None, None)]


def test_required(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert df.where("a = 1").select(required(F.col("a"), "a")).first()[0] == 1
    with pytest.raises(PySparkException, match="null in required column a"):
        df.select(required(F.col("a"), "a")).collect()


def test_score_pieces(spark):
    df = spark.createDataFrame([("x", 0.0), ("y", -800.0), ("z", 3.0)], "c string, v double")
    rows = df.select(weight_of(F.col("c"), {"x": 1, "y": -0.5}).alias("w"), sigmoid(F.col("v")).alias("s")).collect()
    assert [row.w for row in rows] == [1.0, -0.5, None]
    assert rows[0].s == 0.5 and rows[1].s == 0.0 and rows[2].s == pytest.approx(1 / (1 + math.exp(-3)))


def test_unit_hash_is_uniform_and_salted(spark):
    df = spark.range(20_000).select(unit_hash(F.col("id")).alias("u"), unit_hash(F.col("id"), "s").alias("v"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.corr("u", "v")).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] < 1 and abs(row[2] - 0.5) < 0.01 and abs(row[3]) < 0.03
