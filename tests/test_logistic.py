"""Newton's method against Spark's own fit, and where there is no maximum."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ebbtide.operators.logistic import INTERCEPT, fit_logistic, fitted_moments

NAMES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@pytest.fixture(scope="module")
def lines(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    noisy = F.col("l_extendedprice") * (1 - 2 * F.col("l_discount")) + F.pmod(F.hash("l_orderkey"), F.lit(40_000))
    return table.select(*NAMES, (noisy > 52_000).cast("int").alias("y")).cache()


@pytest.fixture(scope="module")
def features(spark):
    return {name: F.col(name) for name in NAMES}


def test_equals_a_tight_fit_of_the_library(lines, features):
    fit = fit_logistic(lines, features, "y")
    assembled = VectorAssembler(inputCols=list(NAMES), outputCol="x").transform(lines)
    model = LogisticRegression(featuresCol="x", labelCol="y", tol=1e-14, maxIter=500).fit(assembled)
    assert fit.converged and fit.steps < 15
    assert [fit.coefficients[name] for name in NAMES] == pytest.approx(model.coefficients.toArray().tolist(), rel=1e-4)
    assert fit.coefficients[INTERCEPT] == pytest.approx(model.intercept, rel=1e-4)
    for row in fitted_moments(lines, fit, features, "y").collect():
        assert row.fitted == pytest.approx(row.observed, rel=1e-8)
    assert [r.feature for r in fit.table(lines).orderBy("idx").collect()] == [INTERCEPT, *NAMES]


def test_layout_and_units_do_not_matter(lines, features):
    one = fit_logistic(lines.repartition(7), features, "y").coefficients
    scaled = {**features, "l_extendedprice": F.col("l_extendedprice") * 1e-6}
    other = fit_logistic(lines, scaled, "y").coefficients
    assert other["l_extendedprice"] == pytest.approx(1e6 * one["l_extendedprice"], rel=1e-6)
    assert other["l_tax"] == pytest.approx(one["l_tax"], rel=1e-5)


def test_constant_and_dependent_features(lines, features):
    more = {**features, "one": F.lit(1), "twice": 2 * F.col("l_quantity")}
    fit = fit_logistic(lines, more, "y")
    assert fit.converged and fit.coefficients["one"] == 0.0
    plain = fit_logistic(lines, features, "y")
    assert fit.log_likelihood == pytest.approx(plain.log_likelihood, rel=1e-9)
    together = fit.coefficients["l_quantity"] + 2 * fit.coefficients["twice"]
    assert together == pytest.approx(plain.coefficients["l_quantity"], rel=1e-5)


def test_parted_classes_have_no_maximum_unless_held_back(spark):
    rows = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 50).cast("int").alias("y"))
    fit = fit_logistic(rows, {"x": F.col("x")}, "y", max_steps=12)
    assert not fit.converged and fit.log_likelihood > -1
    held = fit_logistic(rows, {"x": F.col("x")}, "y", ridge=1.0)
    assert held.converged and 0 < held.coefficients["x"] < fit.coefficients["x"]


def test_refused_tables(spark, lines, features):
    with pytest.raises(ValueError, match="no rows"):
        fit_logistic(lines.where("false"), features, "y")
    with pytest.raises(Exception, match="must be 0 or 1"):
        fit_logistic(lines.withColumn("y", F.lit(2)), features, "y")
    with pytest.raises(Exception, match="null in required column l_tax"):
        fit_logistic(lines.withColumn("l_tax", F.lit(None).cast("double")), features, "y")
