import math
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ebbtide.operators.roc import ranked_scores, roc_auc, roc_curve, score_bounds


def brute_force(pairs):
    """Points (threshold, fpr, tpr) from the highest score down, and the area by pair counting."""
    positives = sum(y for y, _ in pairs)
    negatives = len(pairs) - positives
    points = [(None, 0.0, 0.0)]
    for threshold in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(1 for y, s in pairs if y == 1 and s >= threshold)
        fp = sum(1 for y, s in pairs if y == 0 and s >= threshold)
        points.append((threshold, fp / negatives, tp / positives))
    wins = sum(
        2 * (s > t) + (s == t) for y, s in pairs if y == 1 for z, t in pairs if z == 0
    )
    return points, wins / (2 * positives * negatives)


def corners(points):
    """Points that are not on a straight run, by second differences."""
    kept = [points[0]]
    curve = points[1:]
    for i, point in enumerate(curve):
        inner = 0 < i < len(curve) - 1
        if inner:
            before = [point[k] - curve[i - 1][k] for k in (1, 2)]
            after = [curve[i + 1][k] - point[k] for k in (1, 2)]
            if all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(before, after)):
                continue
        kept.append(point)
    return kept


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double").repartition(3)


def sample(kind, seed=7):
    rng = random.Random(seed)
    if kind == "ties":
        return [(rng.randint(0, 1), float(rng.randint(0, 9))) for _ in range(300)]
    if kind == "distinct":
        return [(int(rng.random() < s), s) for s in (rng.random() for _ in range(300))]
    if kind == "hot":
        return [(rng.randint(0, 1), 0.5) for _ in range(150)] + [(rng.randint(0, 1), rng.random()) for _ in range(150)]
    return [(rng.randint(0, 1), rng.choice([-math.inf, -1.5, 0.0, 2.0, math.inf])) for _ in range(100)]


@pytest.mark.parametrize("kind", ["ties", "distinct", "hot", "infinite"])
@pytest.mark.parametrize("buckets", [1, 2, 40])
def test_curve_and_area_by_brute_force(spark, kind, buckets):
    pairs = sample(kind)
    df = frame(spark, pairs)
    points, area = brute_force(pairs)

    def curve(**options):
        rows = roc_curve(df, "y", "s", buckets=buckets, **options).collect()
        return sorted(((r.threshold, r.fpr, r.tpr) for r in rows), key=lambda p: (p[1], p[2], p[0] is not None))

    assert curve() == points
    assert roc_auc(df, "y", "s", buckets=buckets).first().roc_auc == pytest.approx(area, abs=1e-15)
    # A corner is decided on exact counts, so compare on count steps, not on rounded rates.
    assert curve(drop_intermediate=True) == corners(points)


def test_area_equals_the_evaluator_and_mirrors(spark):
    pairs = sample("distinct", seed=3)
    df = frame(spark, pairs)
    area = roc_auc(df, "y", "s").first().roc_auc
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s")
    assert area == pytest.approx(evaluator.evaluate(df), abs=1e-12)
    mirrored = roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first().roc_auc
    assert area + mirrored == pytest.approx(1.0, abs=1e-12)


def test_curves_of_several_models_at_once(spark):
    parts = {"a": sample("ties", 1), "b": sample("distinct", 2)}
    rows = [(model, y, s) for model, pairs in parts.items() for y, s in pairs]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    areas = {row.model: row.roc_auc for row in roc_auc(df, "y", "s", by=["model"], buckets=5).collect()}
    curve = roc_curve(df, "y", "s", by=["model"], buckets=5).collect()
    for model, pairs in parts.items():
        points, area = brute_force(pairs)
        assert areas[model] == pytest.approx(area, abs=1e-15)
        assert sum(row.model == model for row in curve) == len(points)


def test_equal_scores(spark):
    df = frame(spark, [(1, 0.3), (0, 0.3), (0, 0.3)])
    assert sorted((row.fpr, row.tpr) for row in roc_curve(df, "y", "s").collect()) == [(0.0, 0.0), (1.0, 1.0)]
    assert roc_auc(df, "y", "s").first().roc_auc == 0.5


def test_single_class_has_no_area(spark):
    row = roc_auc(frame(spark, [(0, 0.1), (0, 0.9)]), "y", "s").first()
    assert (row.positives, row.negatives, row.roc_auc) == (0, 2, None)
    points = roc_curve(frame(spark, [(0, 0.1), (0, 0.9)]), "y", "s").collect()
    assert all(row.tpr is None for row in points) and {row.fpr for row in points} == {0.0, 0.5, 1.0}


def test_empty_input(spark):
    df = frame(spark, [(0, 0.1)]).where("y = 9")
    assert roc_curve(df, "y", "s").collect() == []
    assert roc_auc(df, "y", "s").first().roc_auc is None


@pytest.mark.parametrize(
    ("bad", "message"),
    [((None, 0.5), "y must be 0 or 1, found null"), ((1, None), "null in required column s"), ((1, math.nan), "NaN in s")],
)
def test_incomplete_rows_fail(spark, bad, message):
    with pytest.raises((PySparkException, Py4JJavaError), match=message):
        roc_auc(frame(spark, [(0, 0.1), (1, 0.2), bad]), "y", "s").collect()


def test_buckets_are_even_whatever_the_distribution(spark):
    skewed = spark.range(20_000).select((F.col("id") % 2).cast("int").alias("y"), F.exp(-F.col("id") / 500).alias("s"))
    bounds = score_bounds(skewed, "s", 20)
    assert len(bounds) == 19
    sizes = [skewed.where((F.col("s") >= low) & (F.col("s") < high)).count() for low, high in zip(bounds, bounds[1:])]
    assert max(sizes) < 2 * 20_000 / 20


def test_products_beyond_64_bits(spark):
    """The exact sum of pair gains must not overflow: 3e9 rows per class would exceed a bigint."""
    from ebbtide.operators.roc import EXACT_INTEGER

    big = spark.range(1).select(F.lit(6_000_000_000).alias("n"))
    product = big.select(F.sum(F.col("n").cast(EXACT_INTEGER) * (F.lit(2) * F.col("n")).cast(EXACT_INTEGER))).first()[0]
    assert int(product) == 6_000_000_000 * 12_000_000_000


def test_score_groups_are_shuffled_once(spark):
    """The two branches over the score groups share one exchange."""
    ranked = ranked_scores(frame(spark, sample("distinct")), "y", "s", buckets=8)
    ranked.collect()
    assert "ReusedExchange" in ranked._jdf.queryExecution().executedPlan().toString()
