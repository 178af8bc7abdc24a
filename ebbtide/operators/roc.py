"""ROC curve and area under it, exact and without a single-task window.

A score such as a logistic probability is nearly unique per row, so there can be
as many curve points as rows. The running sums are therefore computed per score
bucket: bucket bounds are quantiles of the score, a bucket is a pure function of
the score (stable under retries), the totals of all buckets form a small table,
and only rows of one bucket meet in one task. Bounds decide the balance of the
work, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import binary_value, required, safe_ratio

EXACT_INTEGER = "decimal(18,0)"
ROWS_PER_BUCKET = 1_000_000


def score_groups(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; combined map-side, so a hot score is one row per task."""
    value = required(F.col(score).cast("double"), score)
    checked = F.when(F.isnan(value), F.raise_error(F.lit(f"NaN in {score}")).cast("double")).otherwise(value)
    positive = binary_value(label) == 1
    return (
        df.select(*by, checked.alias("score"), positive.alias("_positive"))
        .groupBy(*by, "score")
        .agg(F.count_if("_positive").alias("pos"), F.count_if(~F.col("_positive")).alias("neg"))
    )


def score_bounds(df: DataFrame, score: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` increasing score quantiles that cut the rows into even parts.

    One pass with a mergeable sketch; only the bounds reach the driver.
    """
    if buckets < 2:
        return []
    wanted = [step / buckets for step in range(1, buckets)]
    values = df.select(F.col(score).cast("double").alias(score)).approxQuantile(score, wanted, 1.0 / (4 * buckets))
    return sorted({value for value in values if math.isfinite(value)})


def ranked_scores(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Score groups with running counts from the highest score down and the class totals.

    Adds ``cum_pos`` and ``cum_neg`` (this group included), ``all_pos``,
    ``all_neg``, and ``next_pos`` and ``next_neg``, the counts of the next lower
    score (null at the end). ``buckets`` defaults to one per ``ROWS_PER_BUCKET``
    rows, so that what one task sorts does not grow with the data.
    """
    by = list(by)
    if buckets is None:
        buckets = -(-df.count() // ROWS_PER_BUCKET)
    bounds = score_bounds(df, score, buckets)
    groups = score_groups(df, label, score, by)
    if bounds:
        splits = [-math.inf, *bounds, math.inf]
        groups = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(groups)
    else:
        groups = groups.withColumn("bucket", F.lit(0.0))

    # One row per bucket (and model): its size is set by `buckets`, not by the data.
    downward = Window.partitionBy(*by).orderBy(F.desc("bucket"))
    above = downward.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    totals = groups.groupBy(*by, "bucket").agg(
        F.sum("pos").alias("bucket_pos"),
        F.sum("neg").alias("bucket_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"),
    )
    carried = {
        "all_pos": F.sum("bucket_pos").over(everything),
        "all_neg": F.sum("bucket_neg").over(everything),
        "below_pos": F.lead("top.pos").over(downward),
        "below_neg": F.lead("top.neg").over(downward),
    }
    heads = totals.select(
        *by,
        "bucket",
        F.lit(None).cast("double").alias("score"),
        F.coalesce(F.sum("bucket_pos").over(above), F.lit(0)).alias("pos"),
        F.coalesce(F.sum("bucket_neg").over(above), F.lit(0)).alias("neg"),
        *[value.alias(name) for name, value in carried.items()],
    )

    # Each bucket starts with its head row, which brings in what lies above the
    # bucket: a union instead of a join, so `groups` is one shuffle read twice.
    inside = Window.partitionBy(*by, "bucket").orderBy(F.desc_nulls_first("score"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = heads.unionByName(groups, allowMissingColumns=True).select(
        *by,
        "score",
        "pos",
        "neg",
        F.sum("pos").over(so_far).alias("cum_pos"),
        F.sum("neg").over(so_far).alias("cum_neg"),
        F.first("all_pos").over(so_far).alias("all_pos"),
        F.first("all_neg").over(so_far).alias("all_neg"),
        F.coalesce(F.lead("pos").over(inside), F.first("below_pos").over(so_far)).alias("next_pos"),
        F.coalesce(F.lead("neg").over(inside), F.first("below_neg").over(so_far)).alias("next_neg"),
    )
    return placed.where(F.col("score").isNotNull())


def roc_curve(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    buckets: int | None = None,
    drop_intermediate: bool = False,
) -> DataFrame:
    """Rows (threshold, fpr, tpr): the origin (null threshold) and one point per distinct score.

    ``drop_intermediate`` leaves out points on a straight piece of the curve: a
    point stays if the step behind it differs from the step before it, and the
    first and the last point always stay. Rates over an absent class are null.
    """
    ranked = ranked_scores(df, label, score, by, buckets)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    if drop_intermediate:
        same_step = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        ranked = ranked.where(first | F.col("next_pos").isNull() | ~same_step)
    point = F.struct(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("cum_neg"), F.col("all_neg"), default=None).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("all_pos"), default=None).alias("tpr"),
    )
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.when(F.col("all_neg") > 0, F.lit(0.0)).alias("fpr"),
        F.when(F.col("all_pos") > 0, F.lit(0.0)).alias("tpr"),
    )
    return ranked.select(*by, F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def roc_auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Area under the ROC curve as a ratio of exact integers; null if a class is absent.

    Each positive gains 2 per negative scored lower and 1 per negative scored
    equal; the area is that sum over ``2 * positives * negatives``. Decimals
    hold the products, which outgrow a 64-bit integer at a few billion rows.
    """
    ranked = ranked_scores(df, label, score, by, buckets)
    lower = F.col("all_neg") - F.col("cum_neg")
    gain = F.col("pos").cast(EXACT_INTEGER) * (F.lit(2) * lower + F.col("neg")).cast(EXACT_INTEGER)
    summed = (ranked.groupBy(*by) if by else ranked).agg(
        F.sum(gain).alias("gain"),
        F.max("all_pos").alias("positives"),
        F.max("all_neg").alias("negatives"),
    )
    pairs = F.lit(2).cast("double") * F.col("positives") * F.col("negatives")
    return summed.select(
        *by, "positives", "negatives", safe_ratio(F.col("gain").cast("double"), pairs, default=None).alias("roc_auc")
    )
