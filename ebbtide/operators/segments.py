"""Class shares and label rates per segment.

Labels are 0/1. Every function aggregates before it shuffles, so a hot segment
costs one partial row per task and never gathers its rows anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import bin_labels, binary_value, percent, percent_text, right_closed_bin


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share in percent per class (also as chart text), ordered by class."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # over one row per class
    shares = counts.select(label, "rows", percent(F.col("rows"), total).alias("share_pct"))
    return shares.withColumn("share_text", percent_text(F.col("share_pct"))).orderBy(label)


def rate_measures(label: str) -> list[Column]:
    """Rows and the positives among them; a label other than 0 and 1 fails the query."""
    value = binary_value(label)
    return [F.count(value).alias("rows"), F.sum(value.cast("bigint")).alias("positives")]


def rate_pct() -> Column:
    return percent(F.col("positives"), F.col("rows")).alias("rate_pct")


def rate_by_bin(df: DataFrame, value: str, label: str, edges: Sequence[float]) -> DataFrame:
    """Label rate per right-closed bin; every bin is listed in order, an empty one with a null rate.

    Values outside the bins (null, NaN, at or below the first edge) are in no
    bin; the comparison that leaves them out is pushed to the scan.
    """
    inside = df.where((F.col(value) > F.lit(edges[0])) & ~F.isnan(value))
    measured = inside.groupBy(right_closed_bin(F.col(value), edges).alias("bin")).agg(*rate_measures(label))
    rates = complete_bins(measured, edges).select("bin", "bin_label", "rows", "positives", rate_pct())
    return rates.withColumn("rate_text", percent_text(F.col("rate_pct"))).orderBy("bin")


def complete_bins(measured: DataFrame, edges: Sequence[float]) -> DataFrame:
    """All bins left-joined with the measured ones; absent bins have zero rows.

    ``measured`` holds at most one row per bin, so its broadcast is bounded by
    the number of edges whatever the size of the data.
    """
    labels = bin_labels(edges)
    domain = measured.sparkSession.range(len(labels)).select(
        F.col("id").cast("int").alias("bin"),
        F.get(F.array(*map(F.lit, labels)), F.col("id").cast("int")).alias("bin_label"),
    )
    return domain.join(F.broadcast(measured), "bin", "left").na.fill(0, ["rows", "positives"])


def rate_by_category(df: DataFrame, category: str, label: str) -> DataFrame:
    """Label rate per category, highest first; the category breaks ties."""
    return _rate_by(df, category, label).orderBy(F.desc("rate_pct"), category)


def rate_by_ordinal(df: DataFrame, value: str, label: str) -> DataFrame:
    """Label rate per value of an ordinal column, in its order."""
    return _rate_by(df, value, label).orderBy(value)


def _rate_by(df: DataFrame, key: str, label: str) -> DataFrame:
    measured = df.where(F.col(key).isNotNull()).groupBy(key).agg(*rate_measures(label))
    return measured.select(key, "rows", "positives", rate_pct())
