"""All segment rates of a table in one scan and one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import bin_labels, percent, right_closed_bin
from ebbtide.operators.segments import rate_measures, rate_pct

BIN, ORDINAL, CATEGORY = "bin", "ordinal", "category"


@dataclass(frozen=True)
class Segment:
    """One way to cut the table: by right-closed bins, by ordinal value, or by category."""

    name: str
    column: str
    kind: str = CATEGORY
    edges: tuple[float, ...] = ()

    def key(self) -> Column:
        value = F.col(self.column)
        return right_closed_bin(value, self.edges) if self.kind == BIN else value

    def position(self, key: str) -> Column:
        """Sort position inside the segment; categories have none and sort by rate."""
        return F.lit(None).cast("double") if self.kind == CATEGORY else F.col(key).cast("double")

    def text(self, key: str) -> Column:
        if self.kind != BIN:
            return F.col(key).cast("string")
        return F.get(F.array(*map(F.lit, bin_labels(self.edges))), F.col(key))


def segment_report(df: DataFrame, label: str, segments: Sequence[Segment]) -> DataFrame:
    """Rows (segment, position, value, rows, positives, rate_pct) of every segment.

    Grouping sets expand each row once per segment inside the scan stage and
    combine map-side, so the shuffle carries one row per task and segment value
    and the table is read once however many segments there are. Empty bins are
    listed with a null rate; rows outside all bins of a segment are left out of it.
    """
    keys = [f"_key_{i}" for i in range(len(segments))]
    keyed = df.select(label, *[segment.key().alias(key) for key, segment in zip(keys, segments)])
    segment_no = F.coalesce(*[F.when(F.grouping(key) == 0, F.lit(i)) for i, key in enumerate(keys)])
    grouped = keyed.groupingSets([[key] for key in keys], *keys).agg(
        segment_no.alias("segment_no"), *rate_measures(label)
    )
    # Only the key a row is grouped by is set, so the others contribute null.
    measured = grouped.select(
        "segment_no",
        F.get(F.array(*[F.lit(segment.name) for segment in segments]), F.col("segment_no")).alias("segment"),
        F.coalesce(*[segment.position(key) for key, segment in zip(keys, segments)]).alias("position"),
        F.coalesce(*[segment.text(key) for key, segment in zip(keys, segments)]).alias("value"),
        "rows",
        "positives",
    ).where(F.col("value").isNotNull())
    return (
        _with_empty_bins(measured, segments)
        .select("segment_no", "segment", "position", "value", "rows", "positives", rate_pct())
        .orderBy("segment_no", "position", F.desc("rate_pct"), "value")
    )


def class_report(df: DataFrame, label: str, segments: Sequence[Segment]) -> DataFrame:
    """Rows (segment_no, segment, position, value, class, rows, share_pct): the classes of the table and of every segment.

    The class is a second dimension of the grouping sets, and alone it is one of them: segment number -1, the whole
    table. Shares are within a segment's value. One scan and one aggregation of the rows for everything; the label may
    have any number of classes, null is one of them. Rows outside all bins of a segment are left out of it.
    """
    keys = [f"_key_{i}" for i in range(len(segments))]
    keyed = df.select(F.col(label).alias("_class"), *[s.key().alias(key) for key, s in zip(keys, segments)])
    numbers = [F.when(F.grouping(key) == 0, F.lit(i)) for i, key in enumerate(keys)]
    grouped = keyed.groupingSets([["_class"], *[[key, "_class"] for key in keys]], *keys, "_class").agg(
        F.coalesce(*numbers, F.lit(-1)).alias("segment_no"), F.count("*").alias("rows")
    )
    measured = grouped.select(
        "segment_no",
        F.get(F.array(F.lit("all"), *[F.lit(s.name) for s in segments]), F.col("segment_no") + 1).alias("segment"),
        F.coalesce(*[s.position(key) for key, s in zip(keys, segments)], F.lit(None).cast("double")).alias("position"),
        F.coalesce(*[s.text(key) for key, s in zip(keys, segments)], F.lit(None).cast("string")).alias("value"),
        F.col("_class").alias("class"),
        "rows",
    ).where(F.col("value").isNotNull() | (F.col("segment_no") < 0))
    whole = F.sum("rows").over(Window.partitionBy("segment_no", "value"))  # over one row per class
    return measured.withColumn("share_pct", percent(F.col("rows"), whole)).orderBy("segment_no", "position", "value", "class")


def _with_empty_bins(measured: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    zeros = [
        F.struct(
            F.lit(number).alias("segment_no"),
            F.lit(segment.name).alias("segment"),
            F.lit(float(position)).alias("position"),
            F.lit(text).alias("value"),
            F.lit(0).cast("bigint").alias("rows"),
            F.lit(0).cast("bigint").alias("positives"),
        )
        for number, segment in enumerate(segments)
        if segment.kind == BIN
        for position, text in enumerate(bin_labels(segment.edges))
    ]
    if not zeros:
        return measured
    listed = measured.sparkSession.range(1).select(F.inline(F.array(*zeros)))
    return (
        measured.unionByName(listed)
        .groupBy("segment_no", "segment", "position", "value")
        .agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives"))
    )
