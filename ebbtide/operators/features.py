"""Feature encoding on the built-in ML stages, and names for the vector slots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.operators.clean import existing_columns
from ebbtide.sources import collect_small, staged

RAW_FEATURES, FEATURES = "raw_features", "features"
#: Labels of all columns together that are looked up in a map of the plan; more are joined.
LOOKUP_LABELS = 500


@dataclass(frozen=True)
class FeatureColumns:
    """Which columns feed a model, and the names derived from them."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str
    key: str | None = None

    def present_in(self, df: DataFrame) -> FeatureColumns:
        """The same selection without columns that the table lacks."""
        return replace(
            self,
            numeric=tuple(existing_columns(df, self.numeric)),
            categorical=tuple(existing_columns(df, self.categorical)),
        )

    @property
    def index_columns(self) -> list[str]:
        return [f"{name}Index" for name in self.categorical]

    @property
    def vector_columns(self) -> list[str]:
        return [f"{name}Vec" for name in self.categorical]

    @property
    def assembled(self) -> list[str]:
        return [*self.numeric, *self.vector_columns]

    @property
    def inputs(self) -> list[str]:
        """The source columns a fit reads."""
        return [self.label, *self.numeric, *self.categorical]

    @property
    def used(self) -> list[str]:
        """The source columns of a fit and of its scored rows."""
        return [*([self.key] if self.key else []), *self.inputs]


def category_counts(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Rows (column_no, label, rows) for all categorical columns, from one scan and one aggregation.

    Nulls are not labels. Counts are combined map-side, so a label that holds a
    third of the rows is one row per task in the shuffle.
    """
    names = list(categorical)
    texts = df.select(*[F.col(name).cast("string").alias(f"_c{i}") for i, name in enumerate(names)])
    column_no = F.coalesce(*[F.when(F.grouping(name) == 0, F.lit(i)) for i, name in enumerate(texts.columns)])
    counts = texts.groupingSets([[name] for name in texts.columns], *texts.columns).agg(
        column_no.alias("column_no"), F.count("*").alias("rows")
    )
    labelled = counts.select("column_no", F.coalesce(*texts.columns).alias("label"), "rows")
    return labelled.where(F.col("label").isNotNull())


def category_index(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """Vocabulary of all categorical columns as rows (column_no, label, rows, idx), from counts in the shared folder.

    Labels are numbered by frequency, ties in text order. Up to ``LOOKUP_LABELS`` of them are numbered in one window by
    column. More are range-partitioned in that order, numbered inside each partition, and shifted by what the partitions
    before hold; only one row per partition and column is then in a window by column. There is no limit on the number of
    labels and nothing reaches the driver.
    """
    order = ["column_no", F.desc("rows"), "label"]
    counts = staged(category_counts(df, categorical))
    if counts.count() <= LOOKUP_LABELS:
        place = F.row_number().over(Window.partitionBy("column_no").orderBy(F.desc("rows"), "label"))
        return counts.select("column_no", "label", "rows", (place - 1).alias("idx"))
    placed = staged(counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "column_no").orderBy(F.desc("rows"), "label")
    local = placed.withColumn("place", F.row_number().over(inside))
    sizes = placed.groupBy("column_no", "part").agg(F.count("*").alias("labels"))
    before = Window.partitionBy("column_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("column_no", "part", F.coalesce(F.sum("labels").over(before), F.lit(0)).alias("shift"))
    numbered = local.join(shifts, ["column_no", "part"])
    idx = (F.col("place") + F.col("shift") - 1).cast("int")
    return staged(numbered.select("column_no", "label", "rows", idx.alias("idx")))


def label_maps(vocabulary: DataFrame, columns: int) -> Column:
    """A scalar: for each column a map from its labels to their indices."""
    entries = F.struct("column_no", F.struct("label", "idx").alias("entry"))
    listed = vocabulary.agg(F.collect_list(entries).alias("all"))

    def one(number: Column) -> Column:
        mine = F.filter("all", lambda e: e["column_no"] == number)
        return F.map_from_entries(F.transform(mine, lambda e: e["entry"]))

    return listed.select(F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), one)).scalar()


def index_labels(df: DataFrame, columns: FeatureColumns, vocabulary: DataFrame) -> DataFrame:
    """Add an index per categorical column; nulls and labels that the vocabulary lacks get the number of labels.

    A vocabulary of up to ``LOOKUP_LABELS`` labels is one scalar of the plan for all columns: rows are looked up where
    they are. A larger one is joined on the label, column by column; the written vocabulary has a known size, so Spark
    sends a small part of it to every task without moving the rows, and splits frequent labels where it has to shuffle.
    The number of labels is in the metadata of each index, so that later stages need not look for it.
    """
    sizes = vocabulary.groupBy("column_no").agg(F.count("*").alias("labels"))
    known = {row.column_no: row.labels for row in collect_small(sizes, len(columns.categorical))}
    stacked = sum(known.values()) <= LOOKUP_LABELS
    if stacked:
        df = df.withColumn("_maps", label_maps(vocabulary, len(columns.categorical)))
    for number, (name, index) in enumerate(zip(columns.categorical, columns.index_columns)):
        label = F.col(name).cast("string")
        if stacked:
            place = F.try_element_at(F.get("_maps", F.lit(number)), label)
        else:
            mine = vocabulary.where(F.col("column_no") == number).select(
                F.col("label").alias("_label"), F.col("idx").alias("_idx")
            )
            df, place = df.join(mine, label == F.col("_label"), "left"), F.col("_idx")
        found = F.coalesce(place, F.lit(known.get(number, 0))).cast("double")
        nominal = {"ml_attr": {"type": "nominal", "num_vals": known.get(number, 0)}}
        df = df.withColumn(index, found.alias(index, metadata=nominal if known.get(number) else {})).drop("_label", "_idx")
    return df.drop("_maps")


def one_hot_encoder(columns: FeatureColumns) -> OneHotEncoder:
    """One slot per label of the training rows; an unseen label is all zeros."""
    return OneHotEncoder(
        inputCols=columns.index_columns, outputCols=columns.vector_columns, handleInvalid="keep", dropLast=True
    )


def assembler(columns: FeatureColumns) -> VectorAssembler:
    """Numeric columns, then one-hot vectors."""
    return VectorAssembler(inputCols=columns.assembled, outputCol=RAW_FEATURES)


def scaler() -> StandardScaler:
    """Divide by the sample standard deviation without centring, which keeps vectors sparse."""
    return StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withStd=True, withMean=False)


@dataclass(frozen=True)
class Encoding:
    """A fitted encoding: the vocabulary to join with, and the stages that follow."""

    columns: FeatureColumns
    vocabulary: DataFrame | None
    stages: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        indexed = df if self.vocabulary is None else index_labels(df, self.columns, self.vocabulary)
        return self.stages.transform(indexed)

    def with_scaler(self, encoded: DataFrame) -> Encoding:
        """The encoding followed by a scaler fitted on rows it has encoded."""
        return replace(self, stages=PipelineModel(stages=[*self.stages.stages, scaler().fit(encoded)]))


def fit_encoding(train: DataFrame, columns: FeatureColumns) -> Encoding:
    """Vocabulary, one-hot encoder and assembler, fitted on the training rows."""
    if not columns.categorical:
        return Encoding(columns, None, PipelineModel(stages=[assembler(columns)]))
    vocabulary = category_index(train, columns.categorical)
    indexed = index_labels(train.select(*columns.categorical), columns, vocabulary)
    one_hot = one_hot_encoder(columns).fit(indexed)
    return Encoding(columns, vocabulary, PipelineModel(stages=[one_hot, assembler(columns)]))


def fit_features(train: DataFrame, columns: FeatureColumns) -> Encoding:
    """All feature stages, fitted on training rows only."""
    encoding = fit_encoding(train, columns)
    return encoding.with_scaler(encoding.transform(train))


def feature_names(spark: SparkSession, encoding: Encoding) -> DataFrame:
    """Rows (idx, feature), one per vector slot: ``column`` or ``column=label``, with all fitted labels."""
    numeric, categorical = encoding.columns.numeric, encoding.columns.categorical
    slots = spark.createDataFrame(list(enumerate(numeric)), "idx int, feature string")
    if encoding.vocabulary is None:
        return slots
    sizes = encoding.vocabulary.groupBy("column_no").agg(F.count("*").alias("labels"))
    before = Window.orderBy("column_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per column
    firsts = sizes.select("column_no", F.coalesce(F.sum("labels").over(before), F.lit(0)).alias("first"))
    name = F.get(F.array(*map(F.lit, categorical)), F.col("column_no"))
    labels = encoding.vocabulary.join(firsts, "column_no").select(
        (F.col("first") + F.col("idx") + len(numeric)).cast("int").alias("idx"),
        F.concat(name, F.lit("="), "label").alias("feature"),
    )
    return slots.unionByName(labels)


def vector_width(encoded: DataFrame, vector: str = FEATURES) -> int:
    """Number of slots, from the column's metadata."""
    return encoded.schema[vector].metadata["ml_attr"]["num_attrs"]
