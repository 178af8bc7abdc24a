"""Train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import required, unit_hash

TRAIN, TEST = "train", "test"


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Seeded Bernoulli split: disjoint, complete, and only about the given shares.

    Which rows go where depends on the partition layout, and each part sorts
    its partitions on all columns. On large tables prefer ``hash_split``.
    """
    return df.randomSplit(list(weights), seed=seed)


def hash_split(df: DataFrame, *keys: str, train_share: float = 0.8, salt: str = "") -> DataFrame:
    """Add ``part`` = train/test from a hash of the key columns.

    The part depends on the keys alone, so it survives repartitioning, retries
    and appended data. No shuffle, no sort. Rows that share all keys share a
    part: name enough columns to tell rows apart if one key value is frequent,
    or the shares follow that value.
    """
    if not keys or not 0.0 < train_share < 1.0:
        raise ValueError("at least one key, and a train_share between 0 and 1")
    texts = [required(F.col(name), name).cast("string") for name in keys]
    draw = unit_hash(F.concat_ws("|", *texts) if len(texts) > 1 else texts[0], salt)
    return df.withColumn("part", F.when(draw < F.lit(train_share), F.lit(TRAIN)).otherwise(F.lit(TEST)))


def split_frames(parted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two parts of a ``hash_split`` as frames."""
    return tuple(parted.where(F.col("part") == part).drop("part") for part in (TRAIN, TEST))


def split_counts(parted: DataFrame) -> DataFrame:
    """Rows per part, in one pass."""
    return parted.groupBy("part").agg(F.count("*").alias("rows"))
