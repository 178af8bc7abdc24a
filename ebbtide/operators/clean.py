"""Null filter, column selection and preview."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without a null (or NaN) in ``subset``, by default in any column.

    Same result as ``dropna("any")``, written as one condition per column so
    that the null tests reach the parquet scan; with a ``subset``, columns that
    are neither tested nor used later are not read.
    """
    tested = list(df.columns if subset is None else subset)
    if not tested:
        return df
    return df.where(reduce(and_, (_present(df, name) for name in tested)))


def _present(df: DataFrame, name: str) -> Column:
    value = df[name]
    present = value.isNotNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value)
    return present


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that the table has, in the wanted order."""
    have = set(df.columns)
    return [name for name in wanted if name in have]


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows in key order: a top-k plan, not a full sort."""
    return df.orderBy(key).limit(rows)
