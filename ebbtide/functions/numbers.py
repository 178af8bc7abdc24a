"""Ratios that are safe under ANSI mode, and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """``numerator / denominator``, or ``default`` where the denominator is not positive."""
    fallback = F.lit(default).cast("double")
    return F.when(denominator > 0, numerator / denominator).otherwise(fallback)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null for an empty whole."""
    return F.when(whole > 0, F.lit(100.0) * part / whole)


def percent_text(value: Column, places: int = 1) -> Column:
    """``12.3%`` as drawn on a chart, rounded half up; null stays null."""
    return F.when(value.isNotNull(), F.format_string(f"%.{places}f%%", value))


def required(value: Column, name: str) -> Column:
    """The value itself; a null fails the query instead of vanishing from the result."""
    return F.coalesce(value, F.raise_error(F.lit(f"null in required column {name}")))


def binary_value(name: str) -> Column:
    """A 0/1 column as an integer; any other value, null and NaN included, fails the query before it is cast."""
    value = F.col(name)
    found = F.coalesce(value.cast("string"), F.lit("null"))
    refused = F.raise_error(F.format_string(f"{name} must be 0 or 1, found %s", found)).cast("int")
    return F.when(value.isin(0, 1), value.cast("int")).otherwise(refused)
