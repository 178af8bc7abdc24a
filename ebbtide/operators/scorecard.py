"""Additive risk scorecard and tariff rating: one projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import sigmoid, sum_of, weight_of


@dataclass(frozen=True)
class Scorecard:
    """Weights of an additive logit.

    ``categories``: weight per listed category of a column. ``flags``: weight
    added where a column equals a value. ``linear``: weight and centre of a numeric column.
    """

    offset: float = 0.0
    categories: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    flags: Mapping[tuple[str, object], float] = field(default_factory=dict)
    linear: Mapping[str, tuple[float, float]] = field(default_factory=dict)


@dataclass(frozen=True)
class Tariff:
    """Base charge per month, add-ons where a column equals a value, and the column counting months."""

    base: float
    add_ons: Mapping[tuple[str, object], float]
    months: str


def risk_scorecard(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add ``logit`` and ``risk``; both are null where a category has no weight (see the domain check)."""
    terms = [F.lit(float(card.offset))]
    terms += [weight_of(F.col(column), weights) for column, weights in card.categories.items()]
    terms += [_if_equal(column, value, weight) for (column, value), weight in card.flags.items()]
    for column, (weight, centre) in card.linear.items():
        terms.append(F.lit(float(weight)) * (F.col(column) - F.lit(centre)))
    return df.withColumn("logit", sum_of(terms)).withColumn("risk", sigmoid(F.col("logit")))


def tariff_rating(df: DataFrame, tariff: Tariff) -> DataFrame:
    """Add ``expected_monthly`` and ``expected_total`` (monthly charge times months)."""
    charges = [F.lit(float(tariff.base))]
    charges += [_if_equal(column, value, amount) for (column, value), amount in tariff.add_ons.items()]
    rated = df.withColumn("expected_monthly", sum_of(charges))
    return rated.withColumn("expected_total", F.col("expected_monthly") * F.col(tariff.months))


def _if_equal(column: str, value: object, amount: float):
    return F.when(F.col(column) == F.lit(value), F.lit(float(amount))).otherwise(F.lit(0.0))
