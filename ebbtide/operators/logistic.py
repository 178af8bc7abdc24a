"""Logistic regression by Newton steps on an aggregated Gram matrix.

A step is one aggregation: the sums of weighted outer products of the features, of the gradient and of the log
likelihood. What comes back is one row whose size is set by the number of features; rows are never cached, sorted or
moved. Newton's method has no learning rate or line-search parameters and stops where the gradient is zero up to the
rounding of its own sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import binary_value, required, sigmoid, sum_of
from ebbtide.sources import collect_small

INTERCEPT = "(intercept)"
MAX_STEPS = 50
HALVINGS = 20


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients by feature name, the intercept first, and how the fit ended."""

    coefficients: dict[str, float]
    log_likelihood: float
    steps: int
    converged: bool

    def logit(self, features: Mapping[str, Column]) -> Column:
        terms = [F.lit(weight) * features[name].cast("double") for name, weight in self.coefficients.items() if name != INTERCEPT]
        return sum_of([F.lit(self.coefficients[INTERCEPT]), *terms])

    def probability(self, features: Mapping[str, Column]) -> Column:
        return sigmoid(self.logit(features))

    def table(self, df: DataFrame) -> DataFrame:
        """Rows (idx, feature, coefficient), made in the session of ``df``."""
        entries = [
            F.struct(F.lit(i).alias("idx"), F.lit(name).alias("feature"), F.lit(value).alias("coefficient"))
            for i, (name, value) in enumerate(self.coefficients.items())
        ]
        return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def _standard(df: DataFrame, features: Mapping[str, Column]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature, from one aggregation; a constant feature has deviation 0."""
    sums = []
    for i, column in enumerate(features.values()):
        value = column.cast("double")
        sums += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = collect_small(df.agg(*sums), 1)[0]
    means = np.array([row[f"m{i}"] for i in range(len(features))], float)
    return means, np.array([row[f"s{i}"] for i in range(len(features))], float)


def fit_logistic(
    df: DataFrame, features: Mapping[str, Column], label: str, ridge: float = 0.0, max_steps: int = MAX_STEPS
) -> LogisticFit:
    """Maximum likelihood, with ``ridge`` times the squared standardised coefficients taken off twice the likelihood.

    Features are standardised inside and given back in their own units. Constant features get 0, and of features that
    determine each other the least solution is taken. Classes that the features part completely have no maximum: the fit
    ends unconverged after ``max_steps``. Nulls, labels other than 0 and 1, and a table without rows are errors.
    """
    named = {name: required(column.cast("double"), name) for name, column in features.items()}
    source = df.select(binary_value(label).alias("y"), *[column.alias(f"x{i}") for i, column in enumerate(named.values())])
    raw = {f"x{i}": F.col(f"x{i}") for i in range(len(named))}
    means, deviations = _standard(source, raw)
    if np.isnan(means).any():
        raise ValueError("no rows to fit on")
    used = np.flatnonzero(deviations > 0)
    columns = [F.lit(1.0), *[(F.col(f"x{i}") - float(means[i])) / float(deviations[i]) for i in used]]
    rows = source.select("y", *[column.alias(f"u{i}") for i, column in enumerate(columns)])
    size = len(columns)
    penalty = np.full(size, ridge)
    penalty[0] = 0.0

    def sums_at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = sum_of(F.lit(float(w)) * F.col(f"u{i}") for i, w in enumerate(weights))
        placed = rows.withColumn("z", z).withColumn("p", sigmoid(F.col("z")))
        spread = F.col("p") * (1 - F.col("p"))
        # log(1 + exp(z)) without overflow
        softplus = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z")))
        entries = [F.sum(F.col("y") * F.col("z") - softplus).alias("l")]
        entries += [F.sum((F.col("y") - F.col("p")) * F.col(f"u{i}")).alias(f"g{i}") for i in range(size)]
        entries += [
            F.sum(spread * F.col(f"u{i}") * F.col(f"u{j}")).alias(f"h{i}_{j}") for i in range(size) for j in range(i + 1)
        ]
        row = collect_small(placed.agg(*entries), 1)[0]
        gram = np.array([[row[f"h{max(i, j)}_{min(i, j)}"] for j in range(size)] for i in range(size)])
        gradient = np.array([row[f"g{i}"] for i in range(size)]) - penalty * weights
        return row["l"] - float(penalty @ weights**2) / 2, gradient, gram + np.diag(penalty)

    weights = np.zeros(size)
    likelihood, gradient, gram = sums_at(weights)
    steps, converged = 0, False
    while steps < max_steps and not converged:
        step = np.linalg.lstsq(gram, gradient, rcond=1e-12)[0]
        promised = float(gradient @ step)  # twice what the step should gain
        converged = promised <= 1e-10 * max(1.0, abs(likelihood)) * 1e-3
        if converged:
            break
        steps += 1
        for halving in range(HALVINGS):
            tried = weights + step / 2**halving
            found = sums_at(tried)
            if found[0] >= likelihood - 1e-12 * abs(likelihood):
                weights, (likelihood, gradient, gram) = tried, found
                break
        else:
            break
    scaled = np.zeros(len(named))
    scaled[used] = weights[1:] / deviations[used]
    intercept = float(weights[0] - scaled @ means)
    coefficients = {INTERCEPT: intercept, **dict(zip(named, scaled.tolist()))}
    return LogisticFit(coefficients, float(likelihood), steps, converged)


def fitted_moments(df: DataFrame, fit: LogisticFit, features: Mapping[str, Column], label: str) -> DataFrame:
    """Rows (idx, feature, observed, fitted): sums of each feature over class 1, and over all rows by their probability.

    At the maximum of the likelihood, and only there, the two are equal for every feature and for the intercept.
    """
    names: Sequence[str] = [INTERCEPT, *features]
    placed = df.select(
        binary_value(label).cast("double").alias("y"),
        fit.probability(features).alias("p"),
        F.array(F.lit(1.0), *[column.cast("double") for column in features.values()]).alias("x"),
    )
    each = placed.select("y", "p", F.posexplode("x").alias("idx", "value"))
    summed = each.groupBy("idx").agg(
        F.sum(F.col("y") * F.col("value")).alias("observed"), F.sum(F.col("p") * F.col("value")).alias("fitted")
    )
    name = F.get(F.array(*map(F.lit, names)), F.col("idx"))
    return summed.select("idx", name.alias("feature"), "observed", "fitted")
