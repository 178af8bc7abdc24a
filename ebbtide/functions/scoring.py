"""Pieces of additive scores, and access to a classifier's score."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def weight_of(category: Column, weights: Mapping[str, float]) -> Column:
    """Weight listed for the category; null for a category that is not listed."""
    pairs = chain.from_iterable((F.lit(name), F.lit(float(weight))) for name, weight in weights.items())
    return F.create_map(*pairs)[category]


def sum_of(terms: Iterable[Column]) -> Column:
    """Left-to-right sum of the terms, 0.0 if there are none."""
    return reduce(add, terms, F.lit(0.0))


def positive_probability(columns: Iterable[str], probability: str, prediction: str) -> Column:
    """Probability of class 1, or the hard prediction where a model offers no probability."""
    if probability in columns:
        return vector_to_array(F.col(probability))[1]
    return F.col(prediction).cast("double")
