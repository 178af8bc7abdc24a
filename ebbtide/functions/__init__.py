"""Column expressions shared by the operators; all of them are built-in Spark functions."""

from ebbtide.functions.binning import bin_labels, right_closed_bin
from ebbtide.functions.hashing import hash_number, unit_hash
from ebbtide.functions.numbers import binary_value, percent, percent_text, required, safe_ratio
from ebbtide.functions.scoring import positive_probability, sigmoid, sum_of, weight_of

__all__ = [
    "bin_labels",
    "binary_value",
    "hash_number",
    "percent",
    "percent_text",
    "positive_probability",
    "required",
    "right_closed_bin",
    "safe_ratio",
    "sigmoid",
    "sum_of",
    "unit_hash",
    "weight_of",
]
