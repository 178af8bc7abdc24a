"""Right-closed binning with an open last bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """Ordinal of the bin ``(e0, e1], (e1, e2], ..., (ek, inf)`` that holds ``value``.

    Null for null, NaN and values at or below the first edge. A value equal to
    an edge belongs to the bin on its left, which is why ``Bucketizer``
    (left-closed) is not used. The last bin is open, so no maximum is needed.
    """
    _check_edges(edges)
    ordinal = F.when(value.isNull() | F.isnan(value) | (value <= F.lit(edges[0])), F.lit(None).cast("int"))
    for position, upper in enumerate(edges[1:]):
        ordinal = ordinal.when(value <= F.lit(upper), F.lit(position))
    return ordinal.otherwise(F.lit(len(edges) - 1))


def bin_labels(edges: Sequence[float]) -> list[str]:
    """Interval text for every ordinal that ``right_closed_bin`` can give."""
    _check_edges(edges)
    closed = [f"({low:g},{high:g}]" for low, high in zip(edges, edges[1:])]
    return [*closed, f">{edges[-1]:g}"]


def _check_edges(edges: Sequence[float]) -> None:
    if not edges:
        raise ValueError("at least one bin edge is needed")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError(f"bin edges must increase: {list(edges)}")
