"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import staged


def _least(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour of every u, itself included. Written, so that the join with a hub's many pairs can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return staged(least.select(F.col("u").alias("of"), F.least("u", "m").alias("m")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    moved = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("of"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, F.col("u") == F.col("of"))
    to_least = moved.select("v", "m").union(moved.select("u", "m"))
    return to_least.toDF("u", "v").where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).head()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the smallest node of the component.

    Every half step is written to the shared folder. An empty table gives an empty one.
    """
    links = staged(links.where("u <> v").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = staged(_small_star(staged(_large_star(links), "large-star")), "small-star")
        after = _state(links)
        if after == state:
            break
        state = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
