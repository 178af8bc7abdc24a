"""Decision trees and forests as tables: grown with aggregations, scored with native expressions, ranked with SQL.

A fitted model is one row per node: (tree, node, left, right, feature, threshold, categories, n, positives, gain), nodes
of a tree numbered from 0, its root. Left are values up to the threshold, or those among ``categories``. A leaf has no
feature. ``grow_forest`` makes such a table; ``model_nodes`` reads a fitted tree model of Spark as one.

Growing: features become bins, one pass per level sums weights per (tree, node, feature, bin), and the best cut of every
node follows from running sums over its bins. Rows are never sorted or moved, a level's shuffle holds sums only, their
number is set by trees, nodes, features and bins, and what all tasks get is one cut per node. Which rows a tree
draws and which features a node looks at are hashes of row key, tree and node, and all sums are integers: the same table
gives the same forest on any layout.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions import binary_value, required, sum_of, unit_hash
from ebbtide.sources import collect_small, staged, staging_path

#: Rows that the bin edges are taken from: all, or about so many, chosen by a hash of their key.
EDGE_ROWS = 100_000
LEAST_GAIN = 1e-12
MAX_DEPTH = 12
#: Chances of at most 0, 1, 2 ... draws of a row in a sample as large as the table (Poisson with mean 1).
DRAWS = tuple(accumulate(math.exp(-1) / math.factorial(k) for k in range(8)))
NODE_COLUMNS = ("tree", "node", "left", "right", "feature", "threshold", "categories", "n", "positives", "gain")


@dataclass(frozen=True)
class Growth:
    """How a forest is grown. ``subset`` features are looked at per node, all by default."""

    trees: int = 20
    depth: int = 5
    bins: int = 32
    subset: int | None = None
    bagging: bool = True
    seed: int = 42

    def __post_init__(self) -> None:
        if not (self.trees > 0 and 0 < self.depth <= MAX_DEPTH and self.bins > 1):
            raise ValueError(f"trees from 1, depth from 1 to {MAX_DEPTH}, bins from 2")


def single_tree(depth: int = 5, bins: int = 32) -> Growth:
    """One tree on all rows and features."""
    return Growth(trees=1, depth=depth, bins=bins, bagging=False)


def root_subset(features: int) -> int:
    """The number of features that a node of a classification forest looks at: the root of their number, rounded up."""
    return math.ceil(math.sqrt(features))


def key_text(keys: Sequence[str]) -> Column:
    """The columns that tell rows apart, as one text."""
    return F.concat_ws("|", *[required(F.col(name), name).cast("string") for name in keys])


def bin_edges(df: DataFrame, features: Mapping[str, Column], keys: Sequence[str], bins: int) -> DataFrame:
    """Rows (feature, threshold): cuts between neighbouring values that part the rows of a feature into even bins.

    A feature of at most ``bins`` values has a cut between any two. What is sorted is a sample of about ``EDGE_ROWS``
    rows, the same on any layout.
    """
    share = min(1.0, EDGE_ROWS / max(df.count(), 1))
    sampled = df if share == 1.0 else df.where(unit_hash(key_text(keys), "edges: ") < share)
    values = [required(value.cast("double"), name) for name, value in features.items()]
    listed = sampled.select(F.posexplode(F.array(*values)).alias("feature", "value"))
    upward = Window.partitionBy("feature").orderBy("value")
    everything = Window.partitionBy("feature")
    placed = listed.groupBy("feature", "value").agg(F.count("*").alias("rows")).select(
        "feature",
        "value",
        F.lead("value").over(upward).alias("above"),
        F.sum("rows").over(upward.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
        "rows",
        F.sum("rows").over(everything).alias("all"),
        F.count("*").over(everything).alias("distinct"),
    )
    before = F.col("so_far") - F.col("rows")
    crosses = F.floor(F.col("so_far") * bins / F.col("all")) > F.floor(before * bins / F.col("all"))
    cuts = placed.where(F.col("above").isNotNull() & ((F.col("distinct") <= bins) | crosses))
    return cuts.select("feature", ((F.col("value") + F.col("above")) / 2).alias("threshold"))


def _per_tree(nodes: DataFrame, trees: int, slots: int, fields: Column) -> Column:
    """A scalar: for each tree an array whose place ``slot`` holds ``fields`` of that slot, or null."""
    spark = nodes.sparkSession
    grid = spark.range(trees * slots).select(
        F.floor(F.col("id") / slots).cast("int").alias("of_tree"), (F.col("id") % slots).alias("of_slot")
    )
    held = grid.join(nodes, (F.col("of_tree") == F.col("tree")) & (F.col("of_slot") == F.col("slot")), "left")
    one = held.agg(F.array_sort(F.collect_list(F.struct("of_tree", "of_slot", fields.alias("held")))).alias("all"))
    return one.select(
        F.transform(
            F.sequence(F.lit(0), F.lit(trees - 1)),
            lambda tree: F.transform(F.slice("all", tree * slots + 1, F.lit(slots)), lambda entry: entry["held"]),
        )
    ).scalar()


def _best_cuts(sums: DataFrame) -> DataFrame:
    """(tree, path, n, positives, feature, cut, gain and the left counts): the best cut of each node, null without one."""
    of_feature = Window.partitionBy("tree", "path", "feature")
    upward = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    running = sums.select(
        "tree", "path", "feature", "bin",
        F.sum("n").over(upward).alias("left_n"), F.sum("p").over(upward).alias("left_p"),
        F.sum("n").over(of_feature).alias("n"), F.sum("p").over(of_feature).alias("positives"),
    )

    def weighted_impurity(n: Column, p: Column) -> Column:
        return F.when(n > 0, F.lit(2.0) * p * (n - p) / n).otherwise(F.lit(0.0))

    n, p, left_n, left_p = (F.col(c) for c in ("n", "positives", "left_n", "left_p"))
    parts = weighted_impurity(left_n, left_p) + weighted_impurity(n - left_n, p - left_p)
    gain = (weighted_impurity(n, p) - parts) / n
    cut = F.when(
        (left_n < n) & (gain > LEAST_GAIN),
        F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "left_n", "left_p"),
    )
    best = running.groupBy("tree", "path").agg(F.max("n").alias("n"), F.max("positives").alias("positives"), F.max(cut).alias("best"))
    return best.select(
        "tree", "path", "n", "positives", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("cut"),
        "best.gain", "best.left_n", "best.left_p",
    )


def grow_forest(
    train: DataFrame, features: Mapping[str, Column], label: str, keys: Sequence[str], growth: Growth = Growth()
) -> DataFrame:
    """Node rows, with ``path`` (root 1, children 2 i and 2 i + 1) beside the columns that every model table has.

    ``keys`` tell rows apart; rows equal in all keys are drawn together. Nulls in keys or features and labels other than
    0 and 1 fail the query. Without rows there are no nodes. Reads the table twice (count and edges, bins) and the
    written bins once per level.
    """
    count = len(features)
    edges = staged(bin_edges(train, features, keys, growth.bins))
    cuts = [[] for _ in features]
    for row in collect_small(edges.orderBy("feature", "threshold"), count * growth.bins):
        cuts[row.feature].append(row.threshold)
    held_cuts = _constant(train.sparkSession, cuts, "array<array<double>>")

    def bin_of(value: Column, number: int) -> Column:
        return F.size(F.filter(F.get(F.col("cuts"), F.lit(number)), lambda cut: cut < value))

    def weight(tree: int) -> Column:
        drawn = unit_hash(F.col("key"), f"draw {growth.seed} {tree}: ")
        return sum_of((F.lit(chance) <= drawn).cast("int") for chance in DRAWS).cast("int")

    weights = F.array(*[weight(tree) if growth.bagging else F.lit(1) for tree in range(growth.trees)])
    named = {f"v{i}": required(value.cast("double"), name) for i, (name, value) in enumerate(features.items())}
    source = train.select(
        key_text(keys).alias("key"), binary_value(label).alias("y"), *[value.alias(name) for name, value in named.items()]
    ).withColumn("cuts", held_cuts)
    bins = F.array(*[bin_of(F.col(name), i) for i, name in enumerate(named)])
    rows = staged(source.select("y", bins.alias("bins"), weights.alias("weights")))

    levels: list[DataFrame] = []
    for level in range(growth.depth):
        looked = F.broadcast(_looked_at(train.sparkSession, growth, level, count))
        here = (F.col("tree") == F.col("of_tree")) & (F.col("path") == F.col("of_path"))
        placed = _at_level(rows, levels).join(looked, here).select("tree", "path", "y", "w", "bins", F.explode("looked").alias("feature"))
        binned = placed.groupBy("tree", "path", "feature", F.get("bins", F.col("feature")).alias("bin"))
        sums = binned.agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("p"))
        levels.append(staged(_best_cuts(sums)))
    return _numbered(levels, edges)


def _constant(spark: SparkSession, value: list, kind: str) -> Column:
    """A nested list as a scalar, which a query reads once."""
    return spark.range(1).select(F.from_json(F.lit(json.dumps(value)), kind)).scalar()


def _looked_at(spark: SparkSession, growth: Growth, level: int, count: int) -> DataFrame:
    """(of_tree, of_path, looked): the features that each node of a level looks at, those of the least hashes."""
    first = 1 << level
    every = spark.range(growth.trees * first * count).select(
        F.floor(F.col("id") / (first * count)).cast("int").alias("of_tree"),
        (F.floor(F.col("id") / count) % first + first).cast("int").alias("of_path"),
        (F.col("id") % count).cast("int").alias("feature"),
    )
    salt = F.concat_ws(" ", F.lit(f"look {growth.seed}"), "of_tree", "of_path", F.lit(": "))
    drawn = F.struct(unit_hash(F.col("feature"), salt).alias("hash"), "feature")
    all_of = every.groupBy("of_tree", "of_path").agg(F.array_sort(F.collect_list(drawn)).alias("all"))
    return all_of.select("of_tree", "of_path", F.slice("all.feature", 1, growth.subset or count).alias("looked"))


def _at_level(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, path, y, w, bins) of the rows that each tree draws and that no leaf above holds.

    The cuts above are at most one per node, so each is sent to every task whatever the size of the table.
    """
    placed = rows.select("y", "bins", F.posexplode("weights").alias("tree", "w")).where("w > 0")
    placed = placed.withColumn("path", F.lit(1))
    for level in levels:
        cuts = level.where("feature IS NOT NULL").select(
            F.col("tree").alias("of_tree"), F.col("path").alias("of_path"), "feature", "cut"
        )
        joined = placed.join(
            F.broadcast(cuts), (F.col("tree") == F.col("of_tree")) & (F.col("path") == F.col("of_path"))
        )
        right = (F.get("bins", F.col("feature")) > F.col("cut")).cast("int")
        placed = joined.select("y", "bins", "tree", "w", (2 * F.col("path") + right).alias("path"))
    return placed


def _numbered(levels: list[DataFrame], edges: DataFrame) -> DataFrame:
    """The nodes of all levels, and the leaves that the last cuts leave, with thresholds and numbers from 0."""
    inner = levels[0]
    for level in levels[1:]:
        inner = inner.unionByName(level)
    last = levels[-1].where("feature IS NOT NULL")
    child = F.array(
        F.struct((2 * F.col("path")).alias("path"), F.col("left_n").alias("n"), F.col("left_p").alias("positives")),
        F.struct(
            (2 * F.col("path") + 1).alias("path"),
            (F.col("n") - F.col("left_n")).alias("n"),
            (F.col("positives") - F.col("left_p")).alias("positives"),
        ),
    )
    nodes = inner.select("tree", "path", "n", "positives", "feature", "cut", "gain").unionByName(
        last.select("tree", F.inline(child)), allowMissingColumns=True
    )
    place = Window.partitionBy("feature").orderBy("threshold")
    cuts = edges.select(
        F.col("feature").alias("of_feature"), (F.row_number().over(place) - 1).alias("of_cut"), "threshold"
    )
    nodes = nodes.join(cuts, (F.col("feature") == F.col("of_feature")) & (F.col("cut") == F.col("of_cut")), "left")
    numbered = nodes.withColumn("node", F.row_number().over(Window.partitionBy("tree").orderBy("path")) - 1)
    numbered = staged(numbered.select("tree", "path", "node", "feature", "threshold", "n", "positives", "gain"))
    for side, shift in (("left", 0), ("right", 1)):
        other = numbered.select(
            F.col("tree").alias("of_tree"), F.col("path").alias("of_path"), F.col("node").alias(side)
        )
        same = (F.col("tree") == F.col("of_tree")) & (2 * F.col("path") + shift == F.col("of_path"))
        numbered = numbered.join(other, same, "left").drop("of_tree", "of_path")
    categories = F.lit(None).cast("array<double>")
    return staged(numbered.withColumn("categories", categories).select("path", *NODE_COLUMNS))


def model_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """The node rows of a fitted tree or forest classifier, from its own saved form in the shared folder."""
    path = staging_path(spark)
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "nodeData" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    continuous = F.col("split.numCategories") < 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)
    return saved.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        total.alias("n"),
        F.get("impurityStats", F.lit(1)).alias("positives"),
        F.when(inner, F.col("gain")).alias("gain"),
    )


def score_nodes(df: DataFrame, values: Column, nodes: DataFrame, depth: int, score: str = "score") -> DataFrame:
    """Add the share of class 1 in the leaf that a row reaches, averaged over the trees; null without trees.

    ``values`` is an array with the features in the order in which the model numbers them, ``depth`` what no tree
    exceeds. The table of nodes is one scalar of the plan; the rows are neither joined nor moved.
    """
    sizes = nodes.agg((F.max("tree") + 1).alias("trees"), (F.max("node") + 1).alias("slots"))
    size = collect_small(sizes, 1)[0]
    if size.trees is None:
        return df.withColumn(score, F.lit(None).cast("double"))
    fields = F.struct("left", "right", "feature", "threshold", "categories", (F.col("positives") / F.col("n")).alias("p"))
    slotted = nodes.withColumn("slot", F.col("node").cast("long"))
    held = df.withColumns({"_trees": _per_tree(slotted, size.trees, size.slots, fields), "_values": values})

    def leaf_share(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            value = F.get("_values", node["feature"])
            left = F.when(node["categories"].isNotNull(), F.array_contains(node["categories"], value)).otherwise(
                value <= node["threshold"]
            )
            return F.when(node["feature"].isNull(), at).when(left, node["left"]).otherwise(node["right"])

        steps = F.sequence(F.lit(1), F.lit(max(1, depth)))
        return F.aggregate(steps, F.lit(0), step, lambda at: F.get(tree, at)["p"])

    shares = F.transform("_trees", leaf_share)
    mean = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b) / size.trees
    return held.withColumn(score, mean).drop("_trees", "_values")


def node_importances(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (idx, feature, importance) from the gains of the cuts, most important first; ``names`` has (idx, feature).

    A tree's gains, weighted by the rows of their nodes, are shares of its total; a forest's importances are the mean.
    A model without cuts has importances of 0.
    """
    cuts = nodes.where("feature IS NOT NULL").select("tree", F.col("feature").alias("slot"), (F.col("gain") * F.col("n")).alias("g"))
    per_tree = cuts.groupBy("tree", "slot").agg(F.sum("g").alias("g"))
    shares = per_tree.withColumn("share", F.col("g") / F.sum("g").over(Window.partitionBy("tree")))
    summed = shares.groupBy("slot").agg(F.sum("share").alias("share"))
    total = summed.agg(F.sum("share")).scalar()
    found = names.join(summed, F.col("idx") == F.col("slot"), "left")
    importance = F.coalesce(F.col("share") / total, F.lit(0.0)).alias("importance")
    return found.select("idx", F.col("feature"), importance).orderBy(F.desc("importance"), "idx")
