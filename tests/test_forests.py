"""Trees and forests as tables: layout, plain growth, and agreement with Spark's own models."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators.features import FEATURES, FeatureColumns, feature_names, fit_features
from ebbtide.operators.forests import (
    NODE_COLUMNS,
    Growth,
    grow_forest,
    model_nodes,
    node_importances,
    root_subset,
    score_nodes,
    single_tree,
)
from ebbtide.operators.models import feature_importance

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("l_quantity", "l_discount", "l_tax")
KEYS = ("l_orderkey", "l_linenumber")


@pytest.fixture(scope="module")
def lines(spark):
    unit_price = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet").withColumn("y", (unit_price > 1500).cast("int")).cache()


@pytest.fixture(scope="module")
def values(spark):
    return {name: F.col(name) for name in NAMES}


def rows_of(nodes):
    return sorted((tuple(row) for row in nodes.collect()), key=str)


def test_a_forest_does_not_depend_on_the_layout(lines, values):
    growth = Growth(subset=root_subset(len(NAMES)))
    forests = [rows_of(grow_forest(lines.repartition(n), values, "y", KEYS, growth)) for n in (1, 4, 7)]
    assert forests[0] == forests[1] == forests[2]
    assert len({row[1] for row in forests[0]}) == 20 and max(row[0] for row in forests[0]) >= 32
    other = grow_forest(lines, values, "y", KEYS, Growth(subset=2, seed=7))
    assert rows_of(other) != forests[0]


def plain_tree(rows, thresholds, depth, path=1):
    """(path, feature, threshold, n, positives) of a tree grown row by row; ``rows`` are (values, y)."""
    n, p = len(rows), sum(y for _, y in rows)

    def weighted(part):
        hits = sum(y for _, y in part)
        return 2.0 * hits * (len(part) - hits) / len(part) if part else 0.0

    best = None
    for feature, cuts in enumerate(thresholds):
        for cut in cuts:
            left = [r for r in rows if r[0][feature] <= cut]
            right = [r for r in rows if r[0][feature] > cut]
            if left and right:
                gain = (weighted(rows) - (weighted(left) + weighted(right))) / n
                if gain > 1e-12 and (best is None or gain > best[0]):
                    best = (gain, feature, cut, left, right)
    if best is None or not depth:
        return [(path, None, None, n, p)]
    _, feature, cut, left, right = best
    return [
        (path, feature, cut, n, p),
        *plain_tree(left, thresholds, depth - 1, 2 * path),
        *plain_tree(right, thresholds, depth - 1, 2 * path + 1),
    ]


def test_a_tree_equals_one_grown_row_by_row(lines):
    few = lines.where("l_orderkey % 7 = 0")
    coarse = {"q": F.floor(F.col("l_quantity") / 5), "d": F.col("l_discount"), "line": F.col("l_linenumber")}
    nodes = grow_forest(few, coarse, "y", KEYS, single_tree(depth=3))
    rows = [(tuple(r)[:3], r.y) for r in few.select(*[v.cast("double") for v in coarse.values()], "y").collect()]
    kinds = [sorted({row[0][i] for row in rows}) for i in range(3)]
    thresholds = [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in kinds]
    got = [tuple(r) for r in nodes.select("path", "feature", "threshold", "n", "positives").orderBy("path").collect()]
    # a cut through values that no row of the node has parts the rows as the next lower one does
    want = sorted(plain_tree(rows, thresholds, 3))
    assert [(p, f, n, k) for p, f, _, n, k in got] == [(p, f, n, k) for p, f, _, n, k in want]


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_node_tables_of_fitted_models_score_and_rank_as_the_models_do(spark, lines, kind):
    columns = FeatureColumns(label="y", numeric=("l_quantity", "l_extendedprice", "l_tax"), categorical=("l_returnflag",))
    encoding = fit_features(lines, columns)
    encoded = encoding.transform(lines)
    estimator = DecisionTreeClassifier if kind == "tree" else RandomForestClassifier
    model = estimator(labelCol="y", featuresCol=FEATURES, maxDepth=5, seed=3).fit(encoded)
    nodes = model_nodes(spark, model)
    assert nodes.columns == list(NODE_COLUMNS)
    both = score_nodes(model.transform(encoded), vector_to_array(F.col(FEATURES)), nodes, depth=5)
    worst = both.select(F.max(F.abs(F.col("score") - F.get(vector_to_array("probability"), F.lit(1))))).first()[0]
    assert worst < 1e-12
    names = feature_names(spark, encoding)
    for ranked in (node_importances(nodes, names), feature_importance(model, names)):
        found = {row.idx: row.importance for row in ranked.collect()}
        assert found == pytest.approx(dict(enumerate(model.featureImportances.toArray().tolist())), abs=1e-12)


def test_scores_of_a_grown_forest_are_means_of_its_leaves(lines, values):
    nodes = grow_forest(lines, values, "y", KEYS, Growth(trees=3, depth=3))
    table = {(r.tree, r.node): r for r in nodes.collect()}
    scored = score_nodes(lines, F.array(*NAMES), nodes, depth=3).limit(200).collect()
    for row in scored:
        seen, shares = [row[name] for name in NAMES], []
        for tree in range(3):
            node = table[tree, 0]
            while node.feature is not None:
                node = table[tree, node.left if seen[node.feature] <= node.threshold else node.right]
            shares.append(node.positives / node.n)
        assert row.score == pytest.approx(sum(shares) / 3, abs=1e-12)


def test_odd_tables(spark, lines, values):
    none = lines.where("false")
    empty = grow_forest(none, values, "y", KEYS, Growth(trees=2, depth=2))
    assert empty.count() == 0
    assert score_nodes(lines, F.array(*NAMES), empty, 2).where("score IS NOT NULL").count() == 0
    pure = grow_forest(lines.withColumn("y", F.lit(1)), values, "y", KEYS, Growth(trees=2, depth=2, bagging=False))
    assert [(r.path, r.feature, r.n == r.positives) for r in pure.collect()] == [(1, None, True)] * 2
    names = spark.createDataFrame([(0, "a"), (1, "b")], "idx int, feature string")
    assert [r.importance for r in node_importances(pure, names).collect()] == [0.0, 0.0]
    gaps = lines.withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))
    with pytest.raises(Exception, match="null in required column l_tax"):
        grow_forest(gaps, values, "y", KEYS, Growth(trees=1, depth=1))
    with pytest.raises(ValueError, match="depth"):
        Growth(depth=40)


def test_levels_move_sums_only(spark, lines, values, plan_text):
    text = plan_text(grow_forest(lines, values, "y", KEYS, Growth(trees=2, depth=2)))
    assert "ExistingRDD" not in text and "Python" not in text
