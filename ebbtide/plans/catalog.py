"""Every operator as a query over the given tables.

Label, numeric and category columns of the tables stand in for subscriber
columns; the operators take column names, so the code that runs is the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.checks import (
    DependencyRule,
    DomainRule,
    RangeRule,
    check_report,
    domain_violations,
    rule_violations,
)
from ebbtide.operators.clean import drop_nulls, preview
from ebbtide.operators.features import (
    FEATURES,
    RAW_FEATURES,
    FeatureColumns,
    category_counts,
    category_index,
    fit_encoding,
    fit_features,
    index_labels,
    one_hot_encoder,
)
from ebbtide.operators.forests import Growth, grow_forest, node_importances, root_subset, score_nodes, single_tree
from ebbtide.operators.metrics import (
    best_model,
    binary_metrics,
    confusion_counts,
    confusion_matrix,
    metrics_by_model,
    metrics_report,
)
from ebbtide.operators.logistic import fit_logistic, fitted_moments
from ebbtide.operators.models import default_models, prediction_preview
from ebbtide.operators.numbering import exact_split, zip_rows
from ebbtide.operators.roc import roc_auc, roc_curve
from ebbtide.operators.scorecard import Scorecard, Tariff, risk_scorecard, tariff_rating
from ebbtide.operators.segments import class_distribution, rate_by_bin, rate_by_category, rate_by_ordinal
from ebbtide.operators.split import TEST, TRAIN, hash_split, random_split, split_counts, split_frames
from ebbtide.plans.segment_report import BIN, ORDINAL, Segment, class_report, segment_report
from ebbtide.plans.subscribers import TENURE_EDGES
from ebbtide.plans.training import Comparison, compare_models
from ebbtide.sources import (
    build_report,
    input_counts,
    read_report,
    read_table,
    report_metrics,
    rescued_cells,
    staged,
    staging_path,
    write_csv,
    write_report,
)

PRICE_EDGES = (0, 20_000, 40_000, 60_000, 80_000)
SIGNAL = FeatureColumns(
    key="l_orderkey",
    label="y",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
)
MATRIX = FeatureColumns(
    label="l_linenumber", numeric=("l_quantity", "l_extendedprice"), categorical=("l_returnflag", "l_linestatus")
)
PRIORITY = FeatureColumns(label="o_orderkey", numeric=(), categorical=("o_orderpriority",))
THRESHOLDS = {"over 150k": 150_000, "over 250k": 250_000, "over 350k": 350_000}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the 0/1 label "returned"."""
    return table(spark, sf_dir, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))


def finished_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the 0/1 label "finished" and a coarse score with many ties."""
    return table(spark, sf_dir, "orders").withColumns(
        {
            "finished": (F.col("o_orderstatus") == "F").cast("int"),
            "score": F.floor(F.col("o_totalprice") / 500).cast("double"),
        }
    )


def threshold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three threshold rules on the price as tagged predictions; one scan for all of them."""
    outcomes = [
        F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(name).alias("model"),
            (F.col("o_totalprice") > limit).cast("int").alias("prediction"),
            (-F.abs(F.col("o_totalprice") - limit)).alias("score"),
        )
        for ordinal, (name, limit) in enumerate(THRESHOLDS.items())
    ]
    orders = finished_orders(spark, sf_dir)
    return orders.select("o_orderkey", F.col("finished").alias("y"), F.inline(F.array(*outcomes)))


def signal_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test line items with a label that the features can predict."""
    unit_price = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").withColumn("y", (unit_price > 2200).cast("int"))
    parted = hash_split(lines.select("l_linenumber", *SIGNAL.used), SIGNAL.key, "l_linenumber")
    return split_frames(parted)


def trained(spark: SparkSession, sf_dir: str, *names: str) -> Comparison:
    models = default_models(SIGNAL.label)
    chosen = {name: models[name] for name in names} if names else models
    return compare_models(*signal_parts(spark, sf_dir), SIGNAL, chosen)


def trained_metrics(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    with trained(spark, sf_dir, *names) as comparison:
        metrics = comparison.metrics()
    measures = ("accuracy", "f1", "precision", "recall", "balanced_accuracy", "roc_auc")
    return metrics.select(
        "ordinal", "model", "tn", "fp", "fn", "tp", *[F.round(name, 6).alias(name) for name in measures]
    )


def slots(df: DataFrame, keys: list[str], vector: str, prefix: str, width: int, places: int | None = None) -> DataFrame:
    """Keys and vector slots as columns; the vector is unpacked once per row."""
    values = [F.get("values", F.lit(i)) for i in range(width)]
    shown = values if places is None else [F.round(value, places) for value in values]
    return df.select(*keys, vector_to_array(F.col(vector)).alias("values")).select(
        *keys, *[value.alias(f"{prefix}{i}") for i, value in enumerate(shown)]
    )


# --- cleaning, preview, splits -------------------------------------------------


def q_drop_nulls(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    gappy = orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") < 50_000, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
    )
    return drop_nulls(gappy)


def q_drop_nulls_subset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    gappy = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return drop_nulls(gappy, ["o_orderstatus", "o_totalprice"]).select("o_orderkey", "o_orderstatus")


def q_preview_topk(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")


def q_random_split(spark, sf_dir):
    """What must hold of any random split: each row in one part, the share within five deviations of 0.8."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = random_split(orders)
    parts = train.withColumn("part", F.lit(TRAIN)).unionByName(test.withColumn("part", F.lit(TEST)))
    per_key = parts.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("part") == TRAIN).alias("t"))
    both = orders.join(per_key, "o_orderkey", "left")
    rows, trained_rows = F.count("*"), F.sum("t")
    near = F.abs(trained_rows / rows - 0.8) < 5 * F.sqrt(F.lit(0.16) / rows)
    return both.agg(
        rows.alias("rows"),
        F.count_if(F.col("n") > 1).alias("in_both"),
        F.count_if(F.col("n").isNull()).alias("in_neither"),
        near.alias("share_near"),
    )


def q_null_report(spark, sf_dir):
    """Nulls per column and rows without any, over gappy orders."""
    orders = table(spark, sf_dir, "orders")
    gappy = orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return input_counts(gappy, None)


def q_csv_text_round_trip(spark, sf_dir):
    """Orders as CSV lines and back with a schema by position."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    lines = orders.select(F.to_csv(F.struct(*orders.columns)).alias("line"))
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    return lines.select(F.from_csv("line", schema).alias("row")).select("row.*")


ORDER_CELLS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


def dirty_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as CSV files in the shared folder, some cells of them unreadable as numbers, some empty."""
    key, path = F.col("o_orderkey"), staging_path(spark)
    dirty = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 50 == 0, F.concat(F.lit("c-"), "o_custkey"))
        .when(key % 50 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("o_custkey"),
        "o_orderstatus",
        F.when(key % 70 == 0, F.lit("n/a")).when(key % 70 != 1, F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    write_csv(dirty, path)
    return path


def q_csv_table(spark, sf_dir):
    """The files, read by column names: what cannot be read is null, whole numbers may have a point."""
    return read_table(spark, dirty_orders(spark, sf_dir), ORDER_CELLS, fmt="csv")


def q_csv_rescued(spark, sf_dir):
    """The unreadable cells of the files, by column and text."""
    rescued = rescued_cells(spark, dirty_orders(spark, sf_dir), ORDER_CELLS)
    return rescued.groupBy("column", "raw").agg(F.count("*").alias("cells"))


def q_hash_split(spark, sf_dir):
    return hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def q_hash_split_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return hash_split(lines, "l_orderkey", "l_linenumber", train_share=0.5, salt="fold 1: ")


def q_split_counts(spark, sf_dir):
    return split_counts(q_hash_split(spark, sf_dir))


def q_exact_split(spark, sf_dir):
    """Exactly four fifths of the orders, by the least key hashes."""
    return exact_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def q_exact_split_counts(spark, sf_dir):
    """Line items: many rows share a key, and the parts still have exactly their sizes."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    return split_counts(exact_split(lines, "l_suppkey", train_share=0.7, salt="fold 2: "))


def q_zip_rows(spark, sf_dir):
    """Orders from the oldest key on, beside customers from the highest balance on; customers end first."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select((-F.col("c_acctbal")).alias("debt"), "c_custkey")
    return zip_rows(orders, ["o_orderkey"], customers, ["debt", "c_custkey"])


# --- segments ------------------------------------------------------------------


def q_class_distribution(spark, sf_dir):
    return class_distribution(returned_lines(spark, sf_dir), "returned")


def q_rate_by_charge_bin(spark, sf_dir):
    return rate_by_bin(returned_lines(spark, sf_dir), "l_extendedprice", "returned", PRICE_EDGES)


def q_rate_by_tenure_bin(spark, sf_dir):
    return rate_by_bin(returned_lines(spark, sf_dir), "l_quantity", "returned", TENURE_EDGES)


def q_rate_by_category(spark, sf_dir):
    return rate_by_category(finished_orders(spark, sf_dir), "o_orderpriority", "finished")


def q_rate_by_ordinal(spark, sf_dir):
    return rate_by_ordinal(returned_lines(spark, sf_dir), "l_linenumber", "returned")


def q_rate_by_complaints(spark, sf_dir):
    lines = returned_lines(spark, sf_dir)
    counted = lines.withColumn("complaints", F.round(F.col("l_discount") * 100).cast("int"))
    return rate_by_ordinal(counted, "complaints", "returned")


def q_segment_report(spark, sf_dir):
    segments = [
        Segment("price", "l_extendedprice", BIN, PRICE_EDGES),
        Segment("quantity", "l_quantity", BIN, (0, 6, 12, 24, 48, 60)),
        Segment("status", "l_linestatus"),
        Segment("line", "l_linenumber", ORDINAL),
    ]
    return segment_report(returned_lines(spark, sf_dir), "returned", segments)


def q_class_report(spark, sf_dir):
    """All three return flags as classes, for the whole table and in three segments."""
    segments = [
        Segment("price", "l_extendedprice", BIN, PRICE_EDGES),
        Segment("status", "l_linestatus"),
        Segment("line", "l_linenumber", ORDINAL),
    ]
    return class_report(table(spark, sf_dir, "lineitem"), "l_returnflag", segments)


# --- metrics -------------------------------------------------------------------


def q_confusion_counts(spark, sf_dir):
    return confusion_counts(table(spark, sf_dir, "labels"), "quality", "toxic")


def q_binary_metrics(spark, sf_dir):
    return binary_metrics(q_confusion_counts(spark, sf_dir))


def q_metrics_by_model(spark, sf_dir):
    return metrics_by_model(threshold_predictions(spark, sf_dir))


def q_confusion_matrix(spark, sf_dir):
    return confusion_matrix(
        confusion_counts(threshold_predictions(spark, sf_dir), "y", "prediction", by=["model"])
    )


def metrics_with_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the three threshold rules, and the areas of their scores."""
    tagged = threshold_predictions(spark, sf_dir)
    areas = roc_auc(tagged, "y", "score", by=["model"]).select("model", "roc_auc")
    return metrics_by_model(tagged).join(areas, "model")


def q_metrics_report(spark, sf_dir):
    return metrics_report(metrics_with_area(spark, sf_dir))


def q_best_model(spark, sf_dir):
    return best_model(q_metrics_by_model(spark, sf_dir)).select("model", "balanced_accuracy")


def q_report_document(spark, sf_dir):
    return report_metrics(build_report(metrics_with_area(spark, sf_dir)))


def q_report_json(spark, sf_dir):
    """The report document as a JSON file in the shared folder, and back."""
    path = staging_path(spark)
    write_report(build_report(metrics_with_area(spark, sf_dir)), path)
    return report_metrics(read_report(spark, path))


def q_prediction_preview(spark, sf_dir):
    scored = threshold_predictions(spark, sf_dir)
    return prediction_preview(scored, list(THRESHOLDS), "o_orderkey", ["o_orderkey", "y", "prediction", "score"])


def q_roc_curve(spark, sf_dir):
    return roc_curve(finished_orders(spark, sf_dir), "finished", "score")


def q_roc_curve_corners(spark, sf_dir):
    return roc_curve(finished_orders(spark, sf_dir), "finished", "score", drop_intermediate=True)


def q_roc_auc(spark, sf_dir):
    return roc_auc(finished_orders(spark, sf_dir), "finished", "score")


def q_roc_auc_fine(spark, sf_dir):
    return roc_auc(finished_orders(spark, sf_dir), "finished", "o_totalprice")


def q_roc_auc_by_model(spark, sf_dir):
    return roc_auc(threshold_predictions(spark, sf_dir), "y", "score", by=["model"])


# --- features ------------------------------------------------------------------


def q_category_counts(spark, sf_dir):
    return category_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


def q_label_index(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    indexed = index_labels(orders, PRIORITY, category_index(orders, PRIORITY.categorical))
    return indexed.groupBy("o_orderpriority", F.col("o_orderpriorityIndex").cast("int").alias("label_index")).agg(
        F.count("*").alias("rows")
    )


def q_one_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    indexed = index_labels(orders, PRIORITY, category_index(orders, PRIORITY.categorical))
    encoded = one_hot_encoder(PRIORITY).fit(indexed).transform(indexed)
    return slots(encoded, ["o_orderkey"], "o_orderpriorityVec", "slot_", 5)


def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber")
    return table(spark, sf_dir, "lineitem").select(*keys, *MATRIX.numeric, *MATRIX.categorical)


def q_assemble(spark, sf_dir):
    lines = matrix_lines(spark, sf_dir)
    encoded = fit_encoding(lines, MATRIX).transform(lines)
    return slots(encoded, ["l_orderkey", "l_linenumber"], RAW_FEATURES, "x", 7)


def q_feature_matrix(spark, sf_dir):
    lines = matrix_lines(spark, sf_dir)
    encoded = fit_features(lines, MATRIX).transform(lines)
    return slots(encoded, ["l_orderkey", "l_linenumber"], FEATURES, "x", 7, places=6)


def q_standard_scale(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    columns = FeatureColumns(label="o_orderkey", numeric=("o_totalprice",), categorical=())
    scaled = fit_features(orders, columns).transform(orders)
    return slots(scaled, ["o_orderkey"], FEATURES, "scaled_", 1, places=6)


# --- models --------------------------------------------------------------------


def q_logistic_regression(spark, sf_dir):
    return trained_metrics(spark, sf_dir, "Logistic Regression")


def q_logistic_newton(spark, sf_dir):
    """Four numeric features: what the fit gives each of them must be what the labels give it."""
    train, _ = signal_parts(spark, sf_dir)
    features = {name: F.col(name) for name in SIGNAL.numeric}
    moments = fitted_moments(train, fit_logistic(train, features, SIGNAL.label), features, SIGNAL.label)
    total = F.col("observed")
    return moments.select(
        "idx", "feature", F.round(total, 2).alias("observed"), F.round(F.col("fitted") / total, 6).alias("fitted_share")
    )


def q_decision_tree(spark, sf_dir):
    return trained_metrics(spark, sf_dir, "Decision Tree")


def q_random_forest(spark, sf_dir):
    return trained_metrics(spark, sf_dir, "Random Forest")


def q_model_comparison(spark, sf_dir):
    return trained_metrics(spark, sf_dir)


def q_feature_importance(spark, sf_dir):
    with trained(spark, sf_dir, "Random Forest") as comparison:
        return comparison.importances("Random Forest").withColumn("importance", F.round("importance", 6))


# --- models whose result has a closed form ---------------------------------------

BANDED = FeatureColumns(key="l_orderkey", label="y", numeric=(), categorical=("band",))


def banded_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test line items with a quantity band as the only feature."""
    unit_price = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (unit_price > 2200).cast("int").alias("y"),
        F.floor((F.col("l_quantity") - 1) / 10).cast("string").alias("band"),
    )
    return split_frames(hash_split(lines, "l_orderkey", "l_linenumber"))


def banded(spark: SparkSession, sf_dir: str, *names: str) -> Comparison:
    """A saturated logistic regression, a stump, and a forest of stumps on all rows and features; all or the named ones."""
    shared = {"featuresCol": FEATURES, "labelCol": BANDED.label}
    stump = {"maxDepth": 1, "seed": 42}
    models = {
        "Logistic Regression": LogisticRegression(**shared, maxIter=200, tol=1e-10),
        "Decision Tree": DecisionTreeClassifier(**shared, **stump),
        "Random Forest": RandomForestClassifier(
            **shared, **stump, numTrees=3, bootstrap=False, featureSubsetStrategy="all"
        ),
    }
    chosen = {name: model for name, model in models.items() if not names or name in names}
    return compare_models(*banded_parts(spark, sf_dir), BANDED, chosen, keep=("band",))


def banded_scores(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """Test rows and score per band, to 4 places."""
    with banded(spark, sf_dir, model) as comparison:
        scores = comparison.scored.groupBy("band", F.round("score", 4).alias("score"))
        return staged(scores.agg(F.count("*").alias("rows")))


def q_logistic_regression_saturated(spark, sf_dir):
    return banded_scores(spark, sf_dir, "Logistic Regression")


def q_decision_tree_stump(spark, sf_dir):
    return banded_scores(spark, sf_dir, "Decision Tree")


def q_random_forest_stumps(spark, sf_dir):
    return banded_scores(spark, sf_dir, "Random Forest")


def q_feature_importance_stumps(spark, sf_dir):
    with banded(spark, sf_dir, "Random Forest") as comparison:
        return comparison.importances("Random Forest").select("idx", "feature", F.round("importance", 6).alias("importance"))


def q_model_comparison_closed(spark, sf_dir):
    with banded(spark, sf_dir) as comparison:
        metrics = comparison.metrics()
    return metrics.select("ordinal", "model", "tn", "fp", "fn", "tp", F.round("roc_auc", 6).alias("roc_auc"))


# --- trees and forests as tables -------------------------------------------------

LINE = ("l_orderkey", "l_linenumber")
FOREST = Growth(trees=20, depth=5, subset=root_subset(len(SIGNAL.numeric)))
TREE = single_tree(depth=4)


def line_forest(train: DataFrame, growth: Growth) -> DataFrame:
    return grow_forest(train, {name: F.col(name) for name in SIGNAL.numeric}, SIGNAL.label, LINE, growth)


def shown_nodes(nodes: DataFrame) -> DataFrame:
    gain, threshold = F.round("gain", 9).alias("gain"), F.round("threshold", 6).alias("threshold")
    return nodes.select("tree", "path", "feature", threshold, "n", "positives", gain)


def q_forest_nodes(spark, sf_dir):
    """A forest of the default size: 20 trees of depth 5."""
    return shown_nodes(line_forest(signal_parts(spark, sf_dir)[0], FOREST))


def q_forest_scores(spark, sf_dir):
    train, test = signal_parts(spark, sf_dir)
    scored = score_nodes(test, F.array(*SIGNAL.numeric), line_forest(train, FOREST), FOREST.depth)
    return scored.select(*LINE, F.round("score", 6).alias("score"))


def q_tree_nodes(spark, sf_dir):
    return shown_nodes(line_forest(signal_parts(spark, sf_dir)[0], TREE))


def q_tree_importances(spark, sf_dir):
    nodes = line_forest(signal_parts(spark, sf_dir)[0], TREE)
    names = F.posexplode(F.array(*map(F.lit, SIGNAL.numeric))).alias("idx", "feature")
    ranked = node_importances(nodes, spark.range(1).select(names))
    return ranked.select("idx", "feature", F.round("importance", 9).alias("importance"))


# --- scorecard, tariff, checks ---------------------------------------------------


def q_risk_scorecard(spark, sf_dir):
    card = Scorecard(
        offset=-0.5,
        categories={
            "c_mktsegment": {
                "AUTOMOBILE": 0.75,
                "BUILDING": -0.25,
                "FURNITURE": 0.5,
                "HOUSEHOLD": -0.75,
                "MACHINERY": 0.125,
            }
        },
        flags={("c_nationkey", 7): 0.375, ("c_nationkey", 11): -0.625},
        linear={"c_acctbal": (0.0003, 5000), "c_nationkey": (-0.02, 3)},
    )
    rated = risk_scorecard(table(spark, sf_dir, "customer"), card)
    return rated.select("c_custkey", F.round("logit", 6).alias("logit"), F.round("risk", 6).alias("risk"))


def q_tariff_rating(spark, sf_dir):
    tariff = Tariff(
        base=8.0,
        add_ons={
            ("l_returnflag", "A"): 3.0,
            ("l_returnflag", "R"): 7.0,
            ("l_linestatus", "O"): 2.5,
            ("l_linenumber", 1): 1.25,
        },
        months="l_quantity",
    )
    return tariff_rating(table(spark, sf_dir, "lineitem"), tariff).select(
        "l_orderkey", "l_linenumber", "expected_monthly", "expected_total"
    )


def q_rule_violations(spark, sf_dir):
    lines = rule_violations(
        table(spark, sf_dir, "lineitem"),
        [
            DependencyRule("returned follows final", F.col("l_linestatus") == "F", F.col("l_returnflag") == "R"),
            DependencyRule("big follows expensive", F.col("l_extendedprice") > 50_000, F.col("l_quantity") > 25),
        ],
    )
    docs = rule_violations(
        table(spark, sf_dir, "labels"),
        [DependencyRule("toxic follows poor", F.col("quality") == 0, F.col("toxic") == 1)],
    )
    return lines.unionByName(docs)


def q_domain_violations(spark, sf_dir):
    customers = domain_violations(
        table(spark, sf_dir, "customer"),
        [
            DomainRule("c_mktsegment", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")),
            RangeRule("c_acctbal", 0, 9000),
        ],
    )
    lines = domain_violations(
        table(spark, sf_dir, "lineitem"),
        [
            RangeRule("l_quantity", 1, 50),
            RangeRule("l_discount", 0.0, 0.05, F.col("l_returnflag") == "R", "returned"),
        ],
    )
    return customers.unionByName(lines)


def q_check_report(spark, sf_dir):
    """Dependencies and domains of line items in one pass, each with keys of rows that violate it."""
    rules = [
        DependencyRule("returned follows final", F.col("l_linestatus") == "F", F.col("l_returnflag") == "R"),
        DependencyRule("big follows expensive", F.col("l_extendedprice") > 50_000, F.col("l_quantity") > 25),
        RangeRule("l_quantity", 1, 50),
        RangeRule("l_discount", 0.0, 0.05, F.col("l_returnflag") == "R", "returned"),
        DomainRule("l_linestatus", ("O",)),
    ]
    return check_report(table(spark, sf_dir, "lineitem"), rules, F.concat_ws("|", "l_orderkey", "l_linenumber"))


Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")}
