import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.operators.features import (
    FEATURES,
    RAW_FEATURES,
    FeatureColumns,
    category_counts,
    category_index,
    feature_names,
    fit_features,
    index_labels,
    vector_width,
)
from ebbtide.plans.subscribers import FEATURE_COLUMNS
from fixtures import subscribers

COLUMNS = FeatureColumns(key="k", label="y", numeric=("v", "missing_number"), categorical=("a", "b", "missing_text"))


def table(spark):
    rows = [(1, 0, 1.0, "x", "p q"), (2, 1, 3.0, "x", "p_q"), (3, 1, 5.0, "w", "r"), (4, 0, 9.0, "z", "r")]
    return spark.createDataFrame(rows, "k int, y int, v double, a string, b string")


def test_missing_columns_are_skipped_and_names_derived(spark):
    columns = COLUMNS.present_in(table(spark))
    assert columns.numeric == ("v",) and columns.categorical == ("a", "b")
    assert columns.assembled == ["v", "aVec", "bVec"] and columns.index_columns == ["aIndex", "bIndex"]
    assert columns.used == ["k", "y", "v", "a", "b"]


def labels(vocabulary, column_no=0):
    rows = vocabulary.where(F.col("column_no") == column_no).orderBy("idx").collect()
    assert [row.idx for row in rows] == list(range(len(rows)))
    return [row.label for row in rows]


def names_of(spark, encoding):
    rows = feature_names(spark, encoding).orderBy("idx").collect()
    assert [row.idx for row in rows] == list(range(len(rows)))
    return [row.feature for row in rows]


def test_labels_equal_the_built_in_indexer(spark):
    df = subscribers(spark, 500)
    names = list(FEATURE_COLUMNS.categorical)
    ours = category_index(df, names)
    built_in = StringIndexer(inputCols=names, outputCols=FEATURE_COLUMNS.index_columns, handleInvalid="keep").fit(df)
    assert [labels(ours, i) for i in range(len(names))] == [list(labels) for labels in built_in.labelsArray]


def test_ties_go_in_text_order_and_nulls_are_no_label(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "a string")
    columns = FeatureColumns(label="y", numeric=(), categorical=("a",))
    vocabulary = category_index(df, ["a"])
    assert labels(vocabulary) == ["c", "a", "b"]
    indexed = index_labels(df, columns, vocabulary).collect()
    assert {row.a: row.aIndex for row in indexed} == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_names_match_slots_with_spaces_and_underscores(spark):
    columns = COLUMNS.present_in(table(spark))
    model = fit_features(table(spark), columns)
    encoded = model.transform(table(spark))
    names = names_of(spark, model)
    assert names == ["v", "a=x", "a=w", "a=z", "b=r", "b=p q", "b=p_q"]
    assert len(names) == vector_width(encoded) == vector_width(encoded, RAW_FEATURES)
    rows = encoded.select("a", "b", vector_to_array(RAW_FEATURES).alias("values")).collect()
    for row in rows:
        assert {names[i] for i, value in enumerate(row["values"]) if value and i} == {f"a={row.a}", f"b={row.b}"}


def test_subscriber_slots(spark):
    """10 numeric columns and 39 labels make 49 slots, each of which has a name."""
    df = subscribers(spark)
    model = fit_features(df, FEATURE_COLUMNS)
    names = names_of(spark, model)
    assert len(names) == 49 == len(set(names)) == vector_width(model.transform(df))
    assert names[:10] == list(FEATURE_COLUMNS.numeric)
    last_labels = {"Contract=Two year", "InternetService=DSL", "OnlineSecurity=Yes", "PaymentMethod=Electronic check"}
    assert last_labels <= set(names)


def test_unseen_category_is_all_zero(spark):
    columns = COLUMNS.present_in(table(spark))
    model = fit_features(table(spark), columns)
    new = spark.createDataFrame([(9, 0, 2.0, "never", "r")], "k int, y int, v double, a string, b string")
    values = model.transform(new).select(vector_to_array(RAW_FEATURES)).first()[0]
    assert values == [2.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0]


def test_scaling_divides_by_the_sample_deviation(spark):
    columns = FeatureColumns(label="y", numeric=("v",), categorical=())
    df = table(spark)
    scaled = fit_features(df, columns).transform(df).select("v", vector_to_array(FEATURES)[0].alias("s"))
    deviation = df.agg(F.stddev_samp("v")).first()[0]
    assert all(row.s == pytest.approx(row.v / deviation) for row in scaled.collect())


def test_fit_sees_the_training_rows_only(spark):
    columns = COLUMNS.present_in(table(spark))
    train = table(spark).where("k <= 2")
    model = fit_features(train, columns)
    assert names_of(spark, model) == ["v", "a=x", "b=p q", "b=p_q"]


def test_wide_vocabularies_train_index_and_name(spark):
    """More labels than any driver-side limit, most of them tied, over several range partitions."""
    text = F.concat(F.lit("v"), (F.col("id") % 20_001).cast("string"))
    df = spark.range(30_000).select((F.col("id") % 2).cast("int").alias("y"), text.alias("a"), F.lit("x").alias("b"))
    columns = FeatureColumns(label="y", numeric=(), categorical=("a", "b"))
    model = fit_features(df, columns)
    built_in = StringIndexer(inputCol="a", outputCol="i", handleInvalid="keep").fit(df)
    assert labels(model.vocabulary) == list(built_in.labels)
    names = names_of(spark, model)
    assert len(names) == 20_002 == vector_width(model.transform(df))
    assert names[:20_001] == [f"a={label}" for label in built_in.labels] and names[-1] == "b=x"


def test_all_categories_are_counted_in_one_scan(spark, plan_text):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    counts = category_counts(lines, ["l_returnflag", "l_linestatus", "l_linenumber"])
    assert plan_text(counts).count("Location: InMemoryFileIndex") == 1
    assert counts.agg(F.sum("rows")).first()[0] == 3 * lines.count()


def test_looked_up_and_joined_labels_agree(spark, monkeypatch):
    """A small vocabulary is one scalar of the plan, a large one is joined: same indices, same vectors, same names."""
    rows = [(i, i % 2, float(i), f"l{i % 7}", None if i % 11 == 0 else f"m{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, y int, v double, a string, b string")
    unseen = df.withColumn("a", F.when(F.col("k") > 50, F.lit("new")).otherwise(F.col("a")))
    columns = COLUMNS.present_in(df)
    encoded = []
    for limit in (500, 0):
        monkeypatch.setattr("ebbtide.operators.features.LOOKUP_LABELS", limit)
        encoding = fit_features(df, columns)
        out = encoding.transform(unseen).select("k", "aIndex", "bIndex", vector_to_array(FEATURES).alias("x"))
        encoded.append((sorted(map(tuple, out.collect())), names_of(spark, encoding)))
    assert encoded[0] == encoded[1]


def test_looking_labels_up_moves_no_rows(spark, plan_text):
    df = subscribers(spark, 50)
    text = plan_text(index_labels(df, FEATURE_COLUMNS, category_index(df, FEATURE_COLUMNS.categorical)))
    rows_plan = text.split("Subqueries")[0]
    assert "Exchange" not in rows_plan and "Join" not in rows_plan
