import math

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.clean import drop_nulls, existing_columns, preview
from ebbtide.operators.split import hash_split, random_split, split_counts, split_frames

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def test_drop_nulls_equals_dropna(spark):
    rows = [(1, 1.0, "a"), (2, None, "b"), (3, math.nan, "c"), (4, 2.0, None), (5, 3.0, "NA"), (None, 4.0, "d")]
    df = spark.createDataFrame(rows, "k int, x double, s string")
    assert drop_nulls(df).collect() == df.dropna().collect()
    assert [row.k for row in drop_nulls(df).collect()] == [1, 5]
    assert [row.k for row in drop_nulls(df, ["s"]).collect()] == [1, 2, 3, 5, None]
    assert drop_nulls(df, []).count() == 6


def test_null_tests_reach_the_scan(spark, plan_text):
    text = plan_text(drop_nulls(spark.read.parquet(ORDERS), ["o_totalprice", "o_orderstatus"]).select("o_orderkey"))
    assert "IsNotNull(o_totalprice)" in text and "IsNotNull(o_orderstatus)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_existing_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert existing_columns(df, ["c", "zz", "a"]) == ["c", "a"]


def test_preview_is_a_top_k_plan(spark, plan_text):
    df = preview(spark.range(1000).orderBy(F.desc("id")), "id")
    assert [row.id for row in df.collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrderedAndProject" in plan_text(df)


def test_random_split_is_disjoint_and_complete(spark):
    df = spark.range(0, 5000, 1, 3)
    train, test = random_split(df)
    assert train.count() + test.count() == 5000
    assert train.join(test, "id").count() == 0
    assert 0.75 < train.count() / 5000 < 0.85


def test_hash_split_ignores_the_layout(spark):
    df = spark.range(0, 5000, 1, 2)
    one = hash_split(df, "id")
    other = hash_split(df.repartition(13).orderBy(F.desc("id")), "id")
    assert one.exceptAll(other).count() == 0
    train, test = split_frames(one)
    counts = {row.part: row.rows for row in split_counts(one).collect()}
    assert counts == {"train": train.count(), "test": test.count()}
    assert train.unionByName(test).distinct().count() == 5000
    assert 0.78 < counts["train"] / 5000 < 0.82
    assert hash_split(df, "id", salt="x").exceptAll(one).count() > 0
    assert "part" not in train.columns


def test_hash_split_adds_no_shuffle(spark, plan_text):
    text = plan_text(split_frames(hash_split(spark.read.parquet(ORDERS), "o_orderkey"))[0])
    assert "Exchange" not in text and "Sort" not in text


def test_hash_split_checks_its_share(spark):
    with pytest.raises(ValueError):
        hash_split(spark.range(1), "id", train_share=1.0)
    with pytest.raises(ValueError):
        hash_split(spark.range(1))


def test_more_key_columns_split_a_frequent_key(spark):
    df = spark.range(3000).select(F.lit(7).alias("hot"), "id")
    assert split_counts(hash_split(df, "hot")).count() == 1
    counts = {row.part: row.rows for row in split_counts(hash_split(df, "hot", "id")).collect()}
    assert 0.77 < counts["train"] / 3000 < 0.83
