"""Positions, joins by position and splits of exact size."""

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.numbering import exact_split, numbered, zip_rows
from ebbtide.operators.split import TEST, TRAIN

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_positions_follow_the_order_on_any_layout(orders, parts):
    rows = numbered(orders.repartition(parts), F.desc("o_totalprice"), "o_orderkey").collect()
    want = sorted(orders.collect(), key=lambda r: (-r.o_totalprice, r.o_orderkey))
    assert [r.position for r in sorted(rows, key=lambda r: r.position)] == list(range(len(want)))
    assert [r.o_orderkey for r in sorted(rows, key=lambda r: r.position)] == [r.o_orderkey for r in want]


def test_positions_of_ties_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([(v,) for v in (3, None, 1, 1, None, 2, 1)], "v int").repartition(3)
    found = sorted((r.position, r.v) for r in numbered(rows, "v").collect())
    assert found == [(0, None), (1, None), (2, 1), (3, 1), (4, 1), (5, 2), (6, 3)]
    assert numbered(rows.where("v > 9"), "v").collect() == []
    with pytest.raises(ValueError):
        numbered(rows)


def test_no_window_runs_over_the_rows(orders, plan_text):
    text = plan_text(numbered(orders, "o_orderkey"))
    assert "rangepartitioning" not in text  # already written in that order
    assert text.count("SinglePartition") == 1  # the sizes of the partitions


@pytest.mark.parametrize(("left", "right"), [(5, 3), (3, 5), (4, 4), (0, 3), (3, 0)])
def test_rows_side_by_side_end_with_the_shorter_table(spark, left, right):
    one = spark.range(left).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).repartition(3)
    two = spark.range(right).select((-F.col("id")).alias("k"), F.lit("x").alias("w")).repartition(2)
    found = zip_rows(one, ["k"], two, ["k"])
    assert found.columns == ["position", "k", "v", "k_right", "w"]
    want = [(i, i, 10 * i, i - right + 1, "x") for i in range(min(left, right))]
    assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("share", [0.8, 0.5, 0.013])
def test_splits_have_their_exact_size_on_any_layout(orders, share):
    parts = []
    for layout in (1, 5):
        rows = exact_split(orders.repartition(layout), "o_orderkey", train_share=share).collect()
        parts.append({r.o_orderkey for r in rows if r.part == TRAIN})
        assert len(rows) == orders.count() and len(parts[-1]) == int(orders.count() * share)
    assert parts[0] == parts[1]


def test_a_frequent_key_does_not_move_the_size(spark):
    rows = spark.range(1_000).select(F.when(F.col("id") < 600, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    for layout in (1, 6):
        found = exact_split(rows.repartition(layout), "k", train_share=0.45).collect()
        assert sum(r.part == TRAIN for r in found) == 450 and len(found) == 1_000
    again = exact_split(rows.repartition(3), "k", train_share=0.45).collect()
    assert sorted(again) == sorted(found)


def test_equal_rows_small_and_wrong_tables(spark):
    same = spark.range(10).select(F.lit(1).alias("k"))
    assert sorted(r.part for r in exact_split(same, "k", train_share=0.3).collect()) == [TEST] * 7 + [TRAIN] * 3
    assert [r.part for r in exact_split(same.limit(1), "k").collect()] == [TEST]
    assert exact_split(same.where("k > 1"), "k").collect() == []
    with pytest.raises(ValueError):
        exact_split(same, "k", train_share=1.0)
    with pytest.raises(Exception, match="null in required column k"):
        exact_split(spark.createDataFrame([(1,), (None,)], "k int"), "k").collect()
