import pytest
from pyspark.sql import functions as F

from ebbtide.operators.segments import class_distribution, rate_by_bin, rate_by_category, rate_by_ordinal
from ebbtide.plans.segment_report import BIN, ORDINAL, Segment, class_report, segment_report
from ebbtide.plans.subscribers import CHARGE_EDGES, SEGMENTS, TENURE_EDGES
from fixtures import subscribers

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def test_class_distribution(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    assert [tuple(row) for row in class_distribution(df, "y").collect()] == [
        (0, 3, 75.0, "75.0%"), (1, 1, 25.0, "25.0%"),
    ]


def test_empty_bins_are_listed(spark):
    df = spark.createDataFrame([(50.0, 1), (41.0, 0), (0.0, 1), (None, 1)], "x double, y int")
    rows = rate_by_bin(df, "x", "y", CHARGE_EDGES).collect()
    assert [row.bin for row in rows] == [0, 1, 2, 3, 4]
    assert [row.rows for row in rows] == [0, 2, 0, 0, 0]
    assert [row.rate_pct for row in rows] == [None, 50.0, None, None, None]
    assert [row.rate_text for row in rows] == [None, "50.0%", None, None, None]


def test_categories_come_highest_first(spark):
    rows = [("a", 0), ("a", 1), ("b", 1), ("c", 1), ("d", 0), (None, 1)]
    df = spark.createDataFrame(rows, "k string, y int")
    assert [tuple(row) for row in rate_by_category(df, "k", "y").collect()] == [
        ("b", 1, 1, 100.0), ("c", 1, 1, 100.0), ("a", 2, 1, 50.0), ("d", 1, 0, 0.0),
    ]


def test_ordinals_come_in_order(spark):
    df = spark.createDataFrame([(3, 1), (1, 0), (2, 1), (2, 0)], "k int, y int")
    rows = rate_by_ordinal(df, "k", "y").collect()
    assert [(row.k, row.rate_pct) for row in rows] == [(1, 0.0), (2, 50.0), (3, 100.0)]


def test_report_equals_the_single_operators(spark):
    df = subscribers(spark).cache()
    report = segment_report(df, "Churn", SEGMENTS).collect()
    by_name = {}
    for row in report:
        by_name.setdefault(row.segment, []).append((row.value, row.rows, row.positives, row.rate_pct))
    bins = ["bin_label", "rows", "positives", "rate_pct"]

    def plain(frame, *columns):
        return [tuple(row) for row in frame.select(*columns).collect()]

    assert by_name["monthly charges"] == plain(rate_by_bin(df, "MonthlyCharges", "Churn", CHARGE_EDGES), *bins)
    assert by_name["tenure"] == plain(rate_by_bin(df, "tenure", "Churn", TENURE_EDGES), *bins)
    assert by_name["contract"] == plain(rate_by_category(df, "Contract", "Churn"), "Contract", *bins[1:])
    for name, column in (("satisfaction", "SatisfactionScore"), ("unresolved complaints", "Unresolved_Complaints")):
        single = rate_by_ordinal(df, column, "Churn").withColumn(column, F.col(column).cast("string"))
        assert by_name[name] == plain(single, column, *bins[1:])
    df.unpersist()


def test_bin_filter_reaches_the_scan(spark, plan_text):
    df = spark.read.parquet(LINEITEM).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    text = plan_text(rate_by_bin(df, "l_quantity", "y", TENURE_EDGES))
    assert "GreaterThan(l_quantity,0.0)" in text
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text


def test_report_reads_the_table_once(spark, plan_text):
    df = spark.read.parquet(LINEITEM).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    cuts = [
        Segment("q", "l_quantity", BIN, TENURE_EDGES),
        Segment("s", "l_linestatus"),
        Segment("n", "l_linenumber", ORDINAL),
    ]
    text = plan_text(segment_report(df, "y", cuts))
    assert text.count("Location: InMemoryFileIndex") == 1
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_returnflag:string,l_linestatus:string>" in text


def test_hot_category_is_combined_before_the_shuffle(spark, plan_text):
    text = plan_text(rate_by_category(spark.range(10).select(F.lit("hot").alias("k"), F.lit(1).alias("y")), "k", "y"))
    assert "partial_count" in text and "partial_sum" in text
    assert text.count("Exchange") >= 1


def test_duplicate_edges_are_refused(spark):
    df = spark.createDataFrame([(1.0, 1)], "x double, y int")
    with pytest.raises(ValueError):
        rate_by_bin(df, "x", "y", (0, 5, 5))


def test_classes_of_the_table_and_of_segments(spark, plan_text):
    rows = [(1, "x", 5.0), (1, "x", 15.0), (0, "x", 5.0), (None, "y", 5.0), (2, "y", None), (2, None, -1.0)]
    df = spark.createDataFrame(rows, "label int, kind string, v double")
    found = class_report(df, "label", [Segment("kind", "kind"), Segment("v", "v", BIN, (0, 10))])
    got = {(r.segment, r.value, r["class"]): (r.rows, round(r.share_pct, 3)) for r in found.collect()}
    assert got == {
        ("all", None, 1): (2, 33.333), ("all", None, 0): (1, 16.667), ("all", None, None): (1, 16.667), ("all", None, 2): (2, 33.333),
        ("kind", "x", 1): (2, 66.667), ("kind", "x", 0): (1, 33.333), ("kind", "y", None): (1, 50.0), ("kind", "y", 2): (1, 50.0),
        ("v", "(0,10]", 1): (1, 33.333), ("v", "(0,10]", 0): (1, 33.333), ("v", "(0,10]", None): (1, 33.333), ("v", ">10", 1): (1, 100.0),
    }
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan_text(class_report(orders, "o_orderstatus", [Segment("p", "o_orderpriority"), Segment("c", "o_custkey")]))
    assert text.count("Location: InMemoryFileIndex") == 1
