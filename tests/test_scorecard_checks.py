import math

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.checks import DependencyRule, DomainRule, RangeRule, check_report, domain_violations, rule_violations
from ebbtide.operators.scorecard import risk_scorecard, tariff_rating
from ebbtide.plans.subscribers import RISK_SCORECARD, SUBSCRIPTION_TARIFF, dependency_rules, domain_rules
from fixtures import subscribers


def test_risk_by_hand(spark):
    df = subscribers(spark, 300)
    contract = {"Month-to-month": 1.10, "One year": -0.10, "Two year": -1.15}
    internet = {"Fiber optic": 0.45, "DSL": -0.05, "No": -0.40}
    payment = {"Electronic check": 0.40, "Mailed check": 0.0, "Bank transfer": -0.15, "Credit card": -0.20}
    for row in risk_scorecard(df, RISK_SCORECARD).collect():
        logit = (
            contract[row.Contract] + internet[row.InternetService] + payment[row.PaymentMethod]
            + 0.20 * (row.SeniorCitizen == 1) - 0.15 * (row.Partner == "Yes") - 0.20 * (row.Dependents == "Yes")
            + 0.10 * (row.PaperlessBilling == "Yes") + 0.45 * row.SupportCallsLast6Months
            - 0.70 * (row.SatisfactionScore - 3) + 1.6 * row.Data_Usage_Drop_Rate + 2.2 * row.Call_Drop_Rate
            + 0.07 * row.Slow_Speed_Days + 0.65 * row.Unresolved_Complaints - 0.05 * row.tenure
            + 0.008 * (row.MonthlyCharges - 60) - 1.1
        )
        assert row.logit == pytest.approx(logit, abs=1e-12)
        assert row.risk == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-12)


def test_unlisted_category_has_no_risk(spark):
    df = subscribers(spark, 3).withColumn("Contract", F.lit("Weekly"))
    assert {row.risk for row in risk_scorecard(df, RISK_SCORECARD).collect()} == {None}


def test_tariff_by_hand(spark):
    rows = [("DSL", "Yes", "Yes", 3), ("Fiber optic", "No", "No phone service", 2), ("No", "Yes", "No", 1)]
    df = spark.createDataFrame(rows, "InternetService string, PhoneService string, MultipleLines string, tenure int")
    rated = tariff_rating(df, SUBSCRIPTION_TARIFF).collect()
    assert [(row.expected_monthly, row.expected_total) for row in rated] == [(80.0, 240.0), (75.0, 150.0), (35.0, 35.0)]


def test_generated_subscribers_keep_every_rule(spark):
    df = subscribers(spark)
    rules = rule_violations(df, dependency_rules()).collect()
    assert len(rules) == 7 and {row.rows for row in rules} == {2000} and {row.violations for row in rules} == {0}
    checks = domain_violations(df, domain_rules()).collect()
    assert {row.check: row.violations for row in checks if row.violations} == {}
    assert all(row.rows > 0 and row.nulls == 0 for row in checks)


def test_violations_are_counted_both_ways(spark):
    rows = [("No", "Yes"), ("No", "No phone service"), ("Yes", "No phone service"), ("Yes", "No"), (None, "No")]
    df = spark.createDataFrame(rows, "PhoneService string, MultipleLines string")
    row = rule_violations(df, dependency_rules()[:1]).first()
    assert (row.rows, row.missing, row.unexpected, row.violations) == (5, 1, 1, 2)


def test_ranges_and_nulls(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (9, "b"), (None, "b")], "x int, s string")
    rules = [RangeRule("x", 1, 2), RangeRule("x", 1, 2, F.col("s") == "b", "b")]
    assert [tuple(row) for row in domain_violations(df, rules).collect()] == [
        ("x in [1, 2]", 5, 1, 2), ("x in [1, 2] if b", 3, 1, 1),
    ]


def test_checks_take_one_scan(spark, plan_text):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [DependencyRule(str(i), F.col("l_linenumber") == i, F.col("l_quantity") > 3) for i in range(5)]
    text = plan_text(rule_violations(lines, rules))
    assert text.count("Location: InMemoryFileIndex") == 1
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double>" in text


def test_scores_and_tariffs_add_no_shuffle(spark, plan_text):
    df = subscribers(spark, 10)
    assert "Exchange" not in plan_text(tariff_rating(risk_scorecard(df, RISK_SCORECARD), SUBSCRIPTION_TARIFF))


def test_check_report_counts_as_the_single_checks_do_and_shows_the_same_keys_on_any_layout(spark):
    rows = [(i, "a" if i % 3 else None, float(i % 10), i % 2 == 0, i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, d string, v double, c boolean, e boolean")
    rules = [DependencyRule("c and e", F.col("c"), F.col("e"))]
    domains = [DomainRule("d", ("b",)), RangeRule("v", 0, 8), RangeRule("v", 0, 20, F.col("c"), "c")]
    reports = [
        sorted(map(tuple, check_report(df.repartition(n), [*rules, *domains], F.col("k"), evidence=4).collect()))
        for n in (1, 6)
    ]
    assert reports[0] == reports[1]
    found = {row[0]: row for row in reports[0]}
    assert {r.check: (r.rows, r.nulls, r.violations) for r in domain_violations(df, domains).collect()} == {
        name: row[1:4] for name, row in found.items() if name != "c and e"
    }
    assert found["c and e"][3] == rule_violations(df, rules).first().violations == 100
    for name, bad in (("c and e", lambda k: k % 4 == 2), ("v in [0, 8]", lambda k: k % 10 == 9)):
        keys = [int(key) for key in found[name][4].split(", ")]
        assert len(keys) == 4 and all(map(bad, keys))
    assert found["v in [0, 20] if c"][4] == ""
    assert check_report(df, [], F.col("k")).collect() == []
    assert [r.rows for r in check_report(df.where("k < 0"), rules, F.col("k")).collect()] == [0]
