"""A small subscriber table whose values depend on the row id only."""

from pyspark.sql import functions as F

from ebbtide.functions import unit_hash
from ebbtide.operators.scorecard import risk_scorecard, tariff_rating
from ebbtide.plans.subscribers import INTERNET_ADD_ONS, RISK_SCORECARD, SUBSCRIPTION_TARIFF
from ebbtide.sources import SUBSCRIBER_SCHEMA


def draw(name):
    return unit_hash(F.col("id"), name)


def pick(name, *shares):
    """Value by cumulative share: ``shares`` are (value, upper bound) pairs."""
    first, *middle, last = shares
    chosen = F.when(draw(name) < first[1], F.lit(first[0]))
    for value, share in middle:
        chosen = chosen.when(draw(name) < share, F.lit(value))
    return chosen.otherwise(F.lit(last[0]))


def between(name, low, high):
    return F.lit(low) + draw(name) * F.lit(high - low)


def whole(name, low, high):
    return F.floor(between(name, low, high + 1)).cast("int")


def yes_no(name, share):
    return pick(name, ("Yes", share), ("No", 1))


def subscribers(spark, rows=2000, partitions=4):
    # Categories, shares, ranges and conditions of the input table's columns.
    base = spark.range(0, rows, 1, partitions).select(
        "id",
        F.concat(F.lit("CUST"), F.col("id") + 1001).alias("CustomerID"),
        whole("tenure", 1, 72).alias("tenure"),
        pick("Contract", ("Month-to-month", 1 / 3), ("One year", 2 / 3), ("Two year", 1)).alias("Contract"),
        pick("Internet", ("DSL", 1 / 3), ("Fiber optic", 2 / 3), ("No", 1)).alias("InternetService"),
        pick(
            "Payment", ("Electronic check", 0.25), ("Mailed check", 0.5), ("Bank transfer", 0.75), ("Credit card", 1)
        ).alias("PaymentMethod"),
        (draw("Senior") < 0.16).cast("int").alias("SeniorCitizen"),
        yes_no("Partner", 0.48).alias("Partner"),
        yes_no("Dependents", 0.30).alias("Dependents"),
        yes_no("Phone", 0.90).alias("PhoneService"),
        yes_no("Paperless", 0.59).alias("PaperlessBilling"),
        pick("Satisfaction", (1, 0.12), (2, 0.30), (3, 0.65), (4, 0.90), (5, 1)).alias("SatisfactionScore"),
        pick("Calls", (0, 0.25), (1, 0.55), (2, 0.75), (3, 0.88), (4, 0.96), (5, 1)).alias("SupportCallsLast6Months"),
    )
    unhappy, calling = F.col("SatisfactionScore") <= 2, F.col("SupportCallsLast6Months") >= 3
    fiber = F.col("InternetService") == "Fiber optic"
    offline, no_phone = F.col("InternetService") == "No", F.col("PhoneService") == "No"
    derived = base.withColumns(
        {
            "MultipleLines": F.when(no_phone, "No phone service").otherwise(yes_no("Lines", 0.42)),
            **{name: F.when(offline, "No internet service").otherwise(yes_no(name, 0.34)) for name in INTERNET_ADD_ONS},
            "Data_Usage_Drop_Rate": F.round(
                F.when(unhappy | calling, between("Drop", 0.40, 0.85)).otherwise(between("Drop", 0.0, 0.39)), 2
            ),
            "Call_Drop_Rate": F.round(
                F.when(fiber & (draw("Fiber") > 0.6), between("CallDrop", 0.05, 0.16)).otherwise(
                    between("CallDrop", 0.0, 0.04)
                ),
                3,
            ),
            "Slow_Speed_Days": F.when(unhappy, whole("Slow", 6, 24)).otherwise(whole("Slow", 0, 5)),
            "Unresolved_Complaints": F.when(calling & (draw("Open") > 0.4), whole("Complaints", 1, 3)).otherwise(0),
        }
    )
    charged = tariff_rating(derived, SUBSCRIPTION_TARIFF).withColumns(
        {"MonthlyCharges": F.round(F.col("expected_monthly") + between("Charge", -5.0, 15.0), 2)}
    )
    charged = charged.withColumn(
        "TotalCharges", F.round(F.col("MonthlyCharges") * F.col("tenure") * between("Total", 0.85, 1.05), 2)
    )
    labelled = risk_scorecard(charged, RISK_SCORECARD).withColumn("Churn", (draw("Churn") < F.col("risk")).cast("int"))
    return labelled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUBSCRIBER_SCHEMA.fields])
