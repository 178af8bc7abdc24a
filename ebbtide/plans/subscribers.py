"""What is specific to the subscriber table: features, segments, scorecard, tariff, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators.checks import DependencyRule, DomainRule, RangeRule
from ebbtide.operators.features import FeatureColumns
from ebbtide.operators.scorecard import Scorecard, Tariff
from ebbtide.plans.segment_report import BIN, ORDINAL, Segment

KEY, LABEL = "CustomerID", "Churn"
PREVIEW_COLUMNS = (KEY, "Contract")

# Feature columns in vector order.
FEATURE_COLUMNS = FeatureColumns(
    key=KEY,
    label=LABEL,
    numeric=(
        "tenure",
        "MonthlyCharges",
        "TotalCharges",
        "SeniorCitizen",
        "SatisfactionScore",
        "SupportCallsLast6Months",
        "Data_Usage_Drop_Rate",
        "Call_Drop_Rate",
        "Slow_Speed_Days",
        "Unresolved_Complaints",
    ),
    categorical=(
        "Contract",
        "InternetService",
        "OnlineSecurity",
        "TechSupport",
        "PaperlessBilling",
        "PaymentMethod",
        "Partner",
        "Dependents",
        "PhoneService",
        "MultipleLines",
        "OnlineBackup",
        "DeviceProtection",
        "StreamingTV",
        "StreamingMovies",
    ),
)

# Bin edges of the two binned segments.
CHARGE_EDGES = (0, 40, 60, 80, 100)
TENURE_EDGES = (0, 6, 12, 24, 48)

SEGMENTS = (
    Segment("monthly charges", "MonthlyCharges", BIN, CHARGE_EDGES),
    Segment("tenure", "tenure", BIN, TENURE_EDGES),
    Segment("contract", "Contract"),
    Segment("satisfaction", "SatisfactionScore", ORDINAL),
    Segment("unresolved complaints", "Unresolved_Complaints", ORDINAL),
)

# Category weights, flag increments, linear weights with centres, offset.
RISK_SCORECARD = Scorecard(
    offset=-1.1,
    categories={
        "Contract": {"Month-to-month": 1.10, "One year": -0.10, "Two year": -1.15},
        "InternetService": {"Fiber optic": 0.45, "DSL": -0.05, "No": -0.40},
        "PaymentMethod": {
            "Electronic check": 0.40,
            "Mailed check": 0.0,
            "Bank transfer": -0.15,
            "Credit card": -0.20,
        },
    },
    flags={
        ("SeniorCitizen", 1): 0.20,
        ("Partner", "Yes"): -0.15,
        ("Dependents", "Yes"): -0.20,
        ("PaperlessBilling", "Yes"): 0.10,
    },
    linear={
        "SupportCallsLast6Months": (0.45, 0),
        "SatisfactionScore": (-0.70, 3),
        "Data_Usage_Drop_Rate": (1.6, 0),
        "Call_Drop_Rate": (2.2, 0),
        "Slow_Speed_Days": (0.07, 0),
        "Unresolved_Complaints": (0.65, 0),
        "tenure": (-0.05, 0),
        "MonthlyCharges": (0.008, 60),
    },
)

# Base charge and add-ons per month.
SUBSCRIPTION_TARIFF = Tariff(
    base=20.0,
    add_ons={
        ("InternetService", "DSL"): 35.0,
        ("InternetService", "Fiber optic"): 55.0,
        ("PhoneService", "Yes"): 15.0,
        ("MultipleLines", "Yes"): 10.0,
    },
    months="tenure",
)

# Columns that depend on the internet service.
INTERNET_ADD_ONS = (
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)


def dependency_rules() -> list[DependencyRule]:
    """No phone, no multiple lines; no internet, none of its add-ons."""
    # The category texts.
    no_phone = DependencyRule(
        "MultipleLines follows PhoneService",
        F.col("PhoneService") == "No",
        F.col("MultipleLines") == "No phone service",
        ("PhoneService", "MultipleLines"),
    )
    no_internet = [
        DependencyRule(
            f"{add_on} follows InternetService",
            F.col("InternetService") == "No",
            F.col(add_on) == "No internet service",
            ("InternetService", add_on),
        )
        for add_on in INTERNET_ADD_ONS
    ]
    return [no_phone, *no_internet]


def domain_rules() -> list[DomainRule | RangeRule]:
    """Allowed categories and value ranges, some of which depend on other columns."""
    unhappy = F.col("SatisfactionScore") <= 2
    many_calls = F.col("SupportCallsLast6Months") >= 3
    fiber = F.col("InternetService") == "Fiber optic"
    mood, service = ("SatisfactionScore", "SupportCallsLast6Months"), ("InternetService",)
    yes_no = ("Yes", "No")
    # Allowed categories, ranges and the conditions they depend on.
    return [
        DomainRule("Contract", ("Month-to-month", "One year", "Two year")),
        DomainRule("InternetService", ("DSL", "Fiber optic", "No")),
        DomainRule("PaymentMethod", ("Electronic check", "Mailed check", "Bank transfer", "Credit card")),
        *[DomainRule(name, yes_no) for name in ("Partner", "Dependents", "PhoneService", "PaperlessBilling")],
        DomainRule("MultipleLines", (*yes_no, "No phone service")),
        *[DomainRule(name, (*yes_no, "No internet service")) for name in INTERNET_ADD_ONS],
        DomainRule("SeniorCitizen", (0, 1)),
        DomainRule("Churn", (0, 1)),
        RangeRule("tenure", 1, 72),
        RangeRule("MonthlyCharges", 15, 115),
        RangeRule("SatisfactionScore", 1, 5),
        RangeRule("SupportCallsLast6Months", 0, 5),
        RangeRule("Data_Usage_Drop_Rate", 0.40, 0.85, unhappy | many_calls, "unhappy or calling", mood),
        RangeRule("Data_Usage_Drop_Rate", 0.0, 0.39, ~(unhappy | many_calls), "content", mood),
        RangeRule("Call_Drop_Rate", 0.0, 0.16, fiber, "fiber", service),
        RangeRule("Call_Drop_Rate", 0.0, 0.04, ~fiber, "no fiber", service),
        RangeRule("Slow_Speed_Days", 6, 24, unhappy, "unhappy", mood[:1]),
        RangeRule("Slow_Speed_Days", 0, 5, ~unhappy, "not unhappy", mood[:1]),
        RangeRule("Unresolved_Complaints", 0, 3, many_calls, "calling", mood[1:]),
        RangeRule("Unresolved_Complaints", 0, 0, ~many_calls, "not calling", mood[1:]),
    ]
