"""The subscriber table: one row per customer, 26 columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the input table, in file order.
SUBSCRIBER_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.DoubleType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("SatisfactionScore", T.IntegerType()),
        T.StructField("SupportCallsLast6Months", T.IntegerType()),
        T.StructField("Data_Usage_Drop_Rate", T.DoubleType()),
        T.StructField("Call_Drop_Rate", T.DoubleType()),
        T.StructField("Slow_Speed_Days", T.IntegerType()),
        T.StructField("Unresolved_Complaints", T.IntegerType()),
        T.StructField("Churn", T.IntegerType()),
    ]
)
