"""``spark-submit`` entry: analyse one subscriber table."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ebbtide.operators.metrics import metrics_report
from ebbtide.plans.attrition_run import run_attrition


def main() -> None:
    parser = argparse.ArgumentParser(prog="ebbtide", description=run_attrition.__doc__.splitlines()[0])
    parser.add_argument("source", help="CSV or parquet table on any Hadoop-compatible path")
    parser.add_argument("target", help="folder for the results")
    parser.add_argument("--format", choices=("csv", "parquet"), help="default: by the source's suffix")
    parser.add_argument("--infer", action="store_true", help="infer CSV types instead of using the known schema")
    parser.add_argument("--split", choices=("hash", "random"), default="hash")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("attrition analytics").getOrCreate()
    metrics_report(run_attrition(spark, args.source, args.target, args.format, args.infer, args.split)).show()


if __name__ == "__main__":
    main()
