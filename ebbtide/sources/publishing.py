"""Results that become readable all at once: a folder per run, and a list of the runs that are complete.

A run writes below a folder of its own and is put on the list when everything is written, by one small file. Readers
take the last run on the list. So a run that ends half-way leaves the one before it as it was, and nothing that anybody
reads is ever deleted or changed.
"""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS, LIST = "runs", "published"
_LIST_SCHEMA = "place long, run string"


def _listed(spark: SparkSession, target: str) -> DataFrame:
    try:
        return spark.read.schema(_LIST_SCHEMA).json(f"{target}/{LIST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LIST_SCHEMA)


class Publication:
    """One run below ``target``; ``folder`` is where it writes, ``publish`` makes it the one that is read."""

    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark, self.target = spark, target.rstrip("/")
        self.run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid4().hex[:8]}"
        self.folder = f"{self.target}/{RUNS}/{self.run}"

    def publish(self) -> None:
        """Put the run on the list, after those that are there; of two at once the later name counts as the last."""
        last = _listed(self.spark, self.target).agg(F.coalesce(F.max("place"), F.lit(0)).alias("place"))
        entry = last.select((F.col("place") + 1).alias("place"), F.lit(self.run).alias("run"))
        entry.coalesce(1).write.mode("append").json(f"{self.target}/{LIST}")


def published(spark: SparkSession, target: str) -> str:
    """The folder of the last complete run below ``target``."""
    target = target.rstrip("/")
    last = _listed(spark, target).agg(F.max(F.struct("place", "run")).alias("last")).select("last.run")
    run = last.head().run
    if run is None:
        raise FileNotFoundError(f"no complete run below {target}: run the training plan first")
    return f"{target}/{RUNS}/{run}"
