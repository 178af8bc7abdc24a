"""Results that are written once to the cluster's shared folder and read back."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where the session names none, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="ebbtide-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark)}/ebbtide-{uuid4().hex}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rows as parquet, by default to a new place in the shared folder, and read them back.

    Later plans start from the files: the planner knows their size, and lost executors cost no work done before them.
    """
    path = path or staging_path(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
