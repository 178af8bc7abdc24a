"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from operator import methodcaller

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Rows and bytes of an Arrow batch: what a task decodes at once is a few MB, whatever the length of the texts.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole. Arrow batches of the session are made small, for tables of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_batch(df: DataFrame, schema: pa.Schema, ddl: str, rows: Callable[..., Iterable[tuple]]) -> DataFrame:
    """Apply ``rows(*columns)`` to the columns of every Arrow batch; it yields output tuples in the order of ``schema``.

    Columns are iterators, so that the texts of a batch are not all decoded at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(rows(*(map(methodcaller("as_py"), column) for column in batch.columns)))
            columns = zip(*out) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema
            )

    return df.mapInArrow(run, ddl)
