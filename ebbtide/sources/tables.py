"""Table input and output on any Hadoop-compatible path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.subscribers import SUBSCRIBER_SCHEMA

SMALL_RESULT_ROWS = 10_000


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = SUBSCRIBER_SCHEMA,
    fmt: str | None = None,
    infer: bool = False,
) -> DataFrame:
    """Read parquet, or CSV with a header row.

    ``fmt`` defaults to the path's suffix. CSV columns get their types from
    ``schema`` by *name*: columns may come in any order, and columns the file
    lacks are simply absent. Columns unknown to the schema are strings. Cells
    that cannot be read as their type become null; ``input_counts`` counts them.
    ``infer=True`` lets Spark infer the types instead, at the cost of one more
    pass over the data.
    """
    cells = read_cells(spark, path, fmt, infer)
    return cells if infer or schema is None else typed(cells, schema)


def table_format(path: str, fmt: str | None = None) -> str:
    """The given format, or the one that the path's suffix names: parquet, and CSV for everything else."""
    return fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")


def read_cells(spark: SparkSession, path: str, fmt: str | None = None, infer: bool = False) -> DataFrame:
    """The table as it is stored: parquet with its types, CSV as text (or with inferred types)."""
    fmt = table_format(path, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported table format {fmt!r}: use 'csv' or 'parquet'")
    return spark.read.option("header", True).option("enforceSchema", False).option("inferSchema", infer).csv(path)


def typed_cell(name: str, kind: T.DataType) -> Column:
    """A text cell as its type; null if it cannot be read. Whole numbers may be written as ``12.0``."""
    text = F.trim(F.col(name))
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(kind)).alias(name)
    return F.col(name) if isinstance(kind, T.StringType) else text.try_cast(kind).alias(name)


def typed(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns with the types that ``schema`` gives to their names; other columns stay as they are."""
    kinds = {field.name: field.dataType for field in schema.fields}
    return cells.select(
        *[
            typed_cell(field.name, kinds[field.name])
            if field.name in kinds and isinstance(field.dataType, T.StringType)
            else F.col(field.name)
            for field in cells.schema.fields
        ]
    )


def input_counts(cells: DataFrame, schema: T.StructType | None = SUBSCRIBER_SCHEMA) -> DataFrame:
    """Rows (item, column, rows): rows read and kept, and per column null and unparsable cells. One aggregation.

    A row is kept if no cell is null, NaN or unparsable.
    """
    table = cells if schema is None else typed(cells, schema)
    names = table.columns
    numbers = {field.name for field in table.schema.fields if isinstance(field.dataType, (T.DoubleType, T.FloatType))}
    both = cells.select(
        *[F.col(name).isNull().alias(f"null_{i}") for i, name in enumerate(names)],
        *[
            (_column(table, cells, name).isNull() & F.col(name).isNotNull()).alias(f"bad_{i}")
            for i, name in enumerate(names)
        ],
        *[
            (F.isnan(_column(table, cells, name)) if name in numbers else F.lit(False)).alias(f"nan_{i}")
            for i, name in enumerate(names)
        ],
    )
    gaps = [F.coalesce(F.col(f"{kind}_{i}"), F.lit(False)) for i in range(len(names)) for kind in ("null", "bad", "nan")]
    totals = both.agg(
        F.count("*").alias("read"),
        F.count_if(~reduce(Column.__or__, gaps, F.lit(False))).alias("kept"),
        *[F.count_if(f"{kind}_{i}").alias(f"{kind}_{i}") for i in range(len(names)) for kind in ("null", "bad", "nan")],
    )
    lines = [("read", None, "read"), ("kept", None, "kept")]
    for i, name in enumerate(names):
        lines += [("null", name, f"null_{i}"), ("unparsable", name, f"bad_{i}"), ("nan", name, f"nan_{i}")]
    structs = [
        F.struct(F.lit(item).alias("item"), F.lit(column).cast("string").alias("column"), F.col(total).alias("rows"))
        for item, column, total in lines
    ]
    return totals.select(F.inline(F.array(*structs)))


def rescued_cells(spark: SparkSession, path: str, schema: T.StructType = SUBSCRIBER_SCHEMA) -> DataFrame:
    """Rows (file, line, column, raw): the text of every CSV cell that cannot be read as its type, and where it stands.

    ``line`` counts the lines of the file from 1, its header. Spark reads a file in blocks and gives rows no number;
    a row's place in its block and the sizes of the blocks before give its line. Only one row per block is shuffled, and
    of the others only those with an unreadable cell are kept. Empty cells are null, not unreadable. Cells must not hold
    line breaks.
    """
    cells = read_cells(spark, path, "csv")
    kinds = {field.name: field.dataType for field in schema.fields}
    checked = [name for name in cells.columns if name in kinds and not isinstance(kinds[name], T.StringType)]
    placed = cells.select(
        *[F.col(name).alias(f"cell_{i}") for i, name in enumerate(checked)],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    blocks = placed.groupBy("file", "block").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        F.col("file").alias("of_file"), F.col("block").alias("of_block"), "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"),
    )
    listed = []
    for i, name in enumerate(checked):
        cell = F.col(f"cell_{i}")
        bad = cell.isNotNull() & typed_cell(f"cell_{i}", kinds[name]).isNull()
        listed.append(F.when(bad, F.struct(F.lit(name).alias("column"), cell.alias("raw"))))
    if not listed:
        listed = [F.lit(None).cast("struct<column:string,raw:string>")]
    found = placed.select("file", "block", "place", F.explode(F.array_compact(F.array(*listed))).alias("bad"))
    same = (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block"))
    line = F.col("shift") + F.col("place") - F.col("first") + 2
    return found.join(shifts, same).select("file", line.alias("line"), "bad.column", "bad.raw")


def _column(table: DataFrame, cells: DataFrame, name: str) -> Column:
    """The typed column as an expression over the cells."""
    if table.schema[name].dataType == cells.schema[name].dataType:
        return F.col(name)
    return typed_cell(name, table.schema[name].dataType)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write CSV with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def collect_small(df: DataFrame, max_rows: int = SMALL_RESULT_ROWS, what: str = "result rows") -> list[Row]:
    """Rows of a result that must be small; fails instead of truncating."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}; too many for the driver")
    return rows


def small_table(df: DataFrame, max_rows: int = SMALL_RESULT_ROWS) -> DataFrame:
    """The same small result, detached from the frames it was computed from."""
    return df.sparkSession.createDataFrame(collect_small(df, max_rows), df.schema)
