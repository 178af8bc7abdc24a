"""Positions of rows in an order, and what follows from them: joins by position and splits of exact size.

No window runs over a whole table: rows are range-partitioned in the order, numbered inside each partition, and shifted
by what the partitions before hold. Only one row per partition meets in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import hash_number, required
from ebbtide.operators.split import TEST, TRAIN
from ebbtide.sources import collect_small, staged

POSITION = "position"
_PREFIX_BITS = 16


def numbered(df: DataFrame, *order: str | Column, name: str = POSITION) -> DataFrame:
    """Add each row's position in the order, from 0; nulls first. Rows equal in the order get any of their positions.

    Rows are spread by the order, so rows equal in all of its columns meet in one task: name enough columns to tell the
    rows of a frequent key apart. The placed rows are written to the shared folder, which fixes the partitions and their
    sizes however often a task is repeated.
    """
    if not order:
        raise ValueError("at least one column to order by")
    by = [F.asc_nulls_first(column) if isinstance(column, str) else column for column in order]
    held = f"_{name}_part"
    placed = staged(df.repartitionByRange(*by).withColumn(held, F.spark_partition_id()))
    sizes = placed.groupBy(held).agg(F.count("*").alias("_size"))
    before = Window.orderBy(held).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    shifts = sizes.select(held, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy(held).orderBy(*by))
    local = placed.withColumn("_place", inside)
    return local.join(F.broadcast(shifts), held).withColumn(name, F.col("_shift") + F.col("_place") - 1).drop(
        held, "_shift", "_place"
    )


def zip_rows(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]) -> DataFrame:
    """Rows of two ordered tables side by side: the first with the first, and so on to the end of the shorter one.

    Both tables are numbered and joined on the position, which is the first column of the result; columns of the right
    table that the left has too get the suffix ``_right``.
    """
    mine = numbered(left, *left_order)
    renamed = {name: f"{name}_right" for name in right.columns if name in left.columns}
    other = numbered(right, *right_order, name="_other").withColumnsRenamed(renamed)
    joined = mine.join(other, F.col(POSITION) == F.col("_other")).drop("_other")
    return joined.select(POSITION, *[name for name in joined.columns if name != POSITION])


def exact_split(df: DataFrame, *keys: str, train_share: float = 0.8, salt: str = "") -> DataFrame:
    """Add ``part``: exactly floor(train_share * rows) rows are train, those of the least key hashes.

    The hash at which the parts meet is an order statistic, found from counts per hash prefix and then per hash; no row
    moves for it. Only rows with just that hash are put in order, by their keys and then by a hash of all columns. So
    the split depends on the rows alone, not on their layout. Reads the table three times. A null key fails the query.
    """
    if not keys or not 0.0 < train_share < 1.0:
        raise ValueError("at least one key, and a train_share between 0 and 1")
    texts = [required(F.col(name), name).cast("string") for name in keys]
    hashed = df.withColumn("_hash", hash_number(F.concat_ws("|", *texts), salt))
    total = hashed.count()
    wanted = int(total * train_share)
    if not total:
        return df.withColumn("part", F.lit(TRAIN))

    def found_at(rows: DataFrame, key: Column, already: int) -> tuple[int, int]:
        """The key that the first row of the test part has, and the rows before that key."""
        counts = rows.groupBy(key.alias("key")).agg(F.count("*").alias("rows"))
        so_far = F.sum("rows").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
        placed = counts.withColumn("before", F.coalesce(so_far, F.lit(0)) + already)
        here = placed.where((F.col("before") <= wanted) & (F.col("before") + F.col("rows") > wanted))
        row = collect_small(here, 1)[0]
        return row.key, row.before

    prefix = F.shiftright("_hash", 32 - _PREFIX_BITS)
    first, before = found_at(hashed, prefix, 0)
    border, before = found_at(hashed.where(prefix == first), F.col("_hash"), before)
    parted = hashed.where(F.col("_hash") != border).withColumn(
        "part", F.when(F.col("_hash") < border, F.lit(TRAIN)).otherwise(F.lit(TEST))
    )
    ties = hashed.where(F.col("_hash") == border).withColumn("_row", F.xxhash64(*df.columns))
    ties = numbered(ties, *keys, "_row", name="_position").withColumn(
        "part", F.when(F.col("_position") < wanted - before, F.lit(TRAIN)).otherwise(F.lit(TEST))
    )
    columns = [*df.columns, "part"]
    return parted.select(*columns).unionByName(ties.select(*columns))
