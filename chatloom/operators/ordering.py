"""Running totals and row numbers over rows in order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.sources.scratch import stored


def running_total(df: DataFrame, order: list[str], amount: Column, name: str, keys: list[str] | None = None, lazy: bool = False) -> DataFrame:
    """df with the column name: the sum of amount over the rows of equal keys that come before each row by order.

    Rows are dealt by ranges of (keys, order), so a hot key has many ranges; sums are taken within a range and
    the sums of the ranges before are added, of which there is one row a range and key. Rows that are equal in
    keys and order are in one range, in any order among themselves. Null keys are one group. Dealing by ranges reads df
    twice; with lazy it is written once before.
    """
    keys = keys or []
    df = stored(df, "unordered") if lazy else df
    placed = stored(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "slices")
    first = Window.unboundedPreceding
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(first, -1)
    sums = placed.groupBy("_slice", *keys).agg(F.sum(amount).alias("_sum"))
    offsets = sums.select(
        F.col("_slice").alias("_at"), *(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(first, -1)
    own = placed.withColumn("_own", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    same = F.col("_slice") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    return own.join(offsets, same).select(*df.columns, (F.col("_before") + F.col("_own")).alias(name))


def numbered(df: DataFrame, order: list[str], name: str, keys: list[str] | None = None, lazy: bool = False) -> DataFrame:
    """df with the column name: the row's number among the rows of equal keys by order, from 0."""
    return running_total(df, order, F.lit(1), name, keys, lazy)
