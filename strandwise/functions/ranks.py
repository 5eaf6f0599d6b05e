"""Ranks of distinct values within a key that may hold any share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions.stages import cut


def parted(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df`` cut into ranges of (keys, order), numbered ``_part``, written so that the numbers stay."""
    return cut(df.repartitionByRange(*keys, order).withColumn("_part", F.spark_partition_id()))


def ranked(values: DataFrame, keys: list[str]) -> DataFrame:
    """``values`` has a row per (keys, x) and its number of rows ``n``.

    Adds ``d``, the number of distinct values before, ``c``, that of rows before, and the key's ``rows``.
    """
    parts = parted(values, keys, "x")
    over = Window.partitionBy(*keys)
    before = over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_d"), F.sum("n").alias("_n"))
    starts = totals.select(
        *keys, "_part", F.sum("_n").over(over).alias("rows"),
        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_d"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
    )
    inner = Window.partitionBy(*keys, "_part").orderBy("x")
    return parts.join(starts, [*keys, "_part"]).select(
        *keys, "x", "n", "rows", (F.col("_d") + F.row_number().over(inner) - 1).alias("d"),
        (F.col("_n") + F.sum("n").over(inner) - F.col("n")).alias("c"),
    )
