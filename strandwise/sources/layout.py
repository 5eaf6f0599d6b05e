"""Calls laid out by contig and position, and a fetch of regions that reads little else.

The layout is plain Parquet: folders by contig and span of positions, rows in order of position
inside a file, so that Spark's partition pruning leaves folders out and the ranges of its row
groups leave rows out.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandwise.functions.stages import cut
from strandwise.operators.intervals import merge_intervals, restrict_regions

SPAN = 1_000_000
MAX_FILTERS = 100


def _span(pos: Column, span: int) -> Column:
    return F.floor(pos / F.lit(span)).cast("long")


def write_by_position(df: DataFrame, path: str, span: int = SPAN, mode: str = "error") -> None:
    """Write rows with ``chrom`` and 1-based ``pos`` for :func:`fetch_regions`.

    Tasks take ranges of (contig, position), so a large contig is many tasks and a folder has few
    files. Rows without contig or position are written too; no region reads them.
    """
    placed = df.withColumn("_contig", F.col("chrom")).withColumn("_span", _span(F.col("pos"), span))
    ordered = placed.repartitionByRange("_contig", "pos").sortWithinPartitions("_contig", "_span", "pos")
    ordered.write.mode(mode).partitionBy("_contig", "_span").parquet(path)


def _few(regions: DataFrame, span: int, most: int) -> list | None:
    """At most ``most`` regions that cover the given disjoint ones; None where the contigs alone are more.

    Ends are rounded outwards to wider and wider steps until few enough are left.
    """
    step = 1
    while step < 1 << 62:
        wide = regions if step == 1 else merge_intervals(regions.select(
            "chrom", (F.floor(F.col("start") / step) * step).alias("start"), (F.ceil(F.col("stop") / step) * step).alias("stop")
        ))
        rows = wide.select("chrom", "start", "stop").limit(most + 1).collect()  # at most ``most`` + 1 rows
        if len(rows) <= most:
            return rows
        step = span if step == 1 else step * 16
    return None


def scan_regions(
    spark: SparkSession, path: str, schema: T.StructType, regions: DataFrame, span: int = SPAN, most: int = MAX_FILTERS
) -> DataFrame:
    """Rows of the layout in or near the disjoint ``regions``, by folder and row-group filters alone."""
    inner = T.StructType([*schema.fields, T.StructField("_contig", T.StringType()), T.StructField("_span", T.LongType())])
    rows = spark.read.schema(inner).parquet(path)
    few = _few(regions, span, most)
    if few is None:
        return rows.select(*schema.names)
    folders, places = [F.lit(False)], [F.lit(False)]
    for r in few:
        folders.append((F.col("_contig") == r["chrom"]) & F.col("_span").between((r["start"] + 1) // span, r["stop"] // span))
        places.append((F.col("chrom") == r["chrom"]) & (F.col("pos") > r["start"]) & (F.col("pos") <= r["stop"]))
    return rows.where(reduce(or_, folders)).where(reduce(or_, places)).select(*schema.names)


def fetch_regions(
    spark: SparkSession, path: str, schema: T.StructType, regions: DataFrame, span: int = SPAN, most: int = MAX_FILTERS
) -> DataFrame:
    """Rows whose 1-based ``pos`` is in (start, stop] of any region, read from :func:`write_by_position`'s layout.

    ``schema`` is that of the rows written and ``span`` the span they were written with. Merged regions, rounded outwards to ``most`` at most, become filters on folders
    and positions; the exact match follows. Regions that are empty or lack a value match nothing; so does an empty contig name.
    """
    spans = regions.where("chrom is not null and start < stop").select("chrom", "start", "stop")
    merged = cut(merge_intervals(spans).select("chrom", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")))
    return restrict_regions(scan_regions(spark, path, schema, merged, span, most), merged, merged=True)
