"""Reference sequence lookup from a chunk table (chrom, chunk, seq).

``chunk`` numbers start at 0 and each ``seq`` but the last of a contig has
``chunk_size`` bases, so any slice is an equi join on (chrom, chunk).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import round_even


def _pieces(spans: DataFrame, ref_chunks: DataFrame, chunk_size: int) -> DataFrame:
    """One row per (span, chunk) with the piece of the span inside the chunk."""
    parts = spans.where("start < stop").withColumn(
        "chunk",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / chunk_size), F.floor((F.col("stop") - 1) / chunk_size)
            )
        ),
    )
    offset = F.col("chunk") * chunk_size
    low = F.greatest(F.col("start") - offset, F.lit(0))
    high = F.least(F.col("stop") - offset, F.lit(chunk_size))
    return parts.join(ref_chunks, ["chrom", "chunk"]).withColumn(
        "piece", F.substring("seq", (low + 1).cast("int"), (high - low).cast("int"))
    ).drop("seq")


def sequence_at(df: DataFrame, ref_chunks: DataFrame, chunk_size: int, name: str = "seq") -> DataFrame:
    """Add the reference bases of each half-open (chrom, start, stop)."""
    spans = df.select("chrom", "start", "stop").distinct()
    text = (
        _pieces(spans, ref_chunks, chunk_size)
        .groupBy("chrom", "start", "stop")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda s: s["piece"]
                ),
                "",
            ).alias(name)
        )
    )
    return df.join(text, ["chrom", "start", "stop"], "left").select(*df.columns, name)


def base_at(df: DataFrame, ref_chunks: DataFrame, chunk_size: int, pos: str, name: str) -> DataFrame:
    """Add the reference base at one 1-based position: a single equi join."""
    zero = F.col(pos) - 1
    keyed = df.withColumn("_chunk", F.floor(zero / chunk_size))
    ref = ref_chunks.select("chrom", F.col("chunk").alias("_chunk"), F.col("seq").alias("_seq"))
    at = (F.pmod(zero, F.lit(chunk_size)) + 1).cast("int")
    return keyed.join(ref, ["chrom", "_chunk"], "left").select(
        *df.columns, F.substring("_seq", at, F.lit(1)).alias(name)
    )


def window_gc(windows: DataFrame, ref_chunks: DataFrame, chunk_size: int) -> DataFrame:
    """GC fraction of each half-open window, N left out, 0 when nothing else is there.

    Counts are summed over the pieces, so no window is ever put together as text.
    """
    spans = windows.select("chrom", "start", "stop").distinct()
    gc = F.length(F.regexp_replace("piece", "[^GCgc]", ""))
    known = F.length(F.regexp_replace("piece", "[Nn]", ""))
    counts = (
        _pieces(spans, ref_chunks, chunk_size)
        .groupBy("chrom", "start", "stop")
        .agg(F.sum(gc).alias("_gc"), F.sum(known).alias("_known"))
    )
    return windows.join(counts, ["chrom", "start", "stop"], "left").select(
        *windows.columns,
        F.when(F.col("_known") > 0, round_even(F.col("_gc") / F.col("_known"), 3))
        .otherwise(F.lit(0.0))
        .alias("gc"),
    )


def unknown_bases(regions: DataFrame, ref_chunks: DataFrame, chunk_size: int) -> DataFrame:
    """Add ``n_size``, the number of N bases in the closed slice [max(start,1), stop]."""
    spans = regions.select("chrom", "start", "stop").distinct()
    closed = spans.select(
        "chrom",
        (F.greatest(F.col("start"), F.lit(1)) - 1).alias("start"),
        "stop",
        F.col("start").alias("_start"),
    )
    counts = (
        _pieces(closed, ref_chunks, chunk_size)
        .groupBy("chrom", F.col("_start").alias("start"), "stop")
        .agg(F.sum(F.length(F.regexp_replace("piece", "[^Nn]", ""))).alias("n_size"))
    )
    return regions.join(counts, ["chrom", "start", "stop"], "left").select(
        *regions.columns, F.coalesce("n_size", F.lit(0)).cast("long").alias("n_size")
    )
