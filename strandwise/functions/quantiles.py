"""Exact grouped quantiles that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SPLITS = 31
#: Rows of a group that one task sorts; the values of larger groups are cut into buckets.
SMALL = 10_000


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` per ``keys`` (nulls skipped), for groups of any size.

    The rows are counted per key first.  Groups of up to ``SMALL`` rows are sorted as they
    are, in one shuffle; larger ones take the way of ``_bucketed``.
    """
    keys = list(keys)
    rows = df.where(reduce(and_, [F.col(c).isNotNull() for c in [*keys, value]])).select(
        *keys, (F.col(value).cast("double") + 0.0).alias("_v")
    )
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    order = Window.partitionBy(*keys).orderBy("_v")
    # not broadcast: there may be as many groups as a fraction of all rows
    few = rows.join(sizes.where(F.col("_total") <= SMALL).hint("merge"), keys).withColumn("_cum", F.row_number().over(order))
    many = rows.join(sizes.where(F.col("_total") > SMALL).select(*keys).hint("merge"), keys, "left_semi")
    return _at(few, keys, quantiles).unionByName(_bucketed(many, keys, "_v", quantiles))


def _bucketed(df: DataFrame, keys: list[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Quantiles of groups of any size.

    Equal values are first counted on the map side.  A bounded sketch picks
    splitters per key; the counted values fall into buckets between them, so that
    a group with a third of all rows spreads over many tasks.  The rank of every
    distinct value is its bucket's offset plus its place inside the bucket; the
    sketch only balances the work, the result is exact.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    probs = [(i + 1) / (_SPLITS + 1) for i in range(_SPLITS)]
    splits = counted.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx("_v", probs, 1000)).alias("_s"),
        F.sum("_n").alias("_total"),
    )
    placed = counted.join(splits, keys)
    placed = placed.withColumn(
        "_bucket", F.size(F.filter("_s", lambda s: s < F.col("_v")))
    ).drop("_s")
    sizes = placed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_size"), F.max("_total").alias("_all"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    # only the buckets that hold a wanted rank are looked into
    ranks = [r(F.lit(float(q)) * (F.col("_all") - 1)) for q in quantiles.values() for r in (F.floor, F.ceil)]
    inside = [(r >= F.col("_offset")) & (r < F.col("_offset") + F.col("_size")) for r in ranks]
    offsets = offsets.where(reduce(or_, inside)).select(*keys, "_bucket", "_offset")
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_v")
    ranked = placed.join(offsets, [*keys, "_bucket"]).withColumn(
        "_cum",
        F.col("_offset")
        + F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return _at(ranked, keys, quantiles)


def _at(ranked: DataFrame, keys: list[str], quantiles: Mapping[str, float]) -> DataFrame:
    """The quantiles from rows with ``_v``, ``_cum``, the rows up to it in its group, and ``_total``."""
    aggs = []
    for name, q in quantiles.items():
        rank = F.lit(float(q)) * (F.col("_total") - 1)
        low, high = F.floor(rank), F.ceil(rank)
        aggs += [
            F.min(F.when(F.col("_cum") > low, F.col("_v"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > high, F.col("_v"))).alias(f"_hi_{name}"),
            F.max(rank - low).alias(f"_f_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")
            ).alias(n)
            for n in quantiles
        ],
    )
