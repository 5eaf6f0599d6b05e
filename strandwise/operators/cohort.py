"""Medians of a cohort as a stored state that batches merge into.

The state under a path has, for each batch, three tables: ``values`` counts equal values, laid out by
value range; ``ranges`` counts the rows of each range; ``people`` names the samples. Counts add up, so
batches merge in any order and none is read again to take a new one in. A median is exact: the range
that holds its rank comes from ``ranges``, and only the values of such ranges are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.ranks import ranked
from strandwise.functions.running import running
from strandwise.functions.stages import cut

WIDTH = 0.05


def add_batch(
    bins: DataFrame, path: str, batch: str, *, keys: Sequence[str] = ("chrom", "start", "stop"),
    value: str = "ratio_gc_fix", width: float = WIDTH,
) -> None:
    """Take the rows of one batch into the state; a batch that is given again replaces its former rows.

    Rows whose key, sample or value is null or whose value is not a number take no part. Infinite
    values have ranges of their own. ``width`` is the width of a value range and the same for all batches of a state.
    """
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col("sample").isNotNull()
    for c in keys:
        known = known & F.col(c).isNotNull()
    v = F.col(value).cast("double") + 0.0
    part = F.when(F.abs(v) < 1e15 * width, F.floor(v / width)).otherwise(F.signum(v) * 1e15).cast("long")
    rows = bins.where(known)
    counts = rows.groupBy(*keys, "gender", v.alias("x")).agg(F.count(F.lit(1)).alias("n"), F.first(part).alias("range"))
    home = f"batch={batch}"
    counts.repartitionByRange("range", *keys).sortWithinPartitions("range", *keys).write.mode("overwrite").partitionBy(
        "range"
    ).parquet(f"{path}/values/{home}")
    spark = bins.sparkSession
    written = spark.read.schema(counts.schema).parquet(f"{path}/values/{home}")
    rows.select("sample", "gender").distinct().write.mode("overwrite").parquet(f"{path}/people/{home}")
    # last: a batch is part of the state once its ranges are there
    written.groupBy(*keys, "gender", "range").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{path}/ranges/{home}")


def _state(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the state with its batch names as text."""
    found = spark.read.parquet(f"{path}/{table}")
    kinds = [f"`{f.name}` {'string' if f.name == 'batch' else f.dataType.simpleString()}" for f in found.schema.fields]
    return spark.read.schema(", ".join(kinds)).parquet(f"{path}/{table}")


def cohort_median(spark: SparkSession, path: str, keys: Sequence[str], name: str = "ratio_control") -> DataFrame:
    """Exact median per ``keys`` over all batches; ``keys`` may hold ``gender``."""
    keys = list(keys)
    known = _state(spark, path, "ranges").where(" and ".join(f"`{c}` is not null" for c in keys))
    sizes = known.groupBy(*keys, "range").agg(F.sum("n").alias("n"))
    placed = running(sizes, keys, "range", sums={"upto": F.col("n")})
    total = sizes.groupBy(*keys).agg(F.sum("n").alias("total"))
    lo, hi = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    before = F.col("upto") - F.col("n")
    holds = [(r >= before) & (r < F.col("upto")) for r in (lo, hi)]
    wanted = cut(placed.join(total, keys).where(holds[0] | holds[1]).select(
        *keys, "range", before.alias("before"), lo.alias("lo"), hi.alias("hi")
    ))
    # a row per batch: a shuffle by batch would have one task for each
    batches = F.broadcast(known.select("batch").distinct())
    values = _state(spark, path, "values").join(batches, "batch", "left_semi").join(
        wanted.select(*keys, "range"), [*keys, "range"], "left_semi"
    )
    at = ranked(values.groupBy(*keys, "range", "x").agg(F.sum("n").alias("n")), [*keys, "range"]).join(wanted, [*keys, "range"])

    def of(rank: str) -> Column:
        first = F.col("before") + F.col("c")
        return F.max(F.when((F.col(rank) >= first) & (F.col(rank) < first + F.col("n")), F.col("x")))

    return at.groupBy(*keys).agg(of("lo").alias("_lo"), of("hi").alias("_hi")).select(
        *keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.when(F.col("_lo") == F.col("_hi"), 0.0).otherwise(0.5)).alias(name)
    )


def correct_by_cohort(
    bins: DataFrame, path: str, *, keys: Sequence[str] = ("chrom", "start", "stop"), value: str = "ratio_gc_fix",
    sex_matched: bool = False, min_same_sex: int = 10,
) -> DataFrame:
    """Divide by the cohort's median of each bin, as ``batch_correct`` does over all samples of the state.

    A zero median is 1; a bin that no batch has gets null. With ``sex_matched`` a sex with at least
    ``min_same_sex`` samples has its own line.
    """
    spark, keys = bins.sparkSession, list(keys)
    out = bins.join(cohort_median(spark, path, keys), keys, "left")
    if sex_matched:
        batches = F.broadcast(_state(spark, path, "ranges").select("batch").distinct())
        people = _state(spark, path, "people").join(batches, "batch", "left_semi")
        people = people.select("sample", "gender").distinct().groupBy("gender").agg(F.count(F.lit(1)).alias("_n"))
        own = cohort_median(spark, path, [*keys, "gender"], "_own")
        out = out.join(own, [*keys, "gender"], "left").join(F.broadcast(people), "gender", "left").withColumn(
            "ratio_control", F.when(F.col("_n") >= min_same_sex, F.col("_own")).otherwise(F.col("ratio_control"))
        )
    control = F.when(F.col("ratio_control") == 0, 1.0).otherwise(F.col("ratio_control"))
    return out.withColumn("ratio_control", control).select(
        *bins.columns, "ratio_control", (F.col(value) / F.col("ratio_control")).alias("ratio_batch_fix")
    )
