"""Stored cohort medians against medians over the union of all batches."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from strandwise.functions.quantiles import exact_quantiles
from strandwise.operators.cohort import add_batch, cohort_median, correct_by_cohort
from strandwise.operators.copynumber import batch_correct

KEYS = ["chrom", "start", "stop"]


def bins(spark, n):
    """``n`` samples over bins of few and many distinct values, a hot value, zeros, negatives and far values."""
    return spark.range(n).crossJoin(spark.range(9).withColumnRenamed("id", "b")).select(
        F.concat(F.lit("s"), "id").alias("sample"), F.when(F.col("id") % 3 == 0, "M").otherwise("F").alias("gender"),
        F.lit("chr1").alias("chrom"), (F.col("b") * 100).alias("start"), (F.col("b") * 100 + 100).alias("stop"),
        F.when(F.col("b") == 0, 0.0).when((F.col("b") == 1) & (F.col("id") % 3 > 0), 1.0).when(F.col("b") == 2, (F.col("id") % 4).cast("double"))
        .when(F.col("b") == 3, F.pow(F.lit(-3.0), F.col("id") % 50)).otherwise(F.pmod(F.xxhash64("id", "b"), F.lit(10007)) / 5000).alias("ratio_gc_fix"),
    )


def split(df, i):
    return df.where(F.pmod(F.xxhash64("sample"), F.lit(3)) == i)


@pytest.mark.parametrize("n", [7, 400])
def test_any_order_gives_the_median_of_all(spark, tmp_path, n):
    df = bins(spark, n)
    want = {tuple(r)[:3]: r["m"] for r in exact_quantiles(df, KEYS, "ratio_gc_fix", {"m": 0.5}).collect()}
    orders = list(itertools.permutations(range(3)))[:: 5 if n == 400 else 6]
    for k, order in enumerate(orders):
        path = str(tmp_path / f"state{k}")
        for i in order:
            add_batch(split(df, i), path, f"0{i}")
        add_batch(split(df, order[0]), path, f"0{order[0]}")  # given again: counts once
        got = {tuple(r)[:3]: r["m"] for r in cohort_median(spark, path, KEYS, "m").collect()}
        assert got == pytest.approx(want, abs=1e-12)


def test_corrects_as_over_the_whole_pool(spark, tmp_path):
    df = bins(spark, 40)
    path = str(tmp_path / "state")
    for i in range(3):
        add_batch(split(df, i), path, str(i))
    for matched in (False, True):
        for least in (10, 20):
            want = batch_correct(df, sex_matched=matched, min_same_sex=least)
            got = correct_by_cohort(df, path, sex_matched=matched, min_same_sex=least)
            rows = [sorted(tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in want.columns) for r in d.collect()) for d in (want, got)]
            assert rows[0] == rows[1]


def test_odd_rows_and_half_written_batches(spark, tmp_path):
    kind = "sample string, gender string, chrom string, start long, stop long, ratio_gc_fix double, batch int, x string"
    rows = [("a", "M", "1", 0, 9, 1.0, 3, ""), ("b", None, "1", 0, 9, 2.0, 3, ""), (None, "M", "1", 0, 9, 50.0, 3, ""), ("c", "F", None, 0, 9, 50.0, 3, ""),
            ("d", "F", "1", 0, 9, None, 3, ""), ("e", "F", "1", 0, 9, float("nan"), 3, ""), ("f", "F", "1", 0, 9, float("inf"), 3, "")]
    path = str(tmp_path / "state")
    add_batch(spark.createDataFrame(rows, kind), path, "1")
    add_batch(spark.createDataFrame([], kind), path, "2")
    # values without ranges: a batch that was never finished
    spark.createDataFrame(rows, kind).selectExpr("chrom", "start", "stop", "gender", "9e0 as x", "5L as n", "180L as range").write.partitionBy("range").parquet(f"{path}/values/batch=3")
    assert [tuple(r) for r in cohort_median(spark, path, KEYS).collect()] == [("1", 0, 9, 2.0)]
