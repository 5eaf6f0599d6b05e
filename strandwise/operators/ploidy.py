"""Ploidy and karyotype from allele ratios and depth."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.intervals import contig_order, restrict_regions

# Start means of the two peaks, and the letters of odd ploidies.
START_MEANS = (0.33, 0.66)
PLOIDY_LETTER = {1: "H", 3: "T"}
_KEY = ("sample", "chrom")
_BINS = 100


def het_ratios(calls: DataFrame, regions: DataFrame | None = None, min_depth: int = 10) -> DataFrame:
    """Positive reference and alternate shares of heterozygous SNPs deeper than ``min_depth``."""
    gts = F.split("gt", "[/|]")
    rows = calls.where(
        (F.col("dp") > min_depth) & (F.col("var_type") == "snp") & (gts[0] != gts[1]) & ~F.array_contains(gts, ".")
    )
    if regions is not None:
        rows = restrict_regions(rows, regions)
    return rows.select(*_KEY, F.explode("ad").alias("a"), "dp").select(
        *_KEY, (F.col("a") / F.col("dp")).alias("ratio")
    ).where("ratio > 0")


def fit_two_peaks(ratios: DataFrame, tol: float = 1e-3, reg: float = 1e-8, max_iter: int = 1000) -> DataFrame:
    """Two-component normal mixture per sample and contig.

    Shares of reads are fractions with small denominators, so equal values are
    counted first; the fit then sees (value, count) pairs, whose number depends on
    the depth and not on the number of sites.  ``rounds`` tells how many steps were
    taken and ``converged`` whether the last changed the likelihood by less than ``tol``.
    """
    counted = ratios.groupBy(*_KEY, "ratio").agg(F.count(F.lit(1)).alias("n"))
    start = np.array(START_MEANS)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, n = pdf["ratio"].to_numpy(), pdf["n"].to_numpy().astype(float)
        near = np.abs(x[:, None] - start).argmin(axis=1)
        resp = np.eye(2)[near]
        means, last = start.copy(), -np.inf
        mass = (resp * n[:, None]).sum(axis=0) + 1e-12
        var = (resp * n[:, None] * (x[:, None] - means) ** 2).sum(axis=0) / mass + reg
        weight = mass / mass.sum()
        rounds, converged = 0, False
        while rounds < max_iter and not converged:
            rounds += 1
            log = -0.5 * ((x[:, None] - means) ** 2 / var + np.log(2 * np.pi * var)) + np.log(weight)
            top = log.max(axis=1, keepdims=True)
            total = top[:, 0] + np.log(np.exp(log - top).sum(axis=1))
            bound = (n * total).sum() / n.sum()
            resp = np.exp(log - total[:, None]) * n[:, None]
            mass = resp.sum(axis=0) + 1e-12
            means = (resp * x[:, None]).sum(axis=0) / mass
            var = (resp * (x[:, None] - means) ** 2).sum(axis=0) / mass + reg
            weight = mass / mass.sum()
            converged, last = abs(bound - last) < tol, bound
        a, b = np.argsort(means)
        return pd.DataFrame(
            {
                "sample": [pdf["sample"].iloc[0]], "chrom": [pdf["chrom"].iloc[0]],
                "w1": weight[a], "m1": means[a], "v1": var[a], "w2": weight[b], "m2": means[b], "v2": var[b],
                "rounds": [rounds], "converged": [bool(converged)],
            }
        )

    schema = "sample string, chrom string, w1 double, m1 double, v1 double, w2 double, m2 double, v2 double, rounds int, converged boolean"
    return counted.groupBy(*_KEY).applyInPandas(fit, schema)


def _normal(x: Column, mean: Column, var: Column) -> Column:
    return F.exp(-(x - mean) * (x - mean) / (2 * var)) / F.sqrt(2 * math.pi * var)


def _histogram_r2(counted: DataFrame, keys: Sequence[str], params: DataFrame, model, low: Column, high: Column) -> DataFrame:
    """R2 of a density against a 100-bin histogram of (keys, x, n); empty bins count."""
    keys = list(keys)
    placed = counted.join(params, keys).withColumn("_lo", low).withColumn("_w", (high - low) / _BINS)
    top = F.col("_lo") + F.col("_w") * _BINS
    inside = placed.where((F.col("x") >= F.col("_lo")) & (F.col("x") <= top))
    slot = F.least(F.floor((F.col("x") - F.col("_lo")) / F.col("_w")), F.lit(_BINS - 1))
    filled = inside.groupBy(*keys, slot.alias("bin")).agg(F.sum("n").alias("n"))
    total = filled.groupBy(*keys).agg(F.sum("n").alias("total"))
    grid = (
        params.join(total, keys)
        .withColumn("_lo", low)
        .withColumn("_w", (high - low) / _BINS)
        .withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_BINS - 1).cast("long"))))
    )
    rows = grid.join(filled, [*keys, "bin"], "left")
    y = F.coalesce(F.col("n"), F.lit(0)) / (F.col("total") * F.col("_w"))
    mid = F.col("_lo") + (F.col("bin") + 0.5) * F.col("_w")
    rows = rows.select(*keys, y.alias("y"), model(mid).alias("f"))
    d = F.col("y") - F.col("f")
    return rows.groupBy(*keys).agg(
        (1 - F.sum(d * d) / (F.sum(F.col("y") * F.col("y")) - F.sum("y") * F.sum("y") / _BINS)).alias("r2")
    )


def peak_quality(fits: DataFrame, ratios: DataFrame) -> DataFrame:
    """Add the distance of the two peaks and the R2 of the mixture density."""
    counted = ratios.groupBy(*_KEY, F.col("ratio").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    span = ratios.groupBy(*_KEY).agg(F.min("ratio").alias("x_min"), F.max("ratio").alias("x_max"))
    params = fits.join(span, list(_KEY))

    def mix(x: Column) -> Column:
        return F.col("w1") * _normal(x, F.col("m1"), F.col("v1")) + F.col("w2") * _normal(x, F.col("m2"), F.col("v2"))

    score = _histogram_r2(counted, _KEY, params, mix, F.col("x_min"), F.col("x_max"))
    return fits.join(score, list(_KEY)).select(
        *fits.columns,
        F.abs(F.col("m1") - F.col("m2")).alias("ratio_separate"),
        F.col("r2").alias("ratio_r2_score"),
    )


def _depth_r2(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, population sd and R2 of a normal on [0, 100] for (keys, x)."""
    keys = list(keys)
    params = values.groupBy(*keys).agg(
        F.avg("x").alias("depth_mean"), F.stddev_pop("x").alias("depth_scale"), F.count(F.lit(1)).alias("n_sites")
    )
    counted = values.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n"))
    var = F.col("depth_scale") * F.col("depth_scale")
    score = _histogram_r2(
        counted, keys, params, lambda m: _normal(m, F.col("depth_mean"), var), F.lit(0.0), F.lit(100.0)
    )
    return params.join(score.withColumnRenamed("r2", "depth_r2_score"), keys, "left")


def fit_depth(calls: DataFrame) -> DataFrame:
    """Normal fit of SNP depth per sample and contig."""
    return _depth_r2(calls.where("var_type = 'snp'").select(*_KEY, F.col("dp").cast("double").alias("x")), _KEY)


def call_ploidy(
    peaks: DataFrame, depth: DataFrame, calls: DataFrame, min_sites: int = 1000, min_r2: float = 0.8, min_gap: float = 0.3
) -> DataFrame:
    """Ploidy per contig: from the peak distance where the fit is good, else from depth.

    A contig with too few variants has ploidy 0.  The depth of one copy is pooled
    over the contigs settled by their peaks; a sample without any is left out.
    """
    sites = calls.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("variant_num"))
    df = sites.join(depth, list(_KEY), "left").join(
        peaks.select(*_KEY, "ratio_separate", "ratio_r2_score"), list(_KEY), "left"
    )
    few = F.col("variant_num") < min_sites
    good = F.coalesce(F.col("ratio_r2_score") > min_r2, F.lit(False))
    settled = F.when(few, 0).when(good, F.when(F.col("ratio_separate") > min_gap, 3).otherwise(2))
    df = df.withColumn("ploidy", settled)
    known = df.where("ploidy > 0").select(*_KEY, "ploidy")
    pooled = calls.where("var_type = 'snp'").join(known, list(_KEY)).select(
        "sample", (F.col("dp") / F.col("ploidy")).alias("x")
    )
    one = _depth_r2(pooled, ["sample"]).select(
        "sample", F.col("depth_mean").alias("_one"), F.col("depth_r2_score").alias("_one_r2")
    )
    share = F.col("depth_mean") / F.col("_one")
    return df.join(one, "sample").select(
        *_KEY,
        F.coalesce(F.col("ploidy"), F.rint(share).cast("int")).alias("ploidy"),
        F.when(few, F.col("variant_num").cast("double")).when(good, F.col("ratio_separate")).otherwise(share).alias("score"),
        F.when(few, F.lit(1.0)).when(good, F.col("ratio_r2_score")).otherwise(
            F.col("_one_r2") * F.col("depth_r2_score")
        ).alias("r_square"),
        F.when(few, "variant_num").when(good, "ratio_separate").otherwise("depth_ratio").alias("func"),
    )


def karyotype(ploidy: DataFrame) -> DataFrame:
    """``total,sex chromosomes`` plus T/H and number of odd autosomes, per sample.

    The letters are left out when all 22 autosomes carry one.  A sample has a couple
    of dozen contigs at most.
    """
    name = F.regexp_replace("chrom", "^chr", "")
    auto = F.col("chrom").rlike("^chr[0-9]+")
    letter = F.lit(None).cast("string")
    for p, text in PLOIDY_LETTER.items():
        letter = F.when(F.col("ploidy") == p, text).otherwise(letter)
    rows = ploidy.select(
        "sample",
        "ploidy",
        F.coalesce(contig_order("chrom"), F.lit(99)).alias("o"),
        F.when(~auto, F.repeat(name, F.col("ploidy"))).alias("sex"),
        F.when(auto & letter.isNotNull(), F.concat(letter, name)).alias("odd"),
        F.when(auto, letter).alias("letter"),
    )

    def joined(column: str) -> Column:
        kept = F.collect_list(F.when(F.col(column).isNotNull(), F.struct("o", F.col(column).alias("t"))))
        return F.array_join(F.transform(F.array_sort(kept), lambda x: x["t"]), "")

    full = F.greatest(*[F.sum((F.col("letter") == t).cast("int")) for t in PLOIDY_LETTER.values()]) == 22
    return rows.groupBy("sample").agg(
        F.concat(
            F.sum("ploidy").cast("string"), F.lit(","), joined("sex"),
            F.when(F.coalesce(full, F.lit(False)), "").otherwise(joined("odd")),
        ).alias("karyotype")
    )


def ploidy_report(ploidy: DataFrame) -> DataFrame:
    """Report rows with a mark on weak fits."""
    return ploidy.select(
        "sample",
        F.col("chrom").alias("Chromosome"),
        F.col("ploidy").alias("Ploidy"),
        F.col("func").alias("Func"),
        F.col("score").alias("Score"),
        F.col("r_square").alias("R-square"),
        (F.col("r_square") < 0.7).alias("weak"),
    )
