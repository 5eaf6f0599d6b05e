"""Truth comparison, droplet counts and probe assays."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions.columns import col, ratio, round_even
from strandwise.functions.running import running
from strandwise.operators.intervals import intersect_intervals, merge_intervals, restrict_regions
from strandwise.operators.peaks import peak_shape, thin
from strandwise.functions.stages import cut

# Dosage limits, copy classes and peak settings.
LOSS, GAIN = 0.7, 1.3
HOM_DEL, HET_LOW, HET_UP, NORMAL_LOW, NORMAL_UP = 0.2, 0.35, 0.65, 0.8, 1.3
MIN_R2, MAX_LOST_PROBES, WEAK_PEAK = 0.997, 3, 0.25
THETA_LOW, THETA_UP, MIN_P, MIN_TOTAL, MIN_BF = 0.48, 0.52, 0.05, 1000, 1.0


def concordance(calls: DataFrame, truth: DataFrame, confident: DataFrame, target: DataFrame) -> DataFrame:
    """TP, FP, FN by SNP and INDEL inside the confident part of the target."""
    spans = ["chrom", "start", "stop"]
    # the common parts of two disjoint sets are disjoint
    both = intersect_intervals(
        merge_intervals(confident.select(*spans)), merge_intervals(target.select(*spans))
    ).select(*spans)
    key = ["chrom", "pos", "ref", "alt"]
    kind = F.when(F.col("var_type") == "snp", "SNP").otherwise("INDEL")

    def marked(df: DataFrame, called: bool) -> DataFrame:
        return df.select(*key, kind.alias("type"), F.lit(called).alias("called"), F.lit(not called).alias("true"))

    sites = marked(calls, True).unionByName(marked(truth, False)).groupBy(*key, "type").agg(
        F.max("called").alias("called"), F.max("true").alias("true")
    )
    c, t = F.col("called"), F.col("true")
    return restrict_regions(sites, both, merged=True).groupBy("type").agg(
        F.sum((c & t).cast("long")).alias("TP"),
        F.sum((c & ~t).cast("long")).alias("FP"),
        F.sum((~c & t).cast("long")).alias("FN"),
    )


def accuracy_stats(counts: DataFrame, regions: DataFrame, sample: str) -> DataFrame:
    """Sensitivity, specificity and accuracy overall and by type, one row."""
    size = regions.agg(F.sum(F.col("stop") - F.col("start")).alias("size"))

    def total(name: str, kind: str | None = None) -> Column:
        v = F.col(name) if kind is None else F.when(F.col("type") == kind, F.col(name))
        return F.coalesce(F.sum(v), F.lit(0))

    one = counts.agg(
        *[total(n).alias(n.lower()) for n in ("TP", "FP", "FN")],
        *[total(n, "SNP").alias(f"{n.lower()}_snp") for n in ("TP", "FP", "FN")],
    ).crossJoin(F.broadcast(size))  # one row each
    for n in ("tp", "fp", "fn"):
        one = one.withColumn(f"{n}_indel", F.col(n) - F.col(f"{n}_snp"))
    one = one.withColumn("tn", F.col("size") - F.col("tp") - F.col("fn") - F.col("fp"))
    one = one.withColumn("tn_snp", F.col("tn") - F.col("fp_snp")).withColumn("tn_indel", F.col("tn") - F.col("fp_indel"))
    out = [F.lit(sample).alias("sample_id")]
    for suffix in ("", "_snp", "_indel"):
        tp, fp, fn, tn = (F.col(f"{n}{suffix}") for n in ("tp", "fp", "fn", "tn"))
        out += [
            ratio(tp, tp + fn).alias(f"sensitivity{suffix}"),
            ratio(tn, tn + fp).alias(f"specificity{suffix}"),
            ratio(tp + tn, tp + tn + fp + fn).alias(f"accuracy{suffix}"),
        ]
    out += [F.col(f"{n}_{k}") for n in ("tp", "fp", "fn") for k in ("snp", "indel")]
    return one.select(*out)


def chi_square(a, b, c, d) -> Column:
    """2 x 2 statistic with continuity correction; null on an empty margin."""
    cells = [[col(a).cast("double"), col(b).cast("double")], [col(c).cast("double"), col(d).cast("double")]]
    rows = [cells[0][0] + cells[0][1], cells[1][0] + cells[1][1]]
    cols = [cells[0][0] + cells[1][0], cells[0][1] + cells[1][1]]
    total = rows[0] + rows[1]
    out = F.lit(0.0)
    for i in range(2):
        for j in range(2):
            expected = rows[i] * cols[j] / F.nullif(total, F.lit(0.0))
            off = F.abs(cells[i][j] - expected)
            off = off - F.least(off, F.lit(0.5))
            out = out + off * off / F.nullif(expected, F.lit(0.0))
    return out


def two_by_two_p(a, b, c, d) -> Column:
    """P value of ``chi_square`` at one degree of freedom (no error function in Spark)."""

    @F.pandas_udf("double")
    def tail(x: pd.Series) -> pd.Series:
        return pd.Series([math.erfc(math.sqrt(v / 2)) if v == v else None for v in x.astype(float)], dtype="float64")

    return tail(chi_square(a, b, c, d))


def bayes_factor(df: DataFrame, x: str, n: str, grid: int = 1_000_000, alpha: float = 4, beta: float = 100) -> DataFrame:
    """Add ``bf``: homozygous against wild-type or heterozygous, Beta prior on the imbalance.

    The binomial coefficient and the power of two cancel.  Each distinct (x, n) is
    integrated once on the grid, in log space.  The pairs are few bytes and much work,
    so they are dealt to as many tasks as a shuffle has, which no size merges.
    """
    @F.pandas_udf("double")
    def integrate(hit: pd.Series, total: pd.Series) -> pd.Series:
        p = np.arange(1, grid) / grid  # the density is 0 at 1
        up, down = np.log1p(p), np.log1p(-p)
        const = math.lgamma(alpha + beta) - math.lgamma(alpha) - math.lgamma(beta)
        prior = const + (alpha - 1) * np.log(p) + (beta - 1) * down
        out, a, b, rest = [], *(np.empty_like(p) for _ in range(3))

        def density(of: np.ndarray, x: np.ndarray, k: float, y: np.ndarray, m: float) -> None:
            np.add(prior, np.multiply(x, k, out=of), out=of)
            np.add(of, np.multiply(y, m, out=rest), out=of)

        def area(of: np.ndarray, top: float) -> float:
            return np.exp(np.subtract(of, top, out=of), out=of).sum() / grid

        for k, m in zip(hit, total):
            density(a, up, k, down, m - k)
            density(b, down, k, up, m - k)
            top = max(a.max(), b.max(), 0.0)
            out.append(area(a, top) / (area(b, top) + 2 * math.exp(-top)))
        return pd.Series(out, dtype="float64")

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = df.select(x, n).where(F.col(x).isNotNull() & F.col(n).isNotNull()).distinct().repartition(parts, F.xxhash64(x, n))
    scored = pairs.withColumn("bf", round_even(integrate(F.col(x), F.col(n)), 3))
    return df.join(scored, [x, n], "left").select(*df.columns, "bf")


def droplet_verdict(p, theta, total, bf) -> Column:
    """Genotype text from significance, mutant share, droplets and Bayes factor."""
    p, theta, total, bf = col(p), col(theta), col(total), col(bf)
    many, strong = total >= MIN_TOTAL, bf >= MIN_BF
    high, low = theta > THETA_UP, theta < THETA_LOW
    hom = "Homozygous genotype (conclusive)"
    sure = (
        F.when(high, hom)
        .when(low, "Wildtype genotype (conclusive)")
        .when(many & strong, hom)
        .when(many, "Probably wildtype genotype (θ<50%) or retest (θ>=50%)")
        .otherwise("Possibly wildtype genotype (θ<50%) or homozygous (θ>50%) genotype")
    )
    unsure = (
        F.when(high & many & strong, hom)
        .when(high & many, "Retest")
        .when(high, "Probably homozygous genotype")
        .when(low, "Wildtype or heterozygous genotype (conclusive)")
        .when(many & strong, "Probably homozygous genotype")
        .when(many, "Possibly heterozygous genotype")
        .otherwise("Inconclusive")
    )
    return F.when(p < MIN_P, sure).otherwise(unsure)


def droplet_genotype(rows: DataFrame, grid: int = 1_000_000) -> DataFrame:
    """(mut, wild, mut_c, wild_c) droplet counts → p, theta, bf, genotype."""
    df = rows.withColumn("total", F.col("mut") + F.col("wild"))
    df = bayes_factor(df, "mut", "total", grid)
    df = df.withColumn("theta", ratio(F.col("mut"), F.col("total"))).withColumn(
        "p", two_by_two_p("mut", "wild", "mut_c", "wild_c")
    )
    return df.withColumn("genotype", droplet_verdict("p", "theta", "total", "bf"))


def size_calibration(ladder: DataFrame, sizes: Sequence[float]) -> DataFrame:
    """Straight line from scan position to fragment size per sample.

    The last len(sizes) ladder peaks are matched to the sizes, right-aligned.  A
    trace has a few dozen ladder peaks.
    """
    n = len(sizes)
    from_end = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("pos")))
    known = F.array(*[F.lit(float(s)) for s in sizes])
    rows = ladder.withColumn("_k", from_end).where(F.col("_k") <= n)
    rows = rows.withColumn("size", F.get(known, F.lit(n) - F.col("_k")))
    x = F.col("pos").cast("double")
    return rows.groupBy("sample").agg(
        F.regr_slope("size", x).alias("slope"),
        F.regr_intercept("size", x).alias("intercept"),
        round_even(F.regr_r2("size", x), 4).alias("r_square_sizing"),
    )


def probe_linearity(found: DataFrame) -> DataFrame:
    """R2 of measured against theoretical probe size; undetected probes (0) left out."""
    return found.where("size <> 0").groupBy("sample").agg(
        round_even(F.regr_r2("size", "probe_size"), 4).alias("r_square_detect")
    )


def size_peaks(peaks: DataFrame, fits: DataFrame) -> DataFrame:
    """Add the fragment size of each peak, one digit."""
    return peaks.join(fits, "sample").select(
        *peaks.columns, round_even(F.col("slope") * F.col("pos") + F.col("intercept"), 1).alias("size")
    )


def assign_probe(peaks: DataFrame, probes: Sequence[tuple[str, float, float, float]], samples: DataFrame | None = None) -> DataFrame:
    """Highest peak of each probe per sample.

    ``probes``: (name, size, low, high); a peak belongs to the probe of nearest size
    if its deviation is strictly inside (low, high).  The panel is a literal, so the
    nearest probe is found per row without a join.  Undetected probes get zeros.
    """
    panel = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.lit(n).alias("probe"), F.lit(float(s)).alias("size"),
                F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high"),
            )
            for i, (n, s, a, b) in enumerate(probes)
        ]
    )
    scored = F.transform(
        panel, lambda p: F.struct(F.abs(F.col("size") - p["size"]).alias("d"), p["i"].alias("i"), p.alias("p"))
    )
    near = peaks.withColumn("_n", F.array_min(scored)["p"])
    off = F.col("size") - F.col("_n.size")
    kept = near.where((off > F.col("_n.low")) & (off < F.col("_n.high")))
    best = kept.groupBy("sample", F.col("_n.probe").alias("probe")).agg(
        F.max_by(F.struct("size", "pos", "height"), F.struct(F.col("height"), -F.col("pos"))).alias("b")
    )
    people = (peaks if samples is None else samples).select("sample").distinct()
    grid = people.withColumn("p", F.explode(panel)).select(
        "sample", "p.probe", F.col("p.size").alias("probe_size")
    )
    return grid.join(best, ["sample", "probe"], "left").select(
        "sample", "probe", "probe_size",
        *[F.coalesce(F.col(f"b.{c}").cast("double"), F.lit(0.0)).alias(c) for c in ("size", "pos", "height")],
    )


def _maxima(signal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Local maxima; a flat top counts once, at its middle.  (keys, pos, height)"""
    keys = list(keys)
    steps = running(signal, keys, "pos", block=100_000, lags={"_before": F.col("intensity")})
    runs = steps.where(F.col("_before").isNull() | (F.col("_before") != F.col("intensity"))).drop("_before")
    runs = running(
        runs, keys, "pos", block=100_000,
        lags={"_left": F.col("intensity")},
        leads={"_right": F.col("intensity"), "_end": F.col("pos")},
    )
    x = F.col("intensity")
    top = runs.where((F.col("_left") < x) & (F.col("_right") < x))
    return top.select(*keys, F.floor((F.col("pos") + F.col("_end") - 1) / 2).alias("pos"), x.alias("height"))


def call_peaks(
    signal: DataFrame, height: float, distance: int, max_peaks: int | None = None,
    keys: Sequence[str] = ("sample",), max_height: float | None = None,
    min_width: float | None = None, max_width: float | None = None, min_prominence_share: float | None = None, rel_height: float = 0.5,
) -> DataFrame:
    """Peaks of traces (keys, pos, intensity): (keys, pos, height).

    After thinning, peaks narrower than ``min_width`` or wider than ``max_width`` at
    ``rel_height`` of their prominence go, and those whose prominence is under
    ``min_prominence_share`` of their height.  With more than ``max_peaks`` left the search
    is repeated over one more than the height of the first peak too many.
    """
    keys = list(keys)
    tops = _maxima(signal, keys).where(F.col("height") >= height)
    if max_height is not None:
        tops = tops.where(F.col("height") <= max_height)
    tops = cut(tops)

    def chosen(rows: DataFrame) -> DataFrame:
        rows = thin(rows, keys, distance)
        if min_width is None and max_width is None and min_prominence_share is None:
            return rows
        shaped = peak_shape(rows, signal, keys, rel_height)
        if min_width is not None:
            shaped = shaped.where(F.col("width") >= min_width)
        if max_width is not None:
            shaped = shaped.where(F.col("width") <= max_width)
        if min_prominence_share is not None:
            shaped = shaped.where(F.col("prominence") / F.col("height") >= min_prominence_share)
        return shaped.select(*rows.columns)

    if max_peaks is None:
        return chosen(tops)
    first = cut(chosen(tops))
    # the peaks of one trace: at most its length over the distance
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("height"), F.desc("pos")))
    limit = first.withColumn("_r", rank).where(F.col("_r") == max_peaks + 1).select(
        *keys, (F.col("height") + 1).alias("_limit")
    )
    again = tops.join(limit, keys).where(F.col("height") >= F.col("_limit")).drop("_limit")
    return first.join(limit, keys, "left_anti").unionByName(chosen(again))


def drop_weak_ladder_peak(peaks: DataFrame, n: int, share: float = WEAK_PEAK) -> DataFrame:
    """Without the lowest of the last ``n`` peaks when it is under ``share`` of their median."""
    from_end = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("pos")))
    last = peaks.withColumn("_k", from_end).where(F.col("_k") <= n)
    stat = last.groupBy("sample").agg(
        F.min(F.struct("height", "pos")).alias("m"), F.median("height").alias("mid")
    )
    weak = stat.where(F.col("m.height") / F.col("mid") < share).select("sample", F.col("m.pos").alias("pos"))
    return peaks.join(weak, ["sample", "pos"], "left_anti")


def _array_median(a: Column) -> Column:
    s, n = F.array_sort(a), F.size(a)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def dosage_quotient(heights: DataFrame, min_references: int = 3) -> tuple[DataFrame, DataFrame]:
    """Relative dose of each probe per sample with its interval, and the reference interval.

    ``heights`` (sample, probe, height, is_ref); probes named Ref… normalise.  A
    sample's reference-probe heights are one small map (the panel); each sample's
    probe meets the same probe of the reference samples, and the per-reference-probe
    ratios are arrays, so no probe x probe rows are made.  The interval takes the
    squared variance, as published.  Fewer than three references give no rows.
    """
    refs = heights.where(F.col("probe").startswith("Ref")).groupBy("sample").agg(
        F.map_from_entries(F.collect_list(F.struct("probe", "height"))).alias("refs")
    )
    rows = heights.join(refs, "sample").select("sample", "probe", "height", "is_ref", "refs")
    control = rows.where("is_ref").select(
        F.col("sample").alias("h"), "probe", F.col("height").alias("h_height"), F.col("refs").alias("h_refs")
    )
    count = heights.where("is_ref").agg(F.countDistinct("sample").alias("_n"))
    control = control.crossJoin(F.broadcast(count)).where(F.col("_n") >= min_references).drop("_n")  # one row
    pairs = rows.join(control, "probe").where("sample <> h")

    def quotient(z: Column) -> Column:
        # a reference probe missing from one of the two samples gives no ratio
        mine = F.col("height") / F.nullif(F.try_element_at("refs", z), F.lit(0.0))
        theirs = F.col("h_height") / F.nullif(F.try_element_at("h_refs", z), F.lit(0.0))
        return mine / F.nullif(theirs, F.lit(0.0))

    others = F.filter(F.map_keys("h_refs"), lambda z: z != F.col("probe"))
    pairs = pairs.withColumn("_x", F.array_compact(F.transform(others, quotient))).where("size(_x) > 0")
    pairs = pairs.withColumn("dq", _array_median(F.col("_x")))
    pairs = pairs.withColumn("mad", _array_median(F.transform("_x", lambda x: F.abs(x - F.col("dq")))))
    per = pairs.groupBy("sample", "probe", "is_ref").agg(
        F.avg("dq").alias("DQ"), F.avg("mad").alias("_mad"), F.var_pop("dq").alias("_var")
    )
    spread = 1.96 * F.sqrt(F.pow(1.4826 * F.col("_mad"), 2) + F.pow("_var", 2))
    dq = per.select(
        "sample", "probe", "is_ref", "DQ",
        round_even(F.col("DQ") - spread, 4).alias("low"), round_even(F.col("DQ") + spread, 4).alias("up"),
    )
    mean, var = F.avg("DQ"), F.var_pop("DQ")
    interval = dq.where("is_ref").groupBy("probe").agg(
        round_even(mean - 1.96 * var, 4).alias("low"), round_even(mean + 1.96 * var, 4).alias("up")
    )
    return dq, interval


def probe_copies(dq) -> Column:
    """Copy class of a test probe."""
    x = col(dq)
    return (
        F.when(x >= NORMAL_UP, ">2").when(x > NORMAL_LOW, "2").when(x >= HET_UP, "1.5")
        .when(x > HET_LOW, "1").when(x >= HOM_DEL, "0.5").otherwise("0")
    )


def probe_copy_call(dq: DataFrame, interval: DataFrame) -> DataFrame:
    """Copies of each test probe with the sample's quality verdict; a failure blanks them."""
    low, up, x = F.col("low"), F.col("up"), F.col("DQ")
    odd = (x < LOSS) | (x > GAIN)
    astray = (low > GAIN) | (up < LOSS) | ((low < LOSS) & (up > LOSS)) | ((low < GAIN) & (up > GAIN))
    shared = F.greatest(F.least(up, F.lit(GAIN)) - F.greatest(low, F.lit(LOSS)), F.lit(0.0))
    covered = (up != low) & (shared / F.nullif(up - low, F.lit(0.0)) >= 0.6)

    def n(cond: Column) -> Column:
        return F.sum(F.coalesce(cond, F.lit(False)).cast("int"))

    is_ref = F.col("probe").startswith("Ref")
    sums = dq.groupBy("sample").agg(
        n(is_ref & odd).alias("a"), n(is_ref & astray).alias("b"), n(is_ref & covered).alias("c")
    )
    fail = (F.col("a") >= 2) | ((F.col("b") >= 8) & (F.col("c") <= 5)) | ((F.col("a") >= 1) & (F.col("c") <= 6))
    batch = interval.agg(
        F.coalesce(F.max(((low < LOSS) | (up > GAIN)).cast("int")), F.lit(0)).alias("bad")
    )  # one row
    qc = sums.crossJoin(F.broadcast(batch)).select(
        "sample",
        F.concat_ws(";", F.when(F.col("bad") == 1, "ref_sample_fail"), F.when(fail, "ref_probe_fail")).alias("_qc"),
    )
    passed = F.col("_qc") == ""
    return dq.where(~is_ref).join(qc, "sample").select(
        "sample", "probe", "DQ", "low", "up",
        F.when(passed, probe_copies("DQ")).otherwise(".").alias("copies"),
        F.when(passed, "pass").otherwise(F.col("_qc")).alias("qc"),
    )


def peak_qc(found: DataFrame, sizing: DataFrame, samples: DataFrame) -> DataFrame:
    """Quality verdict per sample of ladder fit, probe detection and probe linearity.

    A sample without a ladder fit failed to show the standard.
    """
    lost = F.col("size") == 0
    probes = found.groupBy("sample").agg(
        F.sum((lost & F.col("probe").startswith("Ref")).cast("int")).alias("lost_ref"),
        F.sum((lost & ~F.col("probe").startswith("Ref")).cast("int")).alias("lost_test"),
    )
    df = samples.select("sample").distinct().join(sizing, "sample", "left").join(probes, "sample", "left").join(
        probe_linearity(found), "sample", "left"
    )
    no_ladder = F.col("r_square_sizing").isNull()
    flags = F.concat_ws(
        ";",
        F.when(no_ladder, "standard_detect_fail"),
        F.when(F.col("r_square_sizing") < MIN_R2, "standard_fit_sizing_fail"),
        F.when(~no_ladder & ((F.col("lost_ref") > 0) | (F.col("lost_test") > MAX_LOST_PROBES)), "probe_detect_fail"),
        F.when(~no_ladder & (F.col("r_square_detect") < MIN_R2), "probe_fit_sizing_fail"),
    )
    return df.select("sample", "r_square_sizing", "r_square_detect", F.when(flags == "", "pass").otherwise(flags).alias("QC"))


def ladder_by_slope(
    peaks: DataFrame, sizes: Sequence[float], limits: Sequence[float], min_found: int = 30, retries: int = 8
) -> DataFrame:
    """Ladder peaks matched to sizes by walking from the longest down.

    A peak is taken when the slope to the last match changes by no more than the
    size's limit; with too few matches the last peak is dropped and the walk starts
    again, ``retries`` walks in all; the last walk counts.  Sequential by nature; one group is the few dozen ladder peaks of a trace.
    """
    known, bounds = [float(s) for s in sizes], [float(x) for x in limits]

    def walk(pos: np.ndarray) -> list[tuple[int, int]]:
        taken: list[tuple[int, int]] = []
        at, slope = len(pos) - 1, 0.0
        for k in range(len(known) - 1, -1, -1):
            while at >= 0:
                here, at = at, at - 1
                if len(taken) < 2:
                    taken.append((k, here))
                    if len(taken) == 2:
                        (k1, i1), (k2, i2) = taken
                        slope = (known[k1] - known[k2]) / (pos[i1] - pos[i2])
                    break
                k1, i1 = taken[-1]
                new = (known[k1] - known[k]) / (pos[i1] - pos[here])
                if min(new, slope) / max(new, slope) >= bounds[k]:
                    taken.append((k, here))
                    slope = new
                    break
        return taken

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        best: list[tuple[int, int]] = []
        for dropped in range(min(retries, len(pdf) - 1)):
            best = walk(pdf["pos"].to_numpy()[: len(pdf) - dropped].astype(float))
            if len(best) >= min_found:
                break
        rows = [
            (pdf["sample"].iloc[0], known[k], int(pdf["pos"].iloc[i]), float(pdf["height"].iloc[i]))
            for k, i in sorted(best)
        ]
        return pd.DataFrame(rows, columns=["sample", "size", "pos", "height"])

    return peaks.select("sample", "pos", "height").groupBy("sample").applyInPandas(
        match, "sample string, size double, pos long, height double"
    )


def interpolate_size(peaks: DataFrame, ladder: DataFrame) -> DataFrame:
    """Size of each peak on the line through its two nearest ladder peaks, one digit.

    Peaks before the first ladder peak are dropped.  A ladder is a few dozen points.
    """
    points = ladder.groupBy("sample").agg(
        F.array_sort(F.collect_list(F.struct(F.col("pos").alias("x"), F.col("size").alias("y")))).alias("_l")
    )
    near = F.array_sort(
        F.transform("_l", lambda p: F.struct(F.abs(p["x"] - F.col("pos")).alias("d"), p["x"].alias("x"), p["y"].alias("y")))
    )
    df = peaks.join(points, "sample").where((F.size("_l") >= 2) & (F.col("pos") >= F.col("_l")[0]["x"]))
    df = df.withColumn("_a", F.get(near, F.lit(0))).withColumn("_b", F.get(near, F.lit(1)))
    k = (F.col("_b.y") - F.col("_a.y")) / (F.col("_b.x") - F.col("_a.x"))
    return df.select(*peaks.columns, round_even(k * (F.col("pos") - F.col("_a.x")) + F.col("_a.y"), 1).alias("size"))
