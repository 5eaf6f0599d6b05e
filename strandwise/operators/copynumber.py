"""Copy number from windowed or exon depth."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions.columns import col, ratio, round_even
from strandwise.functions.quantiles import exact_quantiles
from strandwise.functions.running import running, sweep
from strandwise.functions.stages import cut
from strandwise.operators.arcs import PERMUTED, best_arcs, change_tail, student
from strandwise.operators.intervals import overlap_join


@dataclass(frozen=True)
class CopyConf:
    """Decision limits (fixed default values)."""

    dup: float = 1.3
    del_: float = 0.75
    hom_del: float = 0.2
    dup_male_x: float = 1.5
    del_male_x: float = 0.3
    dup_single: float = 1.4
    del_single: float = 0.65
    nearby_distance: float = 0.1
    nearby_recall_distance: float = 0.05
    nice_cv: float = 0.1


# Copy-ratio classes of a pharmacogene, row number = copies.
COPY_BINS = ((0, 0.2), (0.2, 0.566), (0.566, 1.25), (1.25, 1.75), (1.75, 2.25), (2.25, 2.75))


def _male_x() -> Column:
    return (F.col("gender") == "M") & (F.col("chrom") == "chrX")


def normalize_depth(bins: DataFrame) -> DataFrame:
    """Add ``ratio`` = mean depth over the sample's base/size; doubled on a male X.

    The totals are a row per sample and broadcast: a shuffle by sample would have as many
    parts as there are samples, each as large as a sample's bins.
    """
    total = bins.groupBy("sample").agg((F.sum("base") / F.sum("size")).alias("_mean"))
    share = ratio(F.col("mean_depth"), F.col("_mean"))
    return bins.join(F.broadcast(total), "sample").select(
        *bins.columns, F.when(_male_x(), share * 2).otherwise(share).alias("ratio")
    )


def _line_fitter(fraction: float):
    """Function of one sample's (gc, n, w, wy) sums → fitted value per gc.

    Nested so that it travels to the workers by value.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("gc")
        x, n = pdf["gc"].to_numpy(), pdf["n"].to_numpy()
        w, wy = pdf["w"].to_numpy(), pdf["wy"].to_numpy()
        dist = np.abs(x[:, None] - x[None, :])
        order = np.argsort(dist, axis=1, kind="stable")
        reach = np.cumsum(n[order], axis=1) >= max(int(fraction * n.sum() + 1e-10), 1)
        nth = np.argmax(reach, axis=1)
        radius = np.take_along_axis(dist, order, axis=1)[np.arange(len(x)), nth][:, None]
        scaled = dist / np.where(radius > 0, radius, 1.0)
        tricube = np.where(radius > 0, np.clip(1 - scaled**3, 0, None) ** 3, dist == 0)
        sw, sy = tricube * w, tricube * wy
        total = sw.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            mx, my = (sw * x).sum(axis=1) / total, sy.sum(axis=1) / total
            sxx = (sw * (x - mx[:, None]) ** 2).sum(axis=1)
            sxy = (sy * (x - mx[:, None])).sum(axis=1)
            slope = np.where(sxx > 1e-12, sxy / sxx, 0.0)
        return pd.DataFrame({"sample": pdf["sample"], "gc": x, "fit": my + slope * (x - mx)})

    return fit


def gc_correct(
    bins: DataFrame,
    variant: str = "windows",
    *,
    keys: Sequence[str] = ("chrom", "start", "stop"),
    fraction: float = 2 / 3,
    passes: int = 3,
) -> DataFrame:
    """Add ``lowess`` and ``ratio_gc_fix`` = ratio over a robust local fit on GC.

    GC has three digits, so a sample has at most 1,001 distinct values however many
    bins it has: rows are summed per (sample, gc) and only those sums reach the
    fit.  A robust pass joins the fit back, takes the exact median residual and sums
    bisquare-weighted rows again.  Rows outside the fit take the value at their own
    gc, else the next higher, else the next lower, else 1.  ``variant``: windows
    also bounds the ratio to (0.1, 5); exons does not.
    """
    r = F.col("ratio")
    rows = bins.withColumn("gc", round_even(F.col("gc"), 3))
    use = (F.col("mean_depth") > 10) & (F.col("size") > 20) & (F.col("gc") > 0.2) & (F.col("gc") < 0.8)
    if variant == "windows":
        use = use & (r > 0.1) & (r < 5)
    elif variant != "exons":
        raise ValueError(f"unknown variant: {variant}")
    usable = rows.where(use).select("sample", "gc", F.col("ratio").alias("y"))
    edges = exact_quantiles(usable, ["sample"], "y", {"lo": 0.05, "hi": 0.95})
    fitting = cut(
        usable.join(edges, "sample").where((F.col("y") > F.col("lo")) & (F.col("y") < F.col("hi"))).drop("lo", "hi")
    )

    weighted = fitting.withColumn("rw", F.lit(1.0))
    fits = None
    for step in range(passes + 1):
        sums = weighted.groupBy("sample", "gc").agg(
            F.count(F.lit(1)).alias("n"), F.sum("rw").alias("w"), F.sum(F.col("rw") * F.col("y")).alias("wy")
        )
        fits = cut(sums.groupBy("sample").applyInPandas(_line_fitter(fraction), "sample string, gc double, fit double"))
        if step == passes:
            break
        away = fitting.join(fits, ["sample", "gc"]).withColumn("a", F.abs(F.col("y") - F.col("fit")))
        mad = exact_quantiles(away, ["sample"], "a", {"mad": 0.5})
        u = F.col("a") / (6 * F.col("mad"))
        weight = F.when(F.col("mad") == 0, (F.col("a") == 0).cast("double")).when(
            u < 1, F.pow(1 - u * u, 2)
        ).otherwise(0.0)
        weighted = away.join(mad, "sample").select("sample", "gc", "y", weight.alias("rw"))

    # at most 1,001 rows per sample
    grid = rows.select("sample", "gc").distinct().join(fits, ["sample", "gc"], "left")
    by_gc = Window.partitionBy("sample").orderBy("gc")
    above = F.first("fit", ignorenulls=True).over(by_gc.rowsBetween(0, Window.unboundedFollowing))
    below = F.last("fit", ignorenulls=True).over(by_gc.rowsBetween(Window.unboundedPreceding, 0))
    filled = grid.select("sample", "gc", F.coalesce(above, below, F.lit(1.0)).alias("lowess"))
    return rows.join(filled, ["sample", "gc"], "left").select(
        *bins.columns,
        F.coalesce("lowess", F.lit(1.0)).alias("lowess"),
        (r / F.coalesce("lowess", F.lit(1.0))).alias("ratio_gc_fix"),
    )


def batch_correct(
    bins: DataFrame,
    controls: DataFrame | None = None,
    *,
    keys: Sequence[str] = ("chrom", "start", "stop"),
    sex_matched: bool = False,
    min_same_sex: int = 10,
) -> DataFrame:
    """Divide by the per-bin median over samples and controls; a zero median is 1.

    With ``sex_matched`` a sex with at least ``min_same_sex`` samples has its own
    reference line.
    """
    keys = list(keys)
    cols = [*keys, "sample", "gender", "ratio_gc_fix"]
    pool = bins.select(*cols)
    if controls is not None:
        pool = pool.unionByName(controls.select(*cols))
    line = exact_quantiles(pool, keys, "ratio_gc_fix", {"ratio_control": 0.5})
    out = bins.join(line, keys, "left")
    if sex_matched:
        own = exact_quantiles(pool, [*keys, "gender"], "ratio_gc_fix", {"_own": 0.5})
        people = pool.select("sample", "gender").distinct().groupBy("gender").agg(F.count(F.lit(1)).alias("_n"))
        # a row per sex: a shuffle by sex would have one task for each
        out = out.join(own, [*keys, "gender"], "left").join(F.broadcast(people), "gender", "left")
        out = out.withColumn(
            "ratio_control", F.when(F.col("_n") >= min_same_sex, F.col("_own")).otherwise(F.col("ratio_control"))
        ).drop("_own", "_n")
    control = F.when(F.col("ratio_control") == 0, 1.0).otherwise(F.col("ratio_control"))
    return out.withColumn("ratio_control", control).select(
        *bins.columns, "ratio_control", (F.col("ratio_gc_fix") / F.col("ratio_control")).alias("ratio_batch_fix")
    )


def clamp_log2(value) -> Column:
    """log2 of the ratio held inside [1/16, 16]."""
    return F.log2(F.greatest(F.lit(0.0625), F.least(F.lit(16.0), col(value))))


def cv(bins: DataFrame, value: str = "ratio_batch_fix", variant: str = "windows", low: float = 0.75, up: float = 1.3, share: float = 0.95) -> DataFrame:
    """Coefficient of variation per sample.

    windows: values in (0.3, 4), 3 digits, 0 on a zero mean.  exons: values over
    ``low``; those under ``up`` alone when they are at least ``share`` of them.
    """
    x = F.col(value)

    def stat(cond: Column | None) -> Column:
        v = x if cond is None else F.when(cond, x)
        return ratio(F.stddev_samp(v), F.avg(v))

    if variant == "windows":
        inside = (x > 0.3) & (x < 4)
        return bins.groupBy("sample").agg(F.coalesce(round_even(stat(inside), 3), F.lit(0.0)).alias("cv"))
    over = x > low
    normal = over & (x < up)
    n_over = F.sum(over.cast("long"))
    n_normal = F.sum(normal.cast("long"))
    return bins.groupBy("sample").agg(
        F.when(n_over == 0, F.coalesce(stat(None), F.lit(0.0)))
        .when(n_normal / n_over >= share, stat(normal))
        .otherwise(stat(over))
        .alias("cv")
    )


def smooth_outliers(
    bins: DataFrame,
    value: str = "log2ratio",
    *,
    region: int = 10,
    outlier: float = 4.0,
    shrink: float = 2.0,
    keys: Sequence[str] = ("sample", "chrom"),
    block: int = 4096,
) -> DataFrame:
    """Pull single spikes towards their neighbours before segmentation.

    A value farther than ``outlier`` standard deviations above (below) all of the
    ``region`` values on either side becomes their median plus (minus) ``shrink``
    deviations.  The deviation is that of the steps between neighbours.  Rows are
    numbered and cut into blocks that share ``region`` rows with the next, so a long
    series spreads over many tasks; rows without a value or a place stay as they are.
    """
    keys = list(keys)
    x = F.col(value).cast("double")
    placed = bins.where(x.isNotNull())
    near = running(
        placed.withColumn("_x", x), keys, "start", sums={"_i": F.lit(1)}, lags={"_prev": F.col("_x")}, keep_unknown=True
    )
    step = F.col("_x") - F.col("_prev")
    noise = near.groupBy(*keys).agg(F.sqrt(F.avg(step * step) / 2).alias("_sd"))
    own = F.floor(F.col("_i") / block)
    blocks = F.array_distinct(F.array(own, F.floor((F.col("_i") - region) / block), F.floor((F.col("_i") + region) / block)))
    spread = near.where("_i is not null").join(noise, keys).withColumn("_own", own).withColumn("_b", F.explode(blocks))
    over = Window.partitionBy(*keys, "_b").orderBy("_i")
    left, right = over.rowsBetween(-region, -1), over.rowsBetween(1, region)
    high = F.greatest(F.max("_x").over(left), F.max("_x").over(right))
    low = F.least(F.min("_x").over(left), F.min("_x").over(right))
    spread = spread.withColumn("_high", high).withColumn("_low", low)
    spread = spread.withColumn("_all", F.array_sort(F.collect_list("_x").over(over.rowsBetween(-region, region))))
    n = F.size("_all")
    middle = (F.get("_all", F.floor((n - 1) / 2).cast("int")) + F.get("_all", F.floor(n / 2).cast("int"))) / 2
    sd = F.col("_sd")
    smooth = (
        F.when(F.col("_x") > F.col("_high") + outlier * sd, middle + shrink * sd)
        .when(F.col("_x") < F.col("_low") - outlier * sd, middle - shrink * sd)
        .otherwise(F.col("_x"))
    )
    done = spread.withColumn(value, smooth).where("_b = _own").select(*bins.columns)
    rest = near.where("_i is null").select(*bins.columns).unionByName(bins.where(x.isNull()))
    return done.unionByName(rest.withColumn(value, x).select(*bins.columns))


def segment(
    bins: DataFrame,
    value: str = "log2ratio",
    *,
    alpha: float = 0.01,
    min_width: int = 2,
    keys: Sequence[str] = ("sample", "chrom"),
    permuted: int = PERMUTED,
) -> DataFrame:
    """Circular binary segmentation, all series and segments at once per round.

    Each segment is searched for the arc whose mean differs most, by the statistic
    normalised by arc length over all arcs (``operators/arcs.py``).  Up to ``permuted`` rows
    its p-value comes from permutations of the segment, which stop early, beyond from the
    tail of the maximum over noise.  An arc under ``alpha`` splits its segment into up to
    three; a cut closer than ``min_width`` to an end moves there.  A round's state is
    checkpointed, long segments are handled in blocks.  Rounds go on until no segment
    splits; a split makes its segment shorter, so they end.

    Returns (keys, start, last_start, num_mark, seg_mean, bstat, pval): ``bstat`` is the
    difference of means between a segment and the next one of its series over its standard
    error, ``pval`` the chance of a single change as large in their rows, null at the end.
    Rows without a value are left out.
    """
    keys = list(keys)
    base = bins.where(F.col(value).isNotNull()).select(*keys, "start", F.col(value).cast("double").alias("x"))
    near = running(base, keys, "start", sums={"i": F.lit(1), "s": F.col("x")})
    rows = cut(near.select(*keys, "start", "x", "i", "s", F.lit(1).cast("long").alias("seg"), F.lit(True).alias("open")))
    seg, done = [*keys, "seg"], []
    while True:
        live = rows.where("open")
        stats = live.groupBy(*seg).agg(
            F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.min_by(F.col("s") - F.col("x"), "i").alias("s0"),
            F.var_pop("x").alias("var"),
        )
        j = F.col("i") - F.col("seg") + 1
        placed = live.join(stats, seg).select(
            *seg, "x", j.alias("j"), (F.col("s") - F.col("s0") - j * F.col("mean")).alias("b"), "n", (F.col("var") * F.col("n")).alias("tss"))
        arcs = best_arcs(placed, seg, "x", "j", min_width, alpha, permuted)
        last = F.col("seg") + F.col("n") - 1
        first_cut = F.when(F.col("j1") < min_width, F.col("seg") - 1).otherwise(F.col("seg") + F.col("j1") - 1)
        second_cut = F.when(F.col("n") - F.col("j2") < min_width, last).otherwise(F.col("seg") + F.col("j2") - 1)
        arcs = arcs.where(F.col("p") < alpha).select(*seg, first_cut.alias("c1"), second_cut.alias("c2"), last.alias("last"))
        arcs = arcs.where(~((F.col("c1") < F.col("seg")) & (F.col("c2") >= F.col("last"))))
        begin = (
            F.when(F.col("i") > F.col("c2"), F.col("c2") + 1)
            .when(F.col("i") > F.col("c1"), F.col("c1") + 1)
            .otherwise(F.col("seg"))
        )
        rows = cut(live.join(arcs, seg, "left").select(
            *keys, "start", "x", "i", "s", F.coalesce(begin, "seg").alias("seg"), F.col("c1").isNotNull().alias("open")))
        done.append(rows.where(~F.col("open")))
        if rows.where("open").limit(1).count() == 0:
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = out.groupBy(*seg).agg(
        F.min("start").alias("start"), F.max("start").alias("last_start"), F.count(F.lit(1)).alias("num_mark"), F.avg("x").alias("seg_mean"),
        F.var_pop("x").alias("_var"),
    )
    following = Window.partitionBy(*keys).orderBy("seg")  # a row for each segment of a series
    n1, n2 = F.col("num_mark"), F.lead("num_mark").over(following)
    square = F.pow(F.col("seg_mean") - F.lead("seg_mean").over(following), 2) * n1 * n2 / (n1 + n2)
    within = n1 * F.col("_var") + n2 * F.lead("_var").over(following)
    out = out.withColumns({"_n": n1 + n2, "_stat": square, "_tss": within + square})

    @F.pandas_udf("double")
    def tail(b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(m) else change_tail(float(x), int(m), min_width) for x, m in zip(b, n)], dtype=float)

    out = out.withColumn("bstat", F.when(F.col("_n").isNotNull(), student("_stat", "_tss", "_n")))
    return out.withColumn("pval", tail("bstat", "_n")).select(*keys, "start", "last_start", "num_mark", "seg_mean", "bstat", "pval")


def spread_segments(bins: DataFrame, segs: DataFrame, keys: Sequence[str] = ("sample", "chrom")) -> DataFrame:
    """Segment mean on every bin (filled along each contig) and 2 to its power."""
    starts = segs.select(*keys, "start", F.col("seg_mean").alias("_mean"))
    joined = bins.join(starts, [*keys, "start"], "left")
    filled = running(joined, keys, "start", fills={"seg_mean": F.col("_mean")}, keep_unknown=True)
    return filled.select(*bins.columns, "seg_mean", F.pow(F.lit(2.0), F.col("seg_mean")).alias("copy_ratio"))


def call_copy_number(df: DataFrame, value: str, conf: CopyConf = CopyConf()) -> DataFrame:
    """Add copy_num and type; a male X has its own limits, which win."""
    x = F.col(value)
    male = _male_x()
    male_num = F.when(x > conf.dup_male_x, 2).when(x <= conf.del_male_x, 0).otherwise(1)
    male_type = F.when(x > conf.dup_male_x, "DUP").when(x <= conf.del_male_x, "DEL").otherwise("NORMAL")
    num = F.when(x < conf.hom_del, 0).when(x <= conf.del_, 1).when(x > conf.dup, 3).otherwise(2)
    kind = F.when(x <= conf.del_, "DEL").when(x > conf.dup, "DUP").otherwise("NORMAL")
    return df.withColumn("copy_num", F.when(male, male_num).otherwise(num)).withColumn(
        "type", F.when(male, male_type).otherwise(kind)
    )


# Exon rows of one gene in one sample number a few hundred at most (one row per
# exon), so the windows below hold bounded groups.
_GENE = ("sample", "gene")


def _exons() -> Window:
    return Window.partitionBy(*_GENE).orderBy("number")


def _yes(cond: Column, old: Column | None = None) -> Column:
    cond = F.coalesce(cond, F.lit(False))
    return F.when(cond, "Yes").otherwise(F.lit("No") if old is None else old)


def flag_runs(exons: DataFrame) -> DataFrame:
    """continuously = Yes where a DEL/DUP has an equal neighbour."""
    w = _exons()
    same = F.coalesce(F.lag("type").over(w) == F.col("type"), F.lit(False)) | F.coalesce(
        F.lead("type").over(w) == F.col("type"), F.lit(False)
    )
    return exons.withColumn("continuously", _yes(F.col("type").isin("DEL", "DUP") & same))


def bridge_gaps(exons: DataFrame, value: str = "ratio_batch_fix", conf: CopyConf = CopyConf()) -> DataFrame:
    """A NORMAL exon near a limit between two equal DEL/DUP exons joins them."""
    w = _exons()
    x = F.col(value)
    male = F.col("gender") == "M"
    low = F.when(male, conf.del_male_x).otherwise(conf.del_)
    high = F.when(male, conf.dup_male_x).otherwise(conf.dup)
    near = (F.abs(x - low) < conf.nearby_distance) | (F.abs(x - high) < conf.nearby_distance)
    prev, nxt = F.lag("type").over(w), F.lead("type").over(w)
    bridged = F.coalesce(
        (F.col("type") == "NORMAL") & near & (prev == nxt) & prev.isin("DEL", "DUP"), F.lit(False)
    )
    df = exons.withColumn("_bridged", bridged).withColumn("_side", prev)
    touched = F.col("_bridged") | F.coalesce(F.lag("_bridged").over(w), F.lit(False)) | F.coalesce(
        F.lead("_bridged").over(w), F.lit(False)
    )
    return (
        df.withColumn("continuously", _yes(touched, F.col("continuously")))
        .withColumn("type", F.when(F.col("_bridged"), F.col("_side")).otherwise(F.col("type")))
        .drop("_bridged", "_side")
    )


def recall_near_threshold(exons: DataFrame, value: str = "ratio_batch_fix", conf: CopyConf = CopyConf()) -> DataFrame:
    """NORMAL runs just under the gain limit that touch a DUP become DUP.

    Only in quiet (cv) female samples.  A run between two DUPs belongs to the left.
    """
    w = _exons()
    eligible = (
        (F.col("type") == "NORMAL")
        & (F.abs(F.lit(conf.dup) - F.col(value)) < conf.nearby_recall_distance)
        & (F.col("cv") < conf.nice_cv)
        & (F.col("gender") != "M")
    )
    df = exons.withColumn("_elig", F.coalesce(eligible, F.lit(False)))
    outside = F.when(~F.col("_elig"), F.col("type"))
    before = Window.unboundedPreceding, -1
    left = F.last(outside, ignorenulls=True).over(w.rowsBetween(*before))
    # from the end backwards: a frame to the end would be gone through again for every row
    right = F.last(outside, ignorenulls=True).over(Window.partitionBy(*_GENE).orderBy(F.desc("number")).rowsBetween(*before))
    df = df.withColumn("_left", left).withColumn("_right", right)
    recalled = F.col("_elig") & (
        F.coalesce(F.col("_left") == "DUP", F.lit(False)) | F.coalesce(F.col("_right") == "DUP", F.lit(False))
    )
    quiet = (F.col("cv") < conf.nice_cv) & (F.col("gender") != "M")
    claims = F.coalesce(F.lead("_elig").over(w), F.lit(False)) | (
        F.coalesce(F.lag("_elig").over(w), F.lit(False))
        & ~F.coalesce(F.lag("_left").over(w) == "DUP", F.lit(False))
    )
    df = df.withColumn("_claims", quiet & (F.col("type") == "DUP") & claims)
    return (
        df.withColumn("continuously", _yes(recalled | F.col("_claims"), F.col("continuously")))
        .withColumn("type", F.when(recalled, "DUP").otherwise(F.col("type")))
        .drop("_elig", "_left", "_right", "_claims")
    )


def drop_weak_singletons(exons: DataFrame, value: str = "ratio_batch_fix", conf: CopyConf = CopyConf()) -> DataFrame:
    """A lone DEL or DUP that is not clear enough becomes NORMAL with two copies."""
    x = F.col(value)
    weak = ((F.col("type") == "DEL") & (x > conf.del_single)) | ((F.col("type") == "DUP") & (x < conf.dup_single))
    weak = weak & (F.col("continuously") == "No") & ~_male_x()
    return exons.withColumn("copy_num", F.when(weak, 2).otherwise(F.col("copy_num"))).withColumn(
        "type", F.when(weak, "NORMAL").otherwise(F.col("type"))
    )


def repair_calls(exons: DataFrame, value: str = "ratio_batch_fix", conf: CopyConf = CopyConf()) -> DataFrame:
    """flag_runs, bridge_gaps, recall_near_threshold, drop_weak_singletons in turn."""
    df = bridge_gaps(flag_runs(exons), value, conf)
    return drop_weak_singletons(recall_near_threshold(df, value, conf), value, conf)


def exon_number(cds) -> Column:
    """First digits of the coding exon label."""
    return F.regexp_extract(col(cds), r"(\d+)", 1).cast("int")


def gene_depth_profile(
    reads: DataFrame, genes: DataFrame, means: DataFrame, samples: Sequence[str], digits: int = 3
) -> DataFrame:
    """Depth of each base of the genes over the sample's mean depth.

    ``genes`` (chrom, start, stop) half-open; ``means`` (sample, mean_depth).  Rows
    (sample, chrom, pos 1-based, ratio) for the gene bases only, zeros included.
    """
    keys = ["sample", "chrom"]
    spans = genes.select(
        "chrom", "start", "stop", F.explode(F.array(*[F.lit(s) for s in samples])).alias("sample")
    )
    runs = sweep({"depth": reads.select(*keys, "start", "stop"), "gene": spans}, keys)
    inside = runs.where((F.col("gene") > 0) & F.col("stop").isNotNull())
    scaled = inside.join(means, "sample").withColumn(
        "ratio", round_even(ratio(F.col("depth"), F.col("mean_depth")), digits)
    )
    return scaled.select(*keys, F.explode(F.sequence(F.col("start") + 1, F.col("stop"))).alias("pos"), "ratio")


def median_fix(profile: DataFrame, digits: int | None = 3) -> DataFrame:
    """Add ``ratio_fix``: the ratio over the batch median at the same base."""
    line = exact_quantiles(profile, ["chrom", "pos"], "ratio", {"_median": 0.5})
    return profile.join(line, ["chrom", "pos"]).select(
        *profile.columns, ratio(F.col("ratio"), F.col("_median"), digits).alias("ratio_fix")
    )


def region_copy_ratio(profile: DataFrame, features: DataFrame, value: str = "ratio") -> DataFrame:
    """Median and inter-quartile mean of a profile inside features (1-based closed)."""
    spots = profile.withColumn("start", F.col("pos") - 1).withColumn("stop", F.col("pos"))
    zero_based = features.select("chrom", (F.col("start") - 1).alias("start"), "stop")
    inside = overlap_join(spots, zero_based, long_intervals=False).select("sample", value)
    edges = exact_quantiles(inside, ["sample"], value, {"median": 0.5, "q25": 0.25, "q75": 0.75})
    x = F.col(value)
    trimmed = inside.join(edges, "sample").where((x >= F.col("q25")) & (x <= F.col("q75")))
    center = trimmed.groupBy("sample").agg(round_even(F.avg(x), 3).alias("kmeans"))
    return edges.join(center, "sample", "left").select(
        "sample", round_even(F.col("median"), 3).alias("median"), "kmeans"
    )


def ratio_to_bins(value, bins: Sequence[tuple[float, float]] = COPY_BINS) -> Column:
    """Row number of the half-open class; over the last class one more."""
    x = col(value)
    out = F.when(x >= bins[-1][1], len(bins))
    for i, (low, high) in enumerate(bins):
        out = out.when((x >= low) & (x < high), i)
    return out
