"""Read depth, breadth and read statistics, built on the event sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import q, ratio, round_even
from strandwise.functions.running import BLOCK, running, sweep
from strandwise.functions.stages import cut
from strandwise.operators.intervals import count_overlaps_of, flank_segments, merge_intervals, overlap_join

# Alignment flag bits and the insert size cap.
UNMAPPED, MATE_UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 4, 8, 256, 512, 1024, 2048
MAX_INSERT = 2000
CUTOFFS = (1, 4, 10, 20)
TARGET_BIN = 256  # targets are short and dense, so a cell holds few of them


def _flag(bit: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(bit)) != 0


def base_depth(reads: DataFrame, keys: Sequence[str] = ("chrom",), block: int = BLOCK) -> DataFrame:
    """Run-length depth (keys, start, stop, depth) between the first and last base.

    Neighbouring runs always differ in depth; reads are never exploded to bases.
    """
    return sweep({"depth": reads}, keys, block=block).where(F.col("stop").isNotNull())


def bedgraph(reads: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Covered runs only."""
    return base_depth(reads, keys).where("depth > 0")


def region_coverage(
    reads: DataFrame,
    regions: DataFrame,
    cutoffs: Sequence[int] = CUTOFFS,
    *,
    sample: str | None = None,
    samples: Sequence[str] | None = None,
) -> DataFrame:
    """Reads, bases and breadth of every region, with and without duplicates.

    The sweep turns reads into cumulative counts of starts, stops, bases and bases
    at each depth cutoff; a region's value is the difference of two look-ups at its
    ends.  No read x region pair exists, a region without reads yields zeros, and
    depth pile-ups cost nothing extra.  With ``sample`` the counts are per sample of
    the given sheet ``samples``.
    """
    keys = [sample, "chrom"] if sample else ["chrom"]
    if sample:
        if not samples:
            raise ValueError("per-sample coverage needs the list of samples")
        regions = regions.withColumn(
            sample, F.explode(F.array(*[F.lit(s) for s in samples]))
        )
    begins = ["s_uni", "e_uni", "s_dup", "e_dup"]
    dup = F.col("is_dup").cast("int")
    zero = F.lit(0)
    events = (
        reads.where("start < stop")
        .select(
            *keys,
            F.explode(
                F.array(
                    F.struct(
                        F.col("start").alias("pos"),
                        (1 - dup).alias("s_uni"), zero.alias("e_uni"),
                        dup.alias("s_dup"), zero.alias("e_dup"),
                    ),
                    F.struct(
                        F.col("stop").alias("pos"),
                        zero.alias("s_uni"), (1 - dup).alias("e_uni"),
                        zero.alias("s_dup"), dup.alias("e_dup"),
                    ),
                )
            ).alias("e"),
        )
        .select(*keys, "e.*")
    )
    marks = regions.select(
        *keys, F.explode(F.array("start", "stop")).alias("pos"), *[zero.alias(n) for n in begins]
    )
    points = events.unionByName(marks).groupBy(*keys, "pos").agg(*[F.sum(n).alias(n) for n in begins])
    points = running(
        points,
        keys,
        "pos",
        sums={f"c_{n}": F.col(n) for n in begins},
        lags={"_prev": F.col("pos")},
        keep_block=True,
    )
    # depth on the run that ends at this position = starts - stops before it
    span = F.coalesce(F.col("pos") - F.col("_prev"), F.lit(0))
    uni = (F.col("c_s_uni") - F.col("s_uni")) - (F.col("c_e_uni") - F.col("e_uni"))
    dups = (F.col("c_s_dup") - F.col("s_dup")) - (F.col("c_e_dup") - F.col("e_dup"))
    sums = {"a_uni": uni * span, "a_dup": dups * span}
    for c in cutoffs:
        sums[f"a_{c}"] = F.when(uni >= c, span).otherwise(0)
    points = running(points, keys, "pos", sums=sums)
    cum = {
        "b_uni": F.col("c_s_uni") - F.col("s_uni"),  # starts strictly before
        "b_dup": F.col("c_s_dup") - F.col("s_dup"),
        "f_uni": F.col("c_e_uni"),  # stops up to here
        "f_dup": F.col("c_e_dup"),
        **{n: F.col(n) for n in sums},
    }
    at = points.select(*keys, "pos", *[c.alias(n) for n, c in cum.items()])
    # Each distinct span looks its two ends up in one join and is put together by a
    # small aggregation, so that the sweep is planned once.  Spark's size estimate leaves
    # out what an explode adds (samples, ends), so the joins are told not to broadcast.
    spans = regions.select(*keys, "start", "stop").distinct()
    ends = spans.withColumn(
        "_end",
        F.explode(
            F.array(
                F.struct(F.col("start").alias("pos"), F.lit(-1).alias("sign")),
                F.struct(F.col("stop").alias("pos"), F.lit(1).alias("sign")),
            )
        ),
    ).select(*keys, "start", "stop", "_end.pos", "_end.sign")
    upper, lower = F.col("sign") > 0, F.col("sign") < 0
    looked = ends.hint("merge").join(at, [*keys, "pos"]).groupBy(*keys, "start", "stop").agg(
        F.sum(F.when(upper, F.col("b_uni")).when(lower, -F.col("f_uni"))).alias("r_uni"),
        F.sum(F.when(upper, F.col("b_dup")).when(lower, -F.col("f_dup"))).alias("r_dup"),
        *[F.sum(F.col("sign") * F.col(n)).alias(n) for n in sums],
    )
    both = regions.hint("merge").join(looked, [*keys, "start", "stop"])

    def gain(n: str) -> Column:
        return F.col(n).cast("long")

    return both.select(
        *regions.columns,
        (F.col("stop") - F.col("start")).alias("size"),
        gain("r_uni").alias("reads_on_target(rm_dup)"),
        gain("r_dup").alias("reads_on_target(dup)"),
        gain("a_uni").alias("base_on_target(rm_dup)"),
        gain("a_dup").alias("base_on_target(dup)"),
        *[gain(f"a_{c}").alias(f"coverage>={c}(rm_dup)") for c in cutoffs],
    )


def region_depth(reads: DataFrame, regions: DataFrame, **by) -> DataFrame:
    """Bases, mean depth and covered fraction per region; duplicates left out."""
    cov = region_coverage(reads, regions, (1,), **by)
    return cov.select(
        *[c for c in cov.columns if "(" not in c],
        q("base_on_target(rm_dup)").alias("base"),
        (q("base_on_target(rm_dup)") / F.col("size")).alias("mean_depth"),
        (q("coverage>=1(rm_dup)") / F.col("size")).alias("coverage"),
    )


def interval_mean_depth(reads: DataFrame, intervals: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean depth of given intervals."""
    out = region_depth(reads, intervals).drop("base", "coverage", "size")
    return out if digits is None else out.withColumn("mean_depth", round_even(F.col("mean_depth"), digits))


def contig_class(chrom: Column) -> Column:
    """Alternate contigs pooled as Unlocalized, Decoy or Unplaced."""
    return (
        F.when(chrom.rlike("_random$"), "Unlocalized")
        .when(chrom.rlike("_decoy$"), "Decoy")
        .when(chrom.rlike("^chrUn_"), "Unplaced")
        .otherwise(chrom)
    )


def on_off_target(depth: DataFrame, targets: DataFrame) -> DataFrame:
    """Bases on and off target per contig class and their share of all bases.

    ``depth`` is a bedgraph.  One sweep carries depth and target cover together.
    """
    runs = sweep(
        {"depth": depth, "target": targets.select("chrom", "start", "stop")},
        weights={"depth": F.col("depth").cast("long")},
    ).where(F.col("stop").isNotNull() & (F.col("depth") > 0))
    base = F.col("depth") * (F.col("stop") - F.col("start"))
    per = runs.groupBy(contig_class(F.col("chrom")).alias("chromosome")).agg(
        F.sum(base).alias("base"),
        F.sum(F.when(F.col("target") > 0, 0).otherwise(base)).alias("offtarget"),
    )
    # the contig classes number a few dozen whatever the data
    total = per.agg(F.sum("base").alias("all_base"))
    return (
        per.crossJoin(F.broadcast(total))
        .withColumn("ontarget", F.col("base") - F.col("offtarget"))
        .select(
            "chromosome",
            "base",
            "offtarget",
            "ontarget",
            "all_base",
            ratio(F.col("base"), F.col("all_base")).alias("base_rate"),
            ratio(F.col("offtarget"), F.col("all_base")).alias("offtarget_rate"),
            ratio(F.col("ontarget"), F.col("all_base")).alias("ontarget_rate"),
        )
    )


def on_off_target_long(table: DataFrame) -> DataFrame:
    """(chromosome, rate, target) rows: off and on for each contig class."""
    return table.selectExpr(
        "chromosome", "stack(2, 'off', offtarget_rate, 'on', ontarget_rate) as (target, rate)"
    )


def mapped_length(cigar: Column) -> Column:
    """Reference bases under a read: aligned plus deleted."""
    sizes = F.regexp_extract_all(cigar, F.lit("(\\d+)[MD]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def read_stats(reads: DataFrame) -> DataFrame:
    """Totals and rates over all primary alignments: one aggregation, no shuffle of rows.

    ``reads`` has SAM columns flag, cigar, seq, md.
    """
    primary = reads.where(~_flag(SECONDARY) & ~_flag(SUPPLEMENTARY))
    mapped = ~_flag(UNMAPPED)
    length = mapped_length(F.col("cigar"))
    md = F.regexp_replace(F.coalesce("md", F.lit("")), "(?i)\\^[ACGT]+", "")

    def total(cond: Column, value: Column | int = 1) -> Column:
        return F.sum(F.when(cond, value).otherwise(0))

    def letters(which: str) -> Column:
        return F.length(F.regexp_replace("seq", f"[^{which}]", ""))

    sums = primary.agg(
        F.count(F.lit(1)).alias("total_reads"),
        F.max(F.length("seq")).alias("max_len"),
        total(mapped).alias("mapped_reads"),
        total(mapped & _flag(DUPLICATE)).alias("duplicate_reads"),
        total(mapped & ~_flag(MATE_UNMAPPED)).alias("pair_mapped_reads"),
        total(mapped & F.col("cigar").rlike("[ID]")).alias("indel_reads"),
        total(mapped & md.rlike("[ACGTacgt]")).alias("mismatch_reads"),
        total(mapped, length).alias("mapped_bases"),
        total(mapped & ~_flag(DUPLICATE), length).alias("mapped_bases_rmdup"),
        total(mapped, letters("GCgc")).alias("gc_bases"),
        total(mapped, letters("ATat")).alias("at_bases"),
        total(mapped, letters("Nn")).alias("n_bases"),
    )
    c = F.col
    return sums.select(
        "*",
        (c("total_reads") * c("max_len")).alias("all_bases"),
        ratio(c("gc_bases") * 100, c("mapped_bases")).alias("gc_rate"),
        ratio(c("mapped_reads") * 100, c("total_reads")).alias("mapping_rate"),
        ratio(c("duplicate_reads") * 100, c("mapped_reads")).alias("duplication_rate"),
        ratio(c("mismatch_reads") * 100, c("mapped_reads")).alias("mismatch_rate"),
        ratio(c("indel_reads") * 100, c("mapped_reads")).alias("indel_rate"),
    )


def capture_metrics(
    reads: DataFrame,
    targets: DataFrame,
    chrom_len: DataFrame | None = None,
    flank: int = 0,
    cutoffs: Sequence[int] = CUTOFFS,
) -> DataFrame:
    """Capture report: specificity, efficiency, use rate, breadth with and without duplicates.

    ``reads`` are mapped primary alignments (chrom, start, stop, is_dup, length) with
    ``length`` the read's own length.
    """
    merged = cut(merge_intervals(targets.select("chrom", "start", "stop")))
    layers = {
        "depth": reads,
        "unique": reads,
        "target": merged,
    }
    unique = {"unique": F.when(~F.col("is_dup"), F.lit(1)).otherwise(0).cast("long")}
    if flank:
        layers["flank"] = cut(flank_segments(merged, flank, chrom_len))
    runs = sweep(layers, weights=unique).where(F.col("stop").isNotNull())
    size = F.col("stop") - F.col("start")

    def inside(cond: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, value).otherwise(0)), F.lit(0))

    on = F.col("target") > 0
    aggs = [
        inside(on, size).alias("target_size"),
        inside(on, size * F.col("depth")).alias("target_bases"),
        inside(on, size * F.col("unique")).alias("target_bases_rmdup"),
    ]
    for c in cutoffs:
        aggs.append(inside(on & (F.col("depth") >= c), size).alias(f"n_{c}"))
        aggs.append(inside(on & (F.col("unique") >= c), size).alias(f"u_{c}"))
    if flank:
        near = on | (F.col("flank") > 0)
        aggs.append(inside(near, size).alias("flanking_size"))
        aggs.append(inside(near, size * F.col("unique")).alias("flanking_bases_rmdup"))
        for c in cutoffs:
            aggs.append(inside(near & (F.col("unique") >= c), size).alias(f"f_{c}"))
    on_bases = runs.agg(*aggs)
    length = F.col("stop") - F.col("start")
    totals = reads.agg(
        F.count(F.lit(1)).alias("mapped_reads"),
        inside(~F.col("is_dup"), F.lit(1)).alias("mapped_reads_rmdup"),
        F.sum(length).alias("mapped_bases"),
        inside(~F.col("is_dup"), length).alias("mapped_bases_rmdup"),
        (F.count(F.lit(1)) * F.max("length")).alias("all_bases"),
    )
    # reads go to the targets of their cell in one shuffle; targets in cells are more than Spark's size check knows
    lean = reads.select("chrom", "start", "stop", "is_dup").hint("merge")
    hits = overlap_join(lean, merged, "semi", bin_size=TARGET_BIN).agg(
        F.count(F.lit(1)).alias("target_reads"), inside(~F.col("is_dup"), F.lit(1)).alias("target_reads_rmdup")
    )
    c = F.col
    # one row each; as scalars, what a caller selects nothing from is not computed
    one = on_bases.select("*", *[x.select(F.struct("*")).scalar().alias(n) for n, x in (("_all", totals), ("_hit", hits))])
    one = one.select("*", "_all.*", "_hit.*")
    out = [
        "target_size", "mapped_reads", "mapped_reads_rmdup", "target_reads", "target_reads_rmdup",
        "target_bases", "target_bases_rmdup",
        ratio(c("target_bases_rmdup") * 100, c("all_bases")).alias("use_rate"),
        ratio(c("target_reads") * 100, c("mapped_reads")).alias("specificity"),
        ratio(c("target_reads_rmdup") * 100, c("mapped_reads_rmdup")).alias("specificity_rmdup"),
        ratio(c("target_bases") * 100, c("mapped_bases")).alias("efficiency"),
        ratio(c("target_bases_rmdup") * 100, c("mapped_bases_rmdup")).alias("efficiency_rmdup"),
        ratio(c("target_bases"), c("target_size")).alias("mean_depth"),
        ratio(c("target_bases_rmdup"), c("target_size")).alias("mean_depth_rmdup"),
    ]
    for k in cutoffs:
        out.append(ratio(c(f"n_{k}") * 100, c("target_size")).alias(f"coverage_{k}x"))
        out.append(ratio(c(f"u_{k}") * 100, c("target_size")).alias(f"coverage_{k}x_rmdup"))
    if flank:
        out.append(c("flanking_size"))
        out.append(ratio(c("flanking_bases_rmdup"), c("flanking_size")).alias("flanking_depth_rmdup"))
        for k in cutoffs:
            out.append(ratio(c(f"f_{k}") * 100, c("flanking_size")).alias(f"flanking_{k}x_rmdup"))
    return one.select(*out)


def target_depth_runs(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Depth runs inside the merged targets, zero-depth bases included."""
    runs = sweep({"depth": reads, "target": targets.select("chrom", "start", "stop")})
    return runs.where((F.col("target") > 0) & F.col("stop").isNotNull()).drop("target")


def depth_histogram(depth: DataFrame) -> DataFrame:
    """Bases per depth and at least that depth, with fractions of all bases."""
    per = depth.groupBy("depth").agg(F.sum(F.col("stop") - F.col("start")).alias("n_bases"))
    down = per.withColumn("_down", -F.col("depth"))
    total = per.agg(F.sum("n_bases").alias("_total"))  # one row
    cum = running(
        down.withColumn("_one", F.lit(1)), ["_one"], "_down", 10_000, sums={"n_at_least": F.col("n_bases")}
    ).crossJoin(F.broadcast(total))
    return cum.select(
        "depth",
        "n_bases",
        ratio(F.col("n_bases"), F.col("_total")).alias("fraction"),
        "n_at_least",
        ratio(F.col("n_at_least"), F.col("_total")).alias("fraction_at_least"),
    )


def insert_size_histogram(reads: DataFrame) -> DataFrame:
    """Positive template lengths of mapped primary reads, 2000 and over pooled."""
    primary = reads.where(~_flag(SECONDARY) & ~_flag(SUPPLEMENTARY) & ~_flag(UNMAPPED))
    pairs = primary.agg(F.sum((~_flag(MATE_UNMAPPED)).cast("long")).alias("_pairs"))  # one row
    return (
        primary.where("tlen > 0")
        .groupBy(F.least("tlen", F.lit(MAX_INSERT)).alias("insert_size"))
        .agg(F.count(F.lit(1)).alias("n"))
        .crossJoin(F.broadcast(pairs))
        .select("insert_size", "n", ratio(F.col("n") * 2, F.col("_pairs")).alias("fraction"))
    )


def contig_depth(depth: DataFrame) -> DataFrame:
    """Size, covered fraction (4 digits) and mean depth (2 digits) per contig."""
    size = F.col("stop") - F.col("start")
    return depth.groupBy("chrom").agg(
        F.sum(size).alias("target_size"),
        round_even(F.sum(F.when(F.col("depth") > 0, size).otherwise(0)) / F.sum(size), 4).alias("coverage"),
        round_even(F.sum(size * F.col("depth")) / F.sum(size), 2).alias("depth"),
    )


def classify_reads(reads: DataFrame, targets: DataFrame, flanks: DataFrame) -> DataFrame:
    """Add ``place``: target, flank or other; target wins.  All regions are looked at."""
    hits = count_overlaps_of(reads, {"_t": targets, "_f": flanks})
    return hits.select(
        *reads.columns,
        F.when(F.col("_t") > 0, "target").when(F.col("_f") > 0, "flank").otherwise("other").alias("place"),
    )


def base_composition(bases: DataFrame, site: Sequence[str]) -> DataFrame:
    """A/C/G/T counts and the alternate base's share per site; rows are (site…, ref, alt, base)."""
    counted = bases.groupBy(*site, "ref", "alt").agg(
        *[F.sum((F.col("base") == b).cast("long")).alias(b) for b in "ACGT"]
    )
    n = F.col("A") + F.col("C") + F.col("G") + F.col("T")

    def of(which: str) -> Column:
        out = F.lit(0)
        for b in "ACGT":
            out = F.when(F.col(which) == b, F.col(b)).otherwise(out)
        return out

    return counted.select("*", ratio(of("alt"), n).alias("alt_ratio"), ratio(of("ref"), n).alias("ref_ratio"))


def pooled_alt_ratio(composition: DataFrame, keys: Sequence[str]) -> DataFrame:
    """1 - reference share pooled over several SNPs of one sample."""
    ref = F.lit(0)
    for b in "ACGT":
        ref = F.when(F.col("ref") == b, F.col(b)).otherwise(ref)
    n = F.col("A") + F.col("C") + F.col("G") + F.col("T")
    return composition.groupBy(*keys).agg((1 - F.sum(ref) / F.sum(n)).alias("snp_ratio"))


def side_depth_ratio(depth: DataFrame, sites: DataFrame, window: int = 14, keys: Sequence[str] = ()) -> DataFrame:
    """1 - (bases in the window before a site) / (bases in the window from it on).

    ``depth`` are runs with optional ``keys``; ``sites`` (chrom, pos) is 1-based.
    """
    near = sites.withColumn("start", F.col("pos") - 1 - window).withColumn("stop", F.col("pos") - 1 + window)
    hits = overlap_join(depth, near)
    mid = F.col("pos") - 1

    def part(low: Column, high: Column) -> Column:
        cut = F.least(F.col("stop"), high) - F.greatest(F.col("start"), low)
        return F.sum(F.greatest(cut, F.lit(0)) * F.col("depth"))

    ids = [c for c in sites.columns if c != "chrom"]
    return hits.groupBy(*keys, "chrom", *ids).agg(
        (1 - ratio(part(F.col("b_start"), mid), part(mid, F.col("b_stop")))).alias("depth_ratio")
    )


def clipped_read_ratio(reads: DataFrame, regions: DataFrame, region_key: Sequence[str]) -> DataFrame:
    """Share of soft- or hard-clipped reads per region; dup, QC-fail and unmapped skipped."""
    usable = reads.where(~_flag(DUPLICATE) & ~_flag(QC_FAIL) & ~_flag(UNMAPPED)).select(
        "chrom", "start", "stop", F.col("cigar").rlike("[SH]").cast("int").alias("_clip")
    )
    return (
        overlap_join(usable, regions)
        .groupBy(*region_key)
        .agg(F.count(F.lit(1)).alias("n_reads"), F.avg("_clip").alias("clip_ratio"))
    )
