"""Sample and family quality control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import col, q, ratio, round_even
from strandwise.operators.coverage import CUTOFFS

BREADTH = tuple(f"coverage>={c}(rm_dup)" for c in CUTOFFS)
# The acceptance limits.
EMBRYO_BREADTH, PARENT_BREADTH, MIN_RAW_G, MIN_DEPTH, MALE_Y = 0.7, 0.9, 45, 15, 0.25


def _share(name: str) -> Column:
    return ratio(F.sum(q(name)), F.sum("size"), 4)


def sample_qc(
    coverage: DataFrame,
    fastp: DataFrame | None = None,
    use_mt: bool = False,
    key: str = "sample",
    missing_totals: str = "null",
) -> DataFrame:
    """Genome-wide QC per sample from region coverage and read totals.

    Mapped reads include the mitochondrion; sizes, depth and breadth leave it out
    unless ``use_mt``.  Without read totals the mapped rates are null, or 0 with
    ``missing_totals='zero'`` (linked reads).
    """
    reads, dups = q("reads_on_target(rm_dup)"), q("reads_on_target(dup)")
    mapped = coverage.groupBy(key).agg(F.sum(reads + dups).alias("_all"), F.sum(reads).alias("_uni"))
    kept = coverage if use_mt else coverage.where(~F.col("chromosome").contains("M"))
    stat = kept.groupBy(key).agg(
        F.concat(round_even(F.sum("size") / F.lit(1e6), 0).cast("long"), F.lit("M")).alias("genome_size"),
        ratio(F.sum(dups), F.sum(dups + reads), 4).alias("dup_rate"),
        _share("base_on_target(rm_dup)").alias("mean_depth(rm_dup)"),
        *[_share(b).alias(b) for b in BREADTH],
    )
    out = stat.join(mapped, key)
    if fastp is None:
        totals = out.withColumn("total_reads", F.lit(None).cast("long")).withColumn("raw_bases", F.lit(0))
    else:
        sums = fastp.groupBy(key).agg(
            F.sum("total_reads").alias("total_reads"), F.sum("raw_bases").alias("raw_bases")
        )
        totals = out.join(sums, key, "left")
    rate = ratio(F.col("_all"), F.col("total_reads"), 4)
    rate_uni = ratio(F.col("_uni"), F.col("total_reads"), 4)
    if missing_totals == "zero":
        rate, rate_uni = F.coalesce(rate, F.lit(0.0)), F.coalesce(rate_uni, F.lit(0.0))
    return totals.select(
        key,
        "genome_size",
        F.concat(
            round_even(F.coalesce("raw_bases", F.lit(0)) / F.lit(1e9), 0).cast("long"), F.lit("G")
        ).alias("raw_bases"),
        rate.alias("mapped_rate"),
        rate_uni.alias("mapped_rate(rm_dup)"),
        "dup_rate",
        q("mean_depth(rm_dup)"),
        *[q(b) for b in BREADTH],
    )


def infer_sex(coverage: DataFrame, key: str = "sample") -> DataFrame:
    """Depth of X and Y against the whole nuclear genome; M when Y is over a quarter."""
    base = q("base_on_target(rm_dup)")

    def mean(which: Column) -> Column:
        return ratio(F.sum(F.when(which, base)), F.sum(F.when(which, F.col("size"))))

    chrom = F.col("chromosome")
    df = coverage.groupBy(key).agg(
        round_even(mean(chrom == "chrX"), 4).alias("depX"),
        round_even(mean(chrom == "chrY"), 4).alias("depY"),
        mean(~chrom.contains("M")).alias("_mean"),
    )
    y = ratio(F.col("depY"), F.col("_mean"), 4)
    return df.select(
        key,
        "depX",
        "depY",
        ratio(F.col("depX"), F.col("_mean"), 4).alias("XRatio"),
        y.alias("YRatio"),
        F.when(F.col("_mean") != 0, F.when(y > MALE_Y, "M").otherwise("F")).alias("gender"),
    )


def gene_qc(coverage: DataFrame, key: Sequence[str] = ("sample", "gene")) -> DataFrame:
    """Depth and breadth per gene over known bases; ``coverage`` has ``n_size``."""
    known = F.sum("size") - F.sum("n_size")
    return coverage.groupBy(*key).agg(
        ratio(F.sum(q("base_on_target(rm_dup)")), known, 4).alias("mean_depth(rm_dup)"),
        *[ratio(F.sum(q(b)), known, 4).alias(b) for b in BREADTH],
    )


def gender_result(provided, found) -> Column:
    return (
        F.when(col(provided) == "unknown", "NA")
        .when(col(provided) == col(found), "PASS")
        .otherwise("NO PASS")
    )


def _passes(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("NO PASS")


def breadth_result(sample, breadth) -> Column:
    limit = F.when(col(sample).startswith("Embryo"), EMBRYO_BREADTH).otherwise(PARENT_BREADTH)
    return _passes(col(breadth) >= limit)


def qc_verdicts(df: DataFrame) -> DataFrame:
    """Sex, breadth at 4x, raw data and mean depth verdicts."""
    raw = F.regexp_replace("raw_bases", "G", "").cast("long")
    return (
        df.withColumn("gender_result", gender_result("gender_provided", "gender"))
        .withColumn("cov_result", breadth_result("sample", q("coverage>=4(rm_dup)")))
        .withColumn("rawbase_result", _passes(raw >= MIN_RAW_G))
        .withColumn("mean_depth_result", _passes(q("mean_depth(rm_dup)") >= MIN_DEPTH))
    )


def qc_wide(info: DataFrame, wgs: DataFrame, gene: DataFrame, ado: DataFrame | None, genes: Sequence[str]) -> DataFrame:
    """Family table: sheet, genome QC, depth of each gene, drop-out of each gene."""
    depth = gene.groupBy("sample").agg(
        *[
            F.max(F.when(F.col("gene") == g, q("mean_depth(rm_dup)"))).alias(f"mean_depth(rm_dup)_{g}")
            for g in genes
        ]
    )
    out = info.join(wgs, "sample", "left").join(depth, "sample", "left")
    names = ["all_gene", *genes]
    if ado is None:
        return out.select("*", *[F.lit(None).cast("double").alias(f"ADO_{g}") for g in names])
    rates = ado.groupBy("sample").agg(
        *[F.max(F.when(F.col("gene") == g, F.col("rate"))).alias(f"ADO_{g}") for g in names]
    )
    return out.join(rates, "sample", "left")


def linked_read_qc(summary: DataFrame, wgs: DataFrame, gene: DataFrame, genes: Sequence[str]) -> DataFrame:
    """Linked-read summary, genome QC and gene QC of each sample (inner joins)."""
    first = summary.select(
        "sample",
        "number_reads",
        ((F.col("r1_q30_bases_fract") + F.col("r2_q30_bases_fract")) / 2).alias("q30_bases_fract"),
        *[c for c in ("bc_on_whitelist", "mapped_reads", "pcr_duplication", "snps_phased", "n50_phase_block", "mean_depth") if c in summary.columns],
    )
    fields = ["mean_depth(rm_dup)", *BREADTH]
    per = gene.groupBy("sample").agg(
        *[F.max(F.when(F.col("gene") == g, q(f))).alias(f"{f}_{g}") for g in genes for f in fields]
    )
    return first.join(wgs.join(per, "sample"), "sample")


def report_qc(wgs: DataFrame | None, lfr: DataFrame) -> DataFrame:
    """Short-read and linked-read QC under common column names, aligned by name."""

    def shaped(df: DataFrame, level: int) -> DataFrame:
        breadth = f"coverage>={level}(rm_dup)"
        depth_cols = [c for c in df.columns if "mean_depth(rm_dup)_" in c]
        cover_cols = [c for c in df.columns if f"{breadth}_" in c]
        ado = [c for c in df.columns if c.startswith("ADO_")]
        return df.select(
            "sample",
            "sampleID",
            "raw_bases",
            q("mean_depth(rm_dup)"),
            q(breadth).alias("coverage(rm_dup)"),
            *[q(c).alias(c.replace("mean_depth(rm_dup)", "gene_depth(rm_dup)")) for c in depth_cols],
            *[q(c).alias(c.replace(breadth, "gene_coverage(rm_dup)")) for c in cover_cols],
            *ado,
            "depX",
            "depY",
            "gender",
            gender_result("gender_provided", "gender").alias("Gender_result"),
            breadth_result("sample", q(breadth)).alias("cov_result"),
            _passes(q("mean_depth(rm_dup)") >= MIN_DEPTH).alias("mean_depth_result"),
        )

    linked = lfr.withColumn(
        "raw_bases", F.concat(round_even(F.col("number_reads") / F.lit(1e7), 0).cast("long"), F.lit("G"))
    )
    out = shaped(linked, 10)
    return out if wgs is None else shaped(wgs, 4).unionByName(out, allowMissingColumns=True)


def fastq_quality(fastp: DataFrame) -> DataFrame:
    """Q20 and Q30 rates before and after filtering per sample."""
    return fastp.select(
        F.col("sample").alias("sampleID"),
        *[
            F.col(f"{when}.{rate}_rate").alias(f"{rate.upper()}_{when}")
            for when in ("before_filtering", "after_filtering")
            for rate in ("q20", "q30")
        ],
    )


def merge_family_qc(parts: Sequence[DataFrame] | DataFrame, family_from: str = "path") -> DataFrame:
    """Union of family tables by column name, family taken from the file's directory."""
    if isinstance(parts, DataFrame):
        parts = [parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumn("Family", F.element_at(F.split(family_from, "/"), -2)).drop(family_from)


def attach(df: DataFrame, info: DataFrame, columns: Sequence[str], key: str = "sampleID") -> DataFrame:
    """Inner join with selected columns of a sample table."""
    return df.join(info.select(key, *columns), key)


def format_for_report(df: DataFrame) -> DataFrame:
    """Every column as text with '.' for missing: the last step before a report file."""
    return df.select(*[F.coalesce(q(c).cast("string"), F.lit(".")).alias(c) for c in df.columns])
