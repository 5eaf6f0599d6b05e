"""Phase sets from linked reads and the haplotypes they give a family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import ratio, round_even
from strandwise.operators.genotype import SITE, UNCALLED, _depth, _wide, allele_text, usable_sites
from strandwise.operators.intervals import best_overlap, distance_rank, overlap_join

SMALL_DELETION = 30_000  # deletions up to this size are in the small-deletion table


def variant_slot(gt: Column, alts: Column, alt: Column) -> Column:
    """0 or 1, the phased haplotype that carries ``alt``; null when not phased."""
    index = F.array_position(alts, alt) - 1
    return (
        F.when(gt.isin("1|0", "1|1"), 0)
        .when(gt == "0|1", 1)
        .when(gt == "1|2", index)
        .when(gt == "2|1", 1 - index)
        .cast("int")
    )


def phased_variant(targets: DataFrame, calls: DataFrame, order: str = "ord") -> DataFrame:
    """Phase set and slot of target SNVs/indels; targets without one keep nulls.

    ``targets`` (chrom, pos, ref, alt); ``calls`` (chrom, pos, ref, alt array, gt, ps).
    Of several records of a target the first counts, by ``order``, the place in the file.
    """
    phased = calls.where(F.col("ps").isNotNull() & ~F.col("gt").contains("/")).select(
        "chrom", "pos", "ref", F.col("alt").alias("_alts"), F.col("gt").alias("_gt"), "ps", F.col(order).alias("_ord")
    )
    hits = targets.join(phased, ["chrom", "pos", "ref"]).where(F.array_contains("_alts", F.col("alt")))
    slot = variant_slot(F.col("_gt"), F.col("_alts"), F.col("alt"))
    first = hits.groupBy(*SITE).agg(
        F.min_by(F.struct(F.col("ps"), F.col("_gt").alias("gt"), slot.alias("slot")), F.col("_ord")).alias("_x")
    )
    return targets.join(first, list(SITE), "left").select(
        *targets.columns,
        F.col("_x.ps").alias("ps"),
        F.col("_x.gt").alias("gt"),
        F.col("_x.slot").alias("allele_number"),
    )


def phased_deletion(targets: DataFrame, small: DataFrame, large: DataFrame, key: Sequence[str]) -> DataFrame:
    """Phase set and slot of the deletion call covering most of each target.

    Call tables hold (chrom, start, stop, svtype, ps, gt).
    """
    size = F.col("stop") - F.col("start")

    def best(part: DataFrame, table: DataFrame) -> DataFrame:
        usable = table.where("svtype = 'DEL' and ps is not null").select("chrom", "start", "stop", "ps", "gt")
        return best_overlap(part, usable, key=key, order=["start", "stop", "ps"])

    found = best(targets.where(size <= SMALL_DELETION), small).unionByName(
        best(targets.where(size > SMALL_DELETION), large)
    )
    slot = F.when(F.col("gt").isin("1|0", "1|1"), 0).when(F.col("gt") == "0|1", 1)
    return found.withColumn("allele_number", slot.cast("int"))


def phase_block(calls: DataFrame) -> DataFrame:
    """Sites of one sample with reads, their alternate share, named for the family join.

    ``calls`` (chrom, pos, ref, alt array, ps, gt, dp, ad array).
    """
    sep = F.when(F.col("gt").contains("|"), "|").otherwise("/")
    bases = F.concat(F.array("ref"), F.col("alt"))
    parts = F.transform(F.split("gt", "[/|]"), lambda i: F.coalesce(F.get(bases, i.try_cast("int")), F.lit(".")))
    text = F.when(sep == "|", F.array_join(parts, "|")).otherwise(F.array_join(parts, "/"))
    return calls.where("dp > 0").select(
        "chrom",
        "pos",
        "ref",
        F.col("ps").cast("string").alias("ps"),
        F.col("gt").alias("GT_lfr"),
        text.alias("TGT_lfr"),
        F.col("dp").alias("DP_lfr"),
        F.array_join(F.col("ad").cast("array<string>"), ",").alias("AD_lfr"),
        round_even(F.element_at("ad", -1) / F.col("dp"), 3).alias("Ratio_lfr"),
    )


def block_range(block: DataFrame) -> DataFrame:
    """First and last site of each phase set."""
    return block.where("ps is not null").groupBy("chrom", "ps").agg(
        F.min("pos").alias("ps_start"), F.max("pos").alias("ps_stop")
    )


def linked_family_calls(calls: DataFrame, members: Sequence[str], embryos: Sequence[str] = ()) -> DataFrame:
    """Family rows for linked-read phasing: up to two ALTs, any genotype, last-AD share."""
    rows = usable_sites(calls, 2).where(~F.col("gt").isin(*UNCALLED) & F.col("ad").isNotNull())
    rows = rows.withColumn("GT", F.translate("gt", "|", "/")).withColumn("DP", _depth(F.col("ad")))
    rows = (
        rows.where("DP > 0")
        .withColumn("TGT", allele_text(F.col("GT"), F.col("ref"), F.col("alt")))
        .withColumn("Ratio", round_even(F.element_at("ad", -1) / F.col("DP"), 3))
        .withColumn("AD", F.array_join(F.col("ad").cast("array<string>"), ","))
        .where("TGT is not null")
    )
    wide = _wide(rows, [*members, *embryos], ["GT", "TGT", "DP", "AD", "Ratio"], [*SITE, "var_type"])
    for m in members:
        wide = wide.where(F.col(f"{m}_DP").isNotNull())
    return wide


def phase_family(
    block: DataFrame,
    family: DataFrame,
    tag: str,
    allele_number,
    *,
    window: tuple[int, int] | None = None,
    start=None,
    stop=None,
) -> DataFrame:
    """Family sites inside a phase block with the two haplotypes of the phased parent.

    ``<tag>1`` is the haplotype that carries the target variant.  ``window`` keeps
    sites closer than (left, right) to the gene.
    """
    slot = F.lit(allele_number) if isinstance(allele_number, int) else allele_number
    slots = F.split("TGT_lfr", "[/|]")
    out = (
        family.join(block.where("TGT_lfr is not null"), ["chrom", "pos", "ref"])
        .withColumn(f"{tag}1", F.get(slots, slot))
        .withColumn(f"{tag}2", F.get(slots, 1 - slot))
    )
    if window:
        out = out.where((F.col("pos") > start - window[0]) & (F.col("pos") < stop + window[1]))
    return out


def linked_informative(site: DataFrame, tag: str, min_depth: int = 10) -> DataFrame:
    """IF, Allele and IF_filter: does the other parent leave the phased alleles apart?"""
    other = "Father" if tag == "M" else "Mother"
    phased = F.array_distinct(F.split("TGT_lfr", "\\|"))
    theirs = F.array_distinct(F.split(f"{other}_TGT", "/"))
    shared = F.array_intersect(theirs, F.array(f"{tag}1", f"{tag}2"))
    yes = (
        (F.size(phased) > 1)
        & F.col(f"{other}_TGT").isNotNull()
        & ((F.size(theirs) == 1) | (F.size(F.array_intersect(theirs, phased)) < 2))
    )
    yes = F.coalesce(yes, F.lit(False))
    allele = F.when(F.size(shared) == 0, f"{tag}1|{tag}2").when(
        F.get(shared, F.lit(0)) == F.col(f"{tag}1"), f"{tag}2"
    ).otherwise(f"{tag}1")
    low = (F.col(f"{other}_DP") < min_depth) | (F.col("DP_lfr") < min_depth)
    return (
        site.withColumn("IF", F.when(yes, "yes").otherwise("no"))
        .withColumn("Allele", F.when(yes, allele).otherwise("."))
        .withColumn("IF_filter", F.when(~yes, "Fail").when(low, "LowDepth").otherwise("Pass"))
    )


def linked_support(site: DataFrame, embryo: str, tag: str, min_depth: int = 4) -> DataFrame:
    """Add ``<embryo>_hap``: the phased parent's haplotype the embryo inherited."""
    other = "Father" if tag == "M" else "Mother"
    mine = F.array_distinct(F.split(f"{embryo}_TGT", "/"))
    theirs = F.array_distinct(F.split(f"{other}_TGT", "/"))
    haps = F.array(f"{tag}1", f"{tag}2")
    common = F.array_intersect(mine, haps)

    def named(base: Column) -> Column:
        return F.when(base == F.col(f"{tag}1"), f"{tag}1").otherwise(f"{tag}2")

    only = F.get(common, F.lit(0))
    homozygous = F.when(F.array_contains(theirs, mine[0]) | (F.size(common) == 0), ".").otherwise(named(mine[0]))
    father_base = F.get(theirs, F.lit(0))
    special = F.get(F.array_except(common, F.array(father_base)), F.lit(0))
    heterozygous = (
        F.when((F.size(common) == 1) & ~F.array_contains(theirs, only), named(only))
        .when(
            (F.size(common) == 2) & (F.size(theirs) == 1) & F.array_contains(haps, father_base),
            named(special),
        )
        .otherwise(".")
    )
    hap = F.when(F.size(mine) == 1, homozygous).otherwise(heterozygous)
    hap = F.when((F.col("IF") == "no") | F.col(f"{embryo}_TGT").isNull(), ".").otherwise(hap)
    shallow = (F.col(f"{embryo}_DP") < min_depth) & (hap != ".")
    return site.withColumn(f"{embryo}_hap", F.when(shallow, F.concat(hap, F.lit("-LowDepth"))).otherwise(hap))


def _region_sets(calls: DataFrame, regions: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    phased = calls.where(F.col("gt").contains("|") & F.col("ps").isNotNull())
    points = phased.select(
        "chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("stop"), "ps"
    )
    spans = regions.select(*key, "chrom", "start", "stop")
    # sites at either end count: start <= pos <= stop
    inside = overlap_join(spans.withColumn("stop", F.col("stop") + 1), points)
    met = inside.groupBy(*key, "chrom", "ps").agg(F.min("b_start").alias("first"))
    return phased, met


def phase_set_stats(calls: DataFrame, regions: DataFrame, key: Sequence[str] = ("gene",)) -> DataFrame:
    """Phase sets touching each region: span, heterozygous SNPs, overlap with the region.

    All sets are kept; ``is_last`` marks the one that appears last in the region.
    Sets of at most one heterozygous SNP are dropped.
    """
    phased, met = _region_sets(calls, regions, key)
    het_snp = (F.length("ref") == 1) & (F.length(F.array_join("alt", ",")) == 1) & (F.col("gt") != "1|1")
    spans = phased.groupBy("chrom", "ps").agg(
        F.min("pos").alias("PS_start"),
        F.max("pos").alias("PS_stop"),
        F.sum(het_snp.cast("int")).alias("PS_size"),
    )
    last = met.groupBy(*key).agg(F.max("first").alias("_last"))
    rows = met.join(last, list(key)).join(spans, ["chrom", "ps"]).join(
        regions.select(*key, "start", "stop"), list(key)
    )
    common = F.least("PS_stop", "stop") - F.greatest("PS_start", "start")
    return rows.where("PS_size > 1").select(
        *key,
        "chrom",
        "start",
        "stop",
        "ps",
        "PS_start",
        "PS_stop",
        "PS_size",
        (common / (F.col("stop") - F.col("start"))).alias("Overlap_Rate"),
        (F.col("first") == F.col("_last")).alias("is_last"),
    )


def phase_set_span(calls: DataFrame, regions: DataFrame, key: Sequence[str] = ("gene",)) -> DataFrame:
    """Span of the phase set covering most of each gene (last wins), else the gene's own."""
    phased, met = _region_sets(calls, regions, key)
    spans = phased.groupBy("chrom", "ps").agg(F.min("pos").alias("a"), F.max("pos").alias("b"))
    rows = met.join(spans, ["chrom", "ps"]).join(regions.select(*key, "start", "stop"), list(key))
    share = (F.least("b", "stop") - F.greatest("a", "start")) / (F.col("stop") - F.col("start"))
    top = rows.groupBy(*key).agg(F.max_by(F.struct("a", "b"), F.struct(share, F.col("first"))).alias("x"))
    return regions.join(top, list(key), "left").select(
        *key,
        "chrom",
        F.coalesce("x.a", "start").alias("ps_start"),
        F.coalesce("x.b", "stop").alias("ps_stop"),
    )


def candidate_sites(
    family_block: DataFrame, parent: str, hap: str, start: Column, stop: Column,
    *, extend: int = 2_000_000, depth: int = 15, low: float = 0.4, up: float = 0.6,
) -> DataFrame:
    """SNPs near a gene that tell the target haplotype of ``parent`` from the other."""
    other = "Mother" if parent == "Father" else "Father"
    phase = "1|0" if hap == "hap1" else "0|1"
    hits = family_block.where(
        F.col("ps").isNotNull()
        & (F.col("var_type") == "snp")
        & (F.col("pos") <= stop + extend)
        & (F.col("pos") >= start - extend)
        & (F.col(f"{parent}_GT") == "0/1")
        & (F.col(f"{other}_GT") == "0/0")
        & (F.col("GT_lfr") == phase)
        & (F.least("Father_DP", "Mother_DP", "DP_lfr") >= depth)
        & F.col("Ratio_lfr").between(low, up)
    )
    return distance_rank(hits, start, stop)
