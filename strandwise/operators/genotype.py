"""Family genotypes, core haplotypes and relatedness.

Calls are long: (chrom, pos, ref, alt array, filter array, var_type, sample, gt,
ad array).  One shuffle by site brings a family together; a family has a handful
of members, so the wide row is built by conditional aggregates, not by a pivot
over unknown names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import col, q, ratio, round_even
from strandwise.operators.intervals import assign_location, overlap_join

SITE = ("chrom", "pos", "ref", "alt")
ALLELES = ("F1", "F2", "M1", "M2")
PLACES = {"U": "upstream", "I": "internal", "D": "downstream"}
# Genotypes a trio may have, and the depth gates.
TRIO_GENOTYPES = ("0/0", "0/1", "1/1")
UNCALLED = ("./.", ".|.")


def correct_genotype(gt, alt_ratio, method: str = "ratio", low: float = 0.05, up: float = 0.95) -> Column:
    """Genotype after a look at the alternate read share.

    simple: anything strictly between 0 and 1 is heterozygous.  ratio: a
    heterozygote needs low <= share <= up; a reference (alternate) homozygote whose
    share is not below ``low`` (above ``up``) becomes heterozygous.
    """
    gt, r = col(gt), col(alt_ratio)
    if method == "simple":
        return F.when((r > 0) & (r < 1), "0/1").otherwise(gt)
    het = F.when(r < low, "0/0").when(r > up, "1/1").otherwise("0/1")
    return (
        F.when(gt == "0/1", het)
        .when(gt == "1/1", F.when(r <= up, "0/1").otherwise(gt))
        .otherwise(F.when(r >= low, "0/1").otherwise(gt))
    )


def allele_text(gt: Column, ref: Column, alt: Column, sep: str = "/") -> Column:
    """``0/1`` → ``A/G``; null when any index has no allele."""
    parts = F.split(gt, "[/|]")

    def base(i: int) -> Column:
        index = F.get(parts, F.lit(i))
        return F.when(index == "0", ref).otherwise(F.get(alt, index.try_cast("int") - 1))

    return F.when(F.size(parts) == 1, base(0)).otherwise(F.concat(base(0), F.lit(sep), base(1)))


def usable_sites(calls: DataFrame, max_alts: int = 1) -> DataFrame:
    """Without low-quality, spanning-deletion and too multi-allelic sites."""
    return calls.where(
        ~F.coalesce(F.array_contains("filter", "LowQual"), F.lit(False))
        & ~F.array_contains("alt", "*")
        & (F.size("alt") <= max_alts)
    )


def _depth(ad: Column) -> Column:
    """Sum of the allele depths; the usual few alleles stay in generated code."""
    few = F.get(ad, F.lit(0))
    for i in range(1, 4):
        few = few + F.coalesce(F.get(ad, F.lit(i)), F.lit(0))
    many = F.aggregate(ad, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.when(F.size(ad) <= 4, few).otherwise(many)


def _wide(rows: DataFrame, people: Sequence[str], fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per site with ``<person>_<field>`` columns.

    The members of a family are collected once (a handful per site) and picked
    apart by projection: one aggregate in place of one per person and field.
    """
    member = F.struct("sample", *fields)
    packed = rows.where(F.col("sample").isin(*people)).groupBy(*keep).agg(F.collect_list(member).alias("_all"))

    def of(person: str) -> Column:
        return F.array_max(F.filter("_all", lambda m: m["sample"] == person))

    picked = packed.withColumns({f"_of_{p}": of(p) for p in people})
    return picked.select(*keep, *[F.col(f"_of_{p}.{f}").alias(f"{p}_{f}") for p in people for f in fields])


def family_calls(
    calls: DataFrame,
    members: Sequence[str],
    embryos: Sequence[str] = (),
    *,
    method_trios: str = "ratio",
    method_embryo: str = "simple",
    low: float = 0.05,
    up: float = 0.95,
    site: Sequence[str] = SITE,
) -> DataFrame:
    """One row per site with every member called; an uncalled embryo is null.

    Columns per person: DP, AD, ratio, GT_origin, origin, GT_correct, correct.
    """
    rows = usable_sites(calls).where(~F.col("gt").isin(*UNCALLED) & F.col("ad").isNotNull())
    rows = rows.withColumn("gt", F.translate("gt", "|", "/")).where(F.col("gt").isin(*TRIO_GENOTYPES))
    rows = rows.withColumn("DP", _depth(F.col("ad"))).where("DP > 0")
    # only the raw call is shuffled; everything derived from it is worked out per site
    people = [*members, *embryos]
    wide = _wide(rows, people, ["DP", "ad", "gt"], [*site, "var_type"])
    for m in members:
        wide = wide.where(F.col(f"{m}_DP").isNotNull())
    share = {f"{p}_ratio": round_even(F.col(f"{p}_ad")[1] / F.col(f"{p}_DP"), 3) for p in people}
    wide = wide.withColumns(share)
    fixed = {}
    for p in people:
        method = method_trios if p in members else method_embryo
        fixed[f"{p}_GT_correct"] = correct_genotype(f"{p}_gt", f"{p}_ratio", method, low, up)
    wide = wide.withColumns(fixed)
    out = [*site, "var_type"]
    for p in people:
        gt = F.col(f"{p}_gt")
        out += [
            F.col(f"{p}_DP"),
            F.array_join(F.col(f"{p}_ad").cast("array<string>"), ",").alias(f"{p}_AD"),
            F.col(f"{p}_ratio"),
            gt.alias(f"{p}_GT_origin"),
            allele_text(gt, F.col("ref"), F.col("alt")).alias(f"{p}_origin"),
            F.col(f"{p}_GT_correct"),
            allele_text(F.col(f"{p}_GT_correct"), F.col("ref"), F.col("alt")).alias(f"{p}_correct"),
        ]
    return wide.select(*out)


def _dosage(gt: Column) -> Column:
    return F.when(gt == "0/0", 0).when(gt == "0/1", 1).when(gt == "1/1", 2)


def _with_haplotypes(df: DataFrame, known: Column, father1: Column, father2: Column, mother1: Column, mother2: Column) -> DataFrame:
    for name, allele in zip(ALLELES, (father1, father2, mother1, mother2)):
        base = F.when(allele == 0, F.col("ref")).otherwise(F.col("alt")[0])
        df = df.withColumn(name, F.when(known, base).otherwise("."))
    return df.withColumn("IF", F.when(known, "yes").otherwise("no"))


def core_haplotype(site: DataFrame, suffix: str = "correct", proband: str = "Proband") -> DataFrame:
    """F1, F2, M1, M2, IF from father, mother and child.

    Informative when exactly one parent is heterozygous and the child is possible:
    the child's alternate count minus the homozygous parent's share is the allele
    the heterozygous parent handed down, which is that parent's first haplotype.
    """
    f, m, p = (_dosage(F.col(f"{who}_GT_{suffix}")) for who in ("Father", "Mother", proband))
    father_het = (f == 1) & (m != 1)
    mother_het = (m == 1) & (f != 1)
    given = F.when(father_het, p - m / 2).when(mother_het, p - f / 2)
    known = F.coalesce(given.isin(0, 1), F.lit(False))
    return _with_haplotypes(
        site,
        known,
        F.when(father_het, given).otherwise(f / 2),
        F.when(father_het, 1 - given).otherwise(f / 2),
        F.when(mother_het, given).otherwise(m / 2),
        F.when(mother_het, 1 - given).otherwise(m / 2),
    )


def noncore_haplotype(site: DataFrame, side: str, suffix: str = "correct") -> DataFrame:
    """As above from a grandparent (``Maternal`` or ``Paternal``).

    Informative when the parent on that side is heterozygous and the other parent
    and the grandparent are homozygous: the grandparent's allele is haplotype 2.
    """
    f, m, g = (_dosage(F.col(f"{who}_GT_{suffix}")) for who in ("Father", "Mother", side))
    mother_side = side == "Maternal"
    own, other = (m, f) if mother_side else (f, m)
    known = F.coalesce((own == 1) & (other != 1) & (g != 1), F.lit(False))
    fixed, second, first = other / 2, g / 2, 1 - g / 2
    if mother_side:
        return _with_haplotypes(site, known, fixed, fixed, first, second)
    return _with_haplotypes(site, known, first, second, fixed, fixed)


def informative_allele(f1="F1", f2="F2", m1="M1", m2="M2") -> Column:
    """Name of the first of the four haplotypes whose base occurs once."""
    cols = [col(c) for c in (f1, f2, m1, m2)]
    bases = F.array(*cols)
    out = F.lit(None).cast("string")
    for name, c in reversed(list(zip(ALLELES, cols))):
        single = F.size(F.filter(bases, lambda b: b == c)) == 1
        out = F.when(single, name).otherwise(out)
    return out


def family_haplotypes(
    site: DataFrame,
    members: Sequence[str],
    embryos: Sequence[str],
    *,
    start,
    stop,
    trio_depth: int = 10,
    embryo_depth: int = 4,
    suffix: str = "correct",
) -> DataFrame:
    """Add Allele, IF_filter, Location and the haplotype each embryo supports."""
    low = F.greatest(*[(F.col(f"{m}_DP") < trio_depth).cast("int") for m in members]) == 1
    yes = F.col("IF") == "yes"
    df = (
        site.withColumn("Allele", F.when(yes, informative_allele()).otherwise("."))
        .withColumn("IF_filter", F.when(~yes, "Fail").when(low, "LowDepth").otherwise("Pass"))
        .withColumn("Location", assign_location("pos", start, stop))
    )
    single = F.lit(None).cast("string")
    for name in reversed(ALLELES):
        single = F.when(F.col("Allele") == name, F.col(name)).otherwise(single)
    for e in embryos:
        df = df.withColumn(f"{e}_hap", embryo_haplotype(e, single, embryo_depth, suffix))
    return df


def embryo_haplotype(embryo: str, informative_base: Column, min_depth: int = 4, suffix: str = "correct") -> Column:
    """The informative haplotype if the embryo carries its base, else '.'."""
    bases = F.split(F.col(f"{embryo}_{suffix}"), "/")
    homozygous = F.size(F.array_distinct(bases)) == 1
    without = (
        (F.col("IF") == "no")
        | F.col(f"{embryo}_GT_{suffix}").isNull()
        | (homozygous & (bases[0] != informative_base))
    )
    return (
        F.when(without, ".")
        .when(F.col(f"{embryo}_DP") < min_depth, F.concat("Allele", F.lit("-LowDepth")))
        .otherwise(F.col("Allele"))
    )


def haplotype_counts(
    hap: DataFrame, embryos: Sequence[str], keys: Sequence[str] = ("gene",), keep_indel: bool = False
) -> DataFrame:
    """Supporting sites per sample, haplotype and location, with an ``IF`` row."""
    rows = hap.where("IF_filter = 'Pass'")
    if not keep_indel:
        rows = rows.where("var_type <> 'indel'")
    entries = [F.struct(F.lit("IF").alias("sample"), F.col("Allele").alias("hap"))] + [
        F.struct(F.lit(e).alias("sample"), F.col(f"{e}_hap").alias("hap")) for e in embryos
    ]
    rows = rows.select(*keys, "Location", F.explode(F.array(*entries)).alias("x")).select(
        *keys, "Location", "x.*"
    )
    both = F.when(F.col("sample") == "IF", F.substring("hap", 1, 1))
    cells = []
    for a in ALLELES:
        pair = F.lit(f"{a[0]}1|{a[0]}2")
        hit = (F.col("hap") == a) | (both.isNotNull() & (F.col("hap") == pair))
        for short, place in PLACES.items():
            cells.append(
                F.sum(F.when(hit & (F.col("Location") == place), 1).otherwise(0)).alias(f"{a}-{short}")
            )
    return rows.groupBy(*keys, "sample").agg(*cells)


def haplotype_verdict(
    counts: DataFrame, keys: Sequence[str] = ("gene",), up: float = 0.2, low: float = 0.05
) -> DataFrame:
    """Paternal and Maternal verdicts per embryo over upstream|internal|downstream."""
    cells = [f"{a}-{p}" for a in ALLELES for p in PLACES]
    base = counts.where("sample = 'IF'").select(*keys, *[q(c).alias(f"if_{c}") for c in cells])
    df = counts.where("sample <> 'IF'").join(base, list(keys))

    def part(side: str, place: str) -> Column:
        n1, n2 = q(f"if_{side}1-{place}"), q(f"if_{side}2-{place}")
        r1, r2 = ratio(q(f"{side}1-{place}"), n1), ratio(q(f"{side}2-{place}"), n2)
        first = (r1 > up) & ((n2 == 0) | (r2 < low))
        second = (r2 > up) & ((n1 == 0) | (r1 < low))
        return F.when(first, f"{side}1").when(second, f"{side}2").otherwise("-")

    return df.select(
        *keys,
        "sample",
        *[q(c) for c in cells],
        F.concat_ws("|", *[part("F", p) for p in PLACES]).alias("Paternal"),
        F.concat_ws("|", *[part("M", p) for p in PLACES]).alias("Maternal"),
    )


def ado_rate(
    calls: DataFrame,
    regions: DataFrame,
    embryos: Sequence[str],
    *,
    trio_depth: int = 10,
    embryo_depth: int = 4,
    use_indel: bool = False,
) -> DataFrame:
    """Allele drop-out per gene and embryo: sites where the parents are opposite
    homozygotes (``meet``) and the embryo shows only one of their alleles (``ADO``).

    ``regions`` = (gene, chrom, start_extend, end_extend); ``all_gene`` covers the
    autosomes.  An uncalled embryo still counts in ``meet``.
    """
    rows = calls.where(
        ~F.coalesce(F.array_contains("filter", "LowQual"), F.lit(False)) & ~F.array_contains("alt", "*")
    )
    if not use_indel:
        rows = rows.where("var_type = 'snp'")
    rows = rows.withColumn("gt", F.translate("gt", "|", "/")).withColumn("dp", _depth(F.col("ad")))
    people = ["Father", "Mother", *embryos]
    wide = _wide(rows, people, ["gt", "dp"], SITE)

    def alleles(who: str) -> Column:
        return F.array_distinct(F.split(F.col(f"{who}_gt"), "/"))

    dad, mom = alleles("Father"), alleles("Mother")
    met = wide.where(
        ~F.col("Father_gt").isin("./.") & ~F.col("Mother_gt").isin("./.")
        & (F.col("Father_dp") >= trio_depth)
        & (F.col("Mother_dp") >= trio_depth)
        & (F.size(dad) == 1)
        & (F.size(mom) == 1)
        & (dad[0] != mom[0])
    )
    flags = []
    for e in embryos:
        mine = alleles(e)
        lost = (
            (F.size(mine) == 1)
            & F.array(F.substring("Father_gt", 1, 1), F.substring("Mother_gt", 1, 1)).cast("string").isNotNull()
            & ((mine[0] == F.substring("Father_gt", 1, 1)) | (mine[0] == F.substring("Mother_gt", 1, 1)))
            & (F.col(f"{e}_dp") >= embryo_depth)
        )
        flags.append(F.coalesce(lost, F.lit(False)).cast("int").alias(f"_{e}"))
    met = met.select("chrom", "pos", *flags)
    autosomal = ~F.col("chrom").isin("chrX", "chrY") & ~F.col("chrom").contains("M")
    whole = met.where(autosomal).withColumn("gene", F.lit("all_gene"))
    points = met.withColumn("start", F.col("pos") - 1).withColumn("stop", F.col("pos"))
    genes = regions.select(
        "gene", "chrom", F.col("start_extend").alias("start"), F.col("end_extend").alias("stop")
    )
    tagged = overlap_join(points, genes).select(*met.columns, "gene").unionByName(whole)
    sums = tagged.groupBy("gene").agg(
        F.count(F.lit(1)).alias("meet"), *[F.sum(f"_{e}").alias(f"_{e}") for e in embryos]
    )
    per = F.array(*[F.struct(F.lit(e).alias("sample"), F.col(f"_{e}").alias("ADO")) for e in embryos])
    return sums.select("gene", "meet", F.explode(per).alias("x")).select(
        "gene", "x.sample", "meet", "x.ADO", ratio(F.col("x.ADO"), F.col("meet"), 4).alias("rate")
    )


def allele_ratio_sites(calls: DataFrame, style: str = "plot", min_depth: int = 10) -> DataFrame:
    """Alternate share of single-sample sites.

    plot: called non-reference genotypes, phased or not, share to 4 digits, with
    genotype and variant class.  roh: SNPs of enough depth, het or hom.
    """
    depth = F.col("ad")[0] + F.col("ad")[1]
    if style == "plot":
        rows = calls.where(F.col("gt").isin("0/1", "1/1", "1/0", "0|1", "1|1", "1|0"))
        long = (F.length("ref") > 1) | (F.length(F.array_join("alt", ",")) > 1)
        return rows.select(
            *SITE,
            depth.alias("depth"),
            ratio(F.col("ad")[1], depth, 4).alias("ratio"),
            F.when(long, "indel").otherwise("snv").alias("var_type"),
            F.when(F.col("gt").isin("1|1", "1/1"), "Hom").otherwise("Het").alias("genotype"),
        )
    gts = F.split("gt", "[/|]")
    het = (gts[0] != gts[1]) & ~F.array_contains(gts, ".")
    return calls.where((F.col("dp") >= min_depth) & (F.col("var_type") == "snp")).select(
        "chrom",
        "pos",
        "dp",
        F.col("ad")[1].alias("dp_alt"),
        ratio(F.col("ad")[1], F.col("dp")).alias("ratio"),
        F.when(het, "het").otherwise("hom").alias("genotype"),
    )


def relatedness_matrix(pairs: DataFrame, value: str, samples: Sequence[str] | None = None) -> DataFrame:
    """Square table of a pairwise value: one row per IID1, one column per IID2."""
    return pairs.groupBy("IID1").pivot("IID2", list(samples) if samples else None).agg(F.first(value))


_WORD = 64  # samples of a site whose genotypes share a word of each plane
_TILE = 1024  # samples multiplied together
_IBS_SCHEMA = "chrom string, a int, b int, ibs0 long, ibs1 long, ibs2 long"


def _counter(tile: int, width: int, slice_rows: int = 1000):
    """mapInPandas function: shared alleles of all pairs of two tiles, ``width`` samples each, summed over sites."""

    def planes(rows: pd.Series) -> np.ndarray:
        site = np.repeat(np.arange(len(rows)), [len(r) // 4 for r in rows])
        words = np.concatenate(rows.to_list()).reshape(-1, 4)
        packed = np.zeros((3, len(rows), width // _WORD), np.int64)
        packed[:, site, words[:, 0]] = words[:, 1:].T
        return np.unpackbits(packed.view(np.uint8), axis=-1, bitorder="little").astype(np.float32)

    def table(chrom: str, low: int, high: int, n: np.ndarray) -> pd.DataFrame:
        a, b = np.triu_indices(width, 1) if low == high else (i.ravel() for i in np.indices((width, width)))
        return pd.DataFrame(
            {"chrom": chrom, "a": a + low * tile, "b": b + high * tile, **{f"ibs{i}": n[i, a, b] for i in range(3)}}
        )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby(["chrom", "low", "high"], sort=False):
                if key not in held and (len(held) + 1) * 3 * width * width > 2**23:  # 64 MB
                    yield from (table(*k, n) for k, n in held.items())
                    held = {}
                total = held.setdefault(key, np.zeros((3, width, width), np.int64))
                for at in range(0, len(part), slice_rows):
                    x = planes(part["left"].iloc[at : at + slice_rows])
                    y = x if key[1] == key[2] else planes(part["right"].iloc[at : at + slice_rows])
                    two = sum(x[g].T @ y[g] for g in range(3))
                    none = x[0].T @ y[2] + x[2].T @ y[0]
                    one = x.sum(axis=0).T @ y.sum(axis=0) - two - none
                    total += np.stack([none, one, two]).astype(np.int64)
        yield from (table(*k, n) for k, n in held.items())

    return count


def pairwise_ibs(calls: DataFrame, samples: Sequence[str], per_contig: bool = False, tile: int = _TILE) -> DataFrame:
    """Identity by state of all sample pairs and the method-of-moments PI_HAT.

    The genotypes of a site are packed to three bit planes, a word for 64 samples, by
    aggregates that combine on the map side.  Tiles of ``tile`` samples (a multiple of 64)
    are paired per site and multiplied over many sites at once; a task holds at most 64 MB of
    sums.  Neither the plan nor a row grows with the number of samples beyond a tile.
    Expected counts given identity by descent use the allele frequency of each site.  A
    pair without a common site has counts of zero; a site called twice for a sample
    counts with the higher dosage.
    """
    samples = list(samples)
    if len(set(samples)) < len(samples):
        raise ValueError("a sample is named twice")
    names = F.from_json(F.lit(json.dumps(samples)), "array<string>")
    # a range, unlike a list of rows, has a size that Spark knows: the names are looked up without a shuffle
    index = calls.sparkSession.range(1).select(F.posexplode(names).alias("a", "sample"))
    dosage = _dosage(F.translate("gt", "|", "/"))
    rows = calls.select(*SITE, "sample", dosage.alias("d")).where("d is not null").join(index, "sample")
    bit = F.expr(f"shiftleft(1L, a % {_WORD})")
    found = rows.groupBy(*SITE, F.floor(F.col("a") / _WORD).cast("int").alias("word")).agg(
        *[F.bit_or(F.when(F.col("d") == g, bit).otherwise(F.lit(0).cast("long"))).alias(f"q{g}") for g in range(3)]
    )
    packed = found.selectExpr(*SITE, "word", "q0 & ~(q1 | q2) as p0", "q1 & ~q2 as p1", "q2 as p2")
    words, tiles = -(-len(samples) // _WORD), -(-len(samples) // tile)
    per_tile = tile // _WORD
    sided = packed
    if tiles > 1:
        # every tile stands once in each contig, so that pairs without a common site are counted too
        one_site = packed.groupBy("chrom").agg(F.min(F.struct(*SITE)).alias("s")).select("s.*")
        every = one_site.select(*SITE, F.explode(F.sequence(F.lit(0), F.lit(words - 1), F.lit(per_tile))).alias("word"))
        sided = packed.unionByName(every.select("*", *[F.lit(0).cast("long").alias(f"p{g}") for g in range(3)]))
        sided = sided.groupBy(*SITE, "word").agg(*[F.bit_or(f"p{g}").alias(f"p{g}") for g in range(3)])
    entry = F.array((F.col("word") % per_tile).cast("long"), "p0", "p1", "p2")
    if words == 1:  # a row per site already
        sites = packed.select(*SITE, F.lit(0).alias("low"), entry.alias("left"))
    else:
        low = F.floor(F.col("word") / per_tile).cast("int").alias("low")
        sites = sided.groupBy(*SITE, low).agg(F.flatten(F.collect_list(entry)).alias("left"))
    if tiles > 1:
        other = sites.select(*SITE, F.col("low").alias("high"), F.col("left").alias("right"))
        met = sites.join(other, list(SITE)).where("low <= high").select("chrom", "low", "high", "left", "right")
    else:
        met = sites.select("chrom", "low", F.col("low").alias("high"), "left")

    group = ["chrom"] if per_contig else []
    pairs = (
        met.mapInPandas(_counter(tile, min(per_tile, words) * _WORD), _IBS_SCHEMA)
        .where(F.col("b") < len(samples))
        .groupBy(*group, "a", "b")
        .agg(*[F.sum(f"ibs{i}").alias(f"IBS{i}") for i in range(3)])
    )
    seen = packed.select(
        *SITE,
        (F.bit_count("p1") + 2 * F.bit_count("p2")).alias("alts"),
        F.bit_count(F.expr("p0 | p1 | p2")).alias("known"),
    )
    if words > 1:
        seen = seen.groupBy(*SITE).agg(F.sum("alts").alias("alts"), F.sum("known").alias("known"))
    expect = seen.withColumn("_p", F.col("alts") / (2 * F.col("known"))).withColumn("_q", 1 - F.col("_p"))
    pp, qq = F.col("_p"), F.col("_q")
    means = expect.groupBy(*group).agg(
        F.avg(2 * pp * pp * qq * qq).alias("e00"),
        F.avg(4 * pp * pp * pp * qq + 4 * pp * qq * qq * qq).alias("e10"),
        F.avg(2 * pp * pp * qq + 2 * pp * qq * qq).alias("e11"),
    )
    joined = pairs.join(means, group) if group else pairs.crossJoin(F.broadcast(means))
    total = F.col("IBS0") + F.col("IBS1") + F.col("IBS2")
    z0 = F.least(F.lit(1.0), ratio(F.col("IBS0"), F.col("e00") * total))
    z1 = F.greatest(F.lit(0.0), ratio(F.col("IBS1") - z0 * F.col("e10") * total, F.col("e11") * total))
    z1 = F.least(z1, 1 - z0)
    z2 = 1 - z0 - z1
    return joined.select(
        *group,
        F.get(names, F.col("a")).alias("IID1"),
        F.get(names, F.col("b")).alias("IID2"),
        "IBS0",
        "IBS1",
        "IBS2",
        z0.alias("Z0"),
        z1.alias("Z1"),
        z2.alias("Z2"),
        (z1 / 2 + z2).alias("PI_HAT"),
    )
