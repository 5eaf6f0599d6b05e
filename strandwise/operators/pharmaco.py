"""Pharmacogenomic site genotypes, star alleles and comparison with known results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import ratio
from strandwise.operators.annotate import variant_type
from strandwise.operators.boosting import BoostedStumps, boosted_stumps
from strandwise.operators.intervals import overlap_join

# Two-base ambiguity codes.
DEGENERATE = {"R": "A/G", "Y": "C/T", "M": "A/C", "K": "G/T", "S": "G/C", "W": "A/T"}
ACE_FEATURES = ("snp_ratio", "depth_ratio", "split_reads_ratio")


def site_lookup(catalog: DataFrame, calls: DataFrame, depth: DataFrame, order: str = "ord") -> DataFrame:
    """Record of each catalogue site, or reference with the depth of the reads.

    ``calls`` of one sample (chrom, pos, ref, alt array, qd, gt, dp, ad array);
    ``depth`` runs (chrom, start, stop, depth).  The first record of a site counts, by
    ``order``, the place in the file.
    """
    total = F.aggregate(F.col("ad"), F.lit(0).cast("long"), lambda a, x: a + x)
    rec = F.struct(
        F.col("ref").alias("ref_calling"),
        F.array_join("alt", ",").alias("alt_calling"),
        F.col("qd").cast("string").alias("qd"),
        F.translate("gt", "|", "/").alias("gt"),
        F.col("dp").cast("long").alias("dp"),
        ratio(F.element_at("ad", -1), total).alias("ratio"),
    )
    first = calls.groupBy("chrom", "pos").agg(F.min_by(rec, F.col(order)).alias("rec"))
    spots = catalog.select("chrom", "pos").distinct().join(first, ["chrom", "pos"], "left_anti")
    spots = spots.withColumn("start", F.col("pos") - 1).withColumn("stop", F.col("pos"))
    under = overlap_join(spots, depth).select("chrom", "pos", "depth")
    joined = catalog.join(first, ["chrom", "pos"], "left").join(under, ["chrom", "pos"], "left")
    found = F.col("rec").isNotNull()
    return joined.select(
        *catalog.columns,
        F.when(found, F.col("rec.ref_calling")).otherwise(".").alias("ref_calling"),
        F.when(found, F.col("rec.alt_calling")).otherwise(".").alias("alt_calling"),
        F.coalesce("rec.qd", F.lit(".")).alias("qd"),
        F.when(found, F.col("rec.gt")).otherwise("0/0").alias("gt"),
        F.when(found, F.col("rec.dp")).otherwise(F.coalesce("depth", F.lit(0))).alias("dp"),
        F.col("rec.ratio").alias("ratio"),
    )


def _pair(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("/"), b)


def _zygosity() -> Column:
    return (
        F.when(F.col("gt") == "0/0", "ref")
        .when(F.col("gt").isin("0/1", "1/0"), "het")
        .when(F.col("gt") == "1/1", "hom")
        .otherwise("two")
    )


def _settle(het_low: Column) -> tuple[Column, Column, Column]:
    """(raw zygosity, zygosity after the ratio limits, which of two ALTs wins)."""
    raw, r = _zygosity(), F.col("ratio")
    hom, low = F.col("het_hom_ratio_threshold"), F.col("ref_het_ratio_threshold")
    fixed = (
        F.when(raw == "het", F.when(r > hom, "hom").when(r < low, "ref").otherwise("het"))
        .when(raw == "hom", F.when(r <= hom, "het").otherwise("hom"))
        .otherwise(raw)
    )
    winner = F.when(1 - r > hom, 1).when(r > hom, 2).otherwise(0)
    return raw, fixed, winner


def pgx_genotype(site: DataFrame) -> DataFrame:
    """Raw and ratio-corrected genotype text of a site; Fail below the depth gate.

    Needs the columns of ``site_lookup`` plus drug_ref, depth_threshold,
    het_hom_ratio_threshold, ref_het_ratio_threshold and corrected (yes/no).
    """
    raw, fixed, winner = _settle(F.col("ref_calling"))
    ref, alt = F.col("ref_calling"), F.col("alt_calling")
    alts = F.split("alt_calling", ",")
    one, two = F.get(alts, F.lit(0)), F.get(alts, F.lit(1))
    drug = F.col("drug_ref")

    def text(z: Column) -> Column:
        return F.when(z == "ref", _pair(ref, ref)).when(z == "het", _pair(ref, alt)).otherwise(_pair(alt, alt))

    genotype = F.when(raw == "ref", _pair(drug, drug)).when(raw == "two", _pair(one, two)).otherwise(text(raw))
    better = (
        F.when(raw == "ref", genotype)
        .when(
            raw == "two",
            F.when(winner == 1, _pair(one, one)).when(winner == 2, _pair(two, two)).otherwise(genotype),
        )
        .otherwise(text(fixed))
    )
    final = F.when(F.col("dp") < F.col("depth_threshold"), "Fail").otherwise(
        F.when(F.col("corrected") == "no", genotype).otherwise(better)
    )
    out = site.withColumn("genotype", genotype).withColumn("genotype_corrected", final)
    # a site without a record reports the catalogue's reference on both sides
    return out.withColumn("ref_calling", F.when(raw == "ref", drug).otherwise(ref)).withColumn(
        "alt_calling", F.when(raw == "ref", drug).otherwise(alt)
    )


def merge_adjacent_pair(site: DataFrame, neighbour: DataFrame, distance: int = 2, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Two genotyped sites ``distance`` apart read as one multi-base allele."""
    fields = ["ref_calling", "alt_calling", "qd", "gt", "dp", "ratio", "genotype", "genotype_corrected"]
    near = neighbour.select(
        *keys, (F.col("pos") - distance).alias("pos"), *[F.col(f).alias(f"n_{f}") for f in fields]
    )
    df = site.join(near, [*keys, "pos"])
    c = F.col
    here_ref, near_ref = c("gt") == "0/0", c("n_gt") == "0/0"
    ok = (c("genotype_corrected") != "Fail") & (c("n_genotype_corrected") != "Fail")

    def halves(name: str) -> tuple[Column, Column]:
        parts = F.split(name, "/")
        return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))

    g1, g2 = halves("genotype")
    n1, n2 = halves("n_genotype")
    k1, k2 = halves("genotype_corrected")
    m1, m2 = halves("n_genotype_corrected")

    def last(name: str) -> Column:
        return F.right(c(name), F.lit(1))

    def two(name: str) -> Column:
        return F.substring(name, 1, 2)

    ref_text = (
        F.when(here_ref & near_ref, c("ref_calling"))
        .when(here_ref, F.concat(two("ref_calling"), n1))
        .when(near_ref, F.concat("ref_calling", last("n_ref_calling")))
        .otherwise(F.concat(g1, n1))
    )
    alt_text = (
        F.when(here_ref & near_ref, c("alt_calling"))
        .when(here_ref, F.concat(two("alt_calling"), n2))
        .when(near_ref, F.concat("alt_calling", last("n_alt_calling")))
        .otherwise(F.concat(g2, n2))
    )
    fixed = (
        F.when(here_ref & near_ref, c("genotype_corrected"))
        .when(here_ref, _pair(F.concat(two("ref_calling"), m1), F.concat(two("alt_calling"), m2)))
        .when(near_ref, _pair(F.concat(k1, last("n_ref_calling")), F.concat(k2, last("n_ref_calling"))))
        .otherwise(_pair(F.concat(k1, m1), F.concat(k2, m2)))
    )
    both = {f: F.concat_ws(",", c(f).cast("string"), c(f"n_{f}").cast("string")) for f in ("qd", "gt", "dp", "ratio")}
    out = df.select(
        *[c(x) for x in site.columns if x not in fields],
        ref_text.alias("ref_calling"),
        alt_text.alias("alt_calling"),
        *[e.alias(f) for f, e in both.items()],
        F.when(ok, fixed).otherwise("Fail").alias("genotype_corrected"),
    )
    return out.withColumn("genotype", _pair(c("ref_calling"), c("alt_calling")))


def star_site_genotype(site: DataFrame) -> DataFrame:
    """Genotype, corrected genotype and star-table spelling of a site.

    As ``pgx_genotype`` with ref_allele (the star table's reference spelling):
    deletions read ``del<bases>``, insertions ``ins<bases>``, a heterozygous
    insertion ``del/ins<bases>``.  Two-ALT deletions cut the reference at each
    ALT's length.
    """
    raw, fixed, winner = _settle(F.col("ref_calling"))
    ref, alt, drug = F.col("ref_calling"), F.col("alt_calling"), F.col("drug_ref")
    alts = F.split("alt_calling", ",")
    one, two = F.get(alts, F.lit(0)), F.get(alts, F.lit(1))
    shallow = F.col("dp") < F.col("depth_threshold")
    kind = variant_type(ref, alt, "star")
    base = F.col("ref_allele")

    def tail(text: Column, skip: Column | int = 1) -> Column:
        skip = F.lit(skip) if isinstance(skip, int) else skip
        return F.substr(text, skip + 1)

    gone = F.concat(F.lit("del"), tail(ref))
    come = F.concat(F.lit("ins"), tail(alt))

    def spelled(z: Column) -> Column:
        het = F.when(kind == "del", _pair(base, gone)).when(kind == "ins", _pair(F.lit("del"), come)).otherwise(_pair(ref, alt))
        hom = F.when(kind == "del", _pair(gone, gone)).when(kind == "ins", _pair(come, come)).otherwise(_pair(alt, alt))
        return F.when(z == "het", het).when(z == "hom", hom).otherwise(_pair(base, base))

    k1, k2 = variant_type(ref, one, "star"), variant_type(ref, two, "star")
    any_del, any_ins = (k1 == "del") | (k2 == "del"), (k1 == "ins") | (k2 == "ins")

    def piece(a: Column) -> Column:
        return (
            F.when(any_del, F.concat(F.lit("del"), tail(ref, F.length(a))))
            .when(any_ins, F.concat(F.lit("ins"), tail(a)))
            .otherwise(a)
        )

    use = F.col("corrected") == "yes"
    pick1 = F.when(use & (winner == 2), piece(two)).otherwise(piece(one))
    pick2 = F.when(use & (winner == 1), piece(one)).otherwise(piece(two))
    star = F.when(shallow, "./.").when(raw == "two", _pair(pick1, pick2)).otherwise(
        spelled(F.when(use, fixed).otherwise(raw))
    )
    genotype = (
        F.when(raw == "ref", _pair(drug, drug))
        .when(raw == "het", _pair(ref, alt))
        .when(raw == "hom", _pair(alt, alt))
        .otherwise(_pair(one, two))
    )
    better = (
        F.when((raw == "het") & (fixed == "hom"), _pair(alt, alt))
        .when((raw == "het") & (fixed == "ref"), _pair(drug, drug))
        .when((raw == "hom") & (fixed == "het"), _pair(ref, alt))
        .when((raw == "two") & (winner == 1), _pair(one, one))
        .when((raw == "two") & (winner == 2), _pair(two, two))
        .otherwise(genotype)
    )
    gt_fixed = (
        F.when(shallow, F.col("gt"))
        .when(raw.isin("het", "hom") & (fixed != raw), F.when(fixed == "hom", "1/1").when(fixed == "ref", "0/0").otherwise("0/1"))
        .when((raw == "two") & (winner > 0), "1/1")
        .otherwise(F.col("gt"))
    )
    return site.select(
        "*",
        genotype.alias("genotype"),
        gt_fixed.alias("gt_corrected"),
        F.when(shallow, "Fail").when(use, better).otherwise(genotype).alias("genotype_corrected"),
        star.alias("star_allele"),
    )


def _carries(allele: Column, wanted: Column) -> Column:
    out = allele == wanted
    for code, bases in DEGENERATE.items():
        out = F.when(wanted == code, F.lit(bases).contains(allele)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def star_site_matches(sites: DataFrame, star_map: DataFrame) -> DataFrame:
    """Every (sample, star, position) with the two-sided match verdict."""
    parts = F.split("star_allele", "/")
    one, two = _carries(F.get(parts, F.lit(0)), F.col("allele")), _carries(F.get(parts, F.lit(1)), F.col("allele"))

    def word(c: Column) -> Column:
        return F.when(c, "yes").otherwise("no")

    return sites.join(star_map, "position").select(
        "sample",
        "star",
        "position",
        "star_allele",
        F.col("allele").alias("star_map"),
        F.concat_ws("/", word(one), word(two)).alias("matched"),
    )


def star_match(sites: DataFrame, star_map: DataFrame) -> DataFrame:
    """Star alleles whose defining positions all match, per sample.

    ``sites`` (sample, position, star_allele); ``star_map`` (star, ordinal,
    position, allele).  A one-sided match counts once; a star matching on both
    sides everywhere is listed twice.  Relational division by counting.
    """
    need = star_map.groupBy("star").agg(F.count(F.lit(1)).alias("need"), F.min("ordinal").alias("ordinal"))
    hits = star_site_matches(sites, star_map).groupBy("sample", "star").agg(
        F.sum(F.col("matched").contains("yes").cast("int")).alias("any_side"),
        F.sum((F.col("matched") == "yes/yes").cast("int")).alias("both_sides"),
    )
    full = hits.join(need, "star").where("any_side = need")
    named = F.when(F.col("both_sides") == F.col("need"), F.concat_ws("/", "star", "star")).otherwise(F.col("star"))
    # a sample matches at most as many stars as the table has
    listed = full.groupBy("sample").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", named.alias("name")))).alias("l")
    )
    everyone = sites.select("sample").distinct()
    return everyone.join(listed, "sample", "left").select(
        "sample", F.coalesce(F.array_join(F.transform("l", lambda x: x["name"]), "/"), F.lit("")).alias("star")
    )


def star_with_copy(star, copies) -> Column:
    """Star text after the gene's copy number: 0 → two deletions, 1 → one, sorted."""
    s, n = F.col(star), F.col(copies).cast("string")
    one = F.array_join(F.array_sort(F.array_union(F.split(s, "/"), F.array(F.lit("*5")))), "/")
    return F.when(n == "0", "*5/*5").when(n == "1", one).otherwise(s)


def star_map_stats(star_map: DataFrame) -> DataFrame:
    """Defining and degenerate positions of each star allele with their counts."""
    ordered = F.array_sort(
        F.collect_list(F.struct("place", F.col("position").cast("string").alias("position"), "allele"))
    )
    df = star_map.groupBy("star").agg(ordered.alias("l"))
    vague = F.filter("l", lambda x: x["allele"].isin(*DEGENERATE))

    def names(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda x: x["position"]), "|")

    return df.select(
        "star",
        names(F.col("l")).alias("specific_variant"),
        F.size("l").alias("specific_variant_count"),
        names(vague).alias("degenerate_variant"),
        F.size(vague).alias("degenerate_variant_count"),
    )


def star_map_long(wide: DataFrame, star: str, positions: Sequence[str]) -> DataFrame:
    """Wide star table (one column per position) → (star, ordinal, place, position, allele)."""
    entries = [
        F.struct(F.lit(i).alias("place"), F.lit(p).alias("position"), F.col(f"`{p}`").cast("string").alias("allele"))
        for i, p in enumerate(positions)
    ]
    return (
        wide.select(F.col(star).alias("star"), "ordinal", F.explode(F.array(*entries)).alias("e"))
        .select("star", "ordinal", "e.*")
        .where("allele is not null")
    )


def indel_classifier_fit(
    train: DataFrame, label: str = "known", folds: int = 10, rounds: int = 50, fold: Column | None = None
) -> tuple[BoostedStumps, float]:
    """Boosted stumps on the three indel features and the least accuracy over the folds.

    NaN without a fold that holds rows; see ``boosted_stumps`` for nulls and ties.
    """
    model = boosted_stumps(train, ACE_FEATURES, label, rounds, folds=folds, fold=fold)
    return model, min(model.accuracy.values(), default=float("nan"))


def indel_classifier_predict(model: BoostedStumps, features: DataFrame) -> DataFrame:
    """I/I, I/D or D/D per row of the three features; null where one is missing."""
    return model.predict(features, "genotype")


def known_long(known: DataFrame, ids: Sequence[str], sample: str = "sample") -> DataFrame:
    """Known genotypes, one column per variant id → (sample, id, known)."""
    entries = [F.struct(F.lit(i).alias("id"), F.col(f"`{i}`").alias("known")) for i in ids]
    return known.select(F.col(sample).alias("sample"), F.explode(F.array(*entries)).alias("e")).select("sample", "e.*")


def genotype_consistency(calls: DataFrame, known: DataFrame, genotype: str = "genotype") -> DataFrame:
    """Called genotype against a known one in either allele order; '-' when unknown.

    ``calls`` (sample, id, ref, alt text, genotype); ``known`` (sample, id, known).
    """
    df = calls.join(known, ["sample", "id"], "left")
    plain = F.replace(F.col(genotype), F.lit("/"), F.lit(""))
    turned = F.array_join(F.reverse(F.split(genotype, "/")), "")
    k = F.col("known")
    homs = F.transform(F.split("alt", ","), lambda a: F.concat(a, a))
    verdict = (
        F.when(k.isNull(), "-").when((k == plain) | (k == turned), "yes").when(k == "-", "-").otherwise("no")
    )
    label = (
        F.when(k.isNull(), "-")
        .when(k == F.concat("ref", "ref"), "ref")
        .when(F.array_contains(homs, k), "hom")
        .when(k == "-", "-")
        .otherwise("het")
    )
    return df.select(
        *calls.columns, F.coalesce(k, F.lit("-")).alias("known"), label.alias("known_gt"), verdict.alias("consistence")
    )


def indel_consistency(calls: DataFrame, known: DataFrame, genotype: str = "genotype") -> DataFrame:
    """Genotype text as D/D, I/D or I/I beside the known one (``known``: a row per sample, broadcast)."""
    g = F.replace(F.col(genotype), F.lit("/"), F.lit(""))
    ace = F.when(g == F.concat("ref", "ref"), "D/D").when(g == F.concat("ref", "alt"), "I/D").otherwise("I/I")
    return calls.join(F.broadcast(known), "sample", "left").select(
        *calls.columns, ace.alias("ace"), F.coalesce("known", F.lit("-")).alias("known")
    )


def collect_solutions(lines: DataFrame, info: DataFrame) -> DataFrame:
    """First solution of a star caller's report per sample, '-' when there is none.

    ``lines`` (path, value); ``info`` (sampleID, sample, result path).
    """
    found = lines.where(F.col("value").contains("#Solution 1:")).groupBy("path").agg(
        F.min(F.get(F.split("value", ": "), F.lit(1))).alias("_s")
    )
    return info.join(found, info["result"] == found["path"], "left").select(
        *[c for c in info.columns if c != "result"], F.coalesce("_s", F.lit("-")).alias("CYP2D6")
    )


def collect_hla(lines: DataFrame, info: DataFrame) -> DataFrame:
    """Typed HLA genes per sample: lines without "Couldn", first three fields, distinct."""
    parts = F.split("value", "\t")
    rows = lines.where(~F.col("value").contains("Couldn")).select(
        "path",
        parts[0].alias("Gene"),
        F.get(parts, F.lit(1)).alias("Allele1"),
        F.get(parts, F.lit(2)).alias("Allele2"),
    ).distinct()
    return rows.join(info, rows["path"] == info["result"]).drop("path", "result")
