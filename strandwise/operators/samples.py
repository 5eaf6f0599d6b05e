"""Barcode splitting, sample sheets and report tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import q
from strandwise.functions.running import running
from strandwise.functions.sequence_text import reverse_complement

READ_LENGTH = 100  # bases before the barcode on the second read
_LETTERS = "ACGTN"
#: Texts near a barcode that one task makes and sorts.
TEXTS_A_TASK = 2_000_000
# Relation words of the sample sheet.
WIFE, HUSBAND, EMBRYO = "女方", "男方", "胚胎"
CHILD = ("儿子", "女儿", "孩子")
MALE_WORDS, FEMALE_WORDS = ("儿子", "父亲", "弟", "哥"), ("女儿", "母亲", "姐", "妹")
PROBAND_RELATION, DONE = "先证者", "已下机"


def barcode_table(barcodes: DataFrame, max_mismatch: int, length: int = 10) -> DataFrame:
    """Every text within ``max_mismatch`` of a barcode → the first such barcode.

    ``barcodes`` (ord, barcode, seq) as read from the sheet; sequences are
    reverse-complemented first.  Changed places become each other letter; the table
    has barcodes x sum C(length, k) 4^k rows and is built by Spark from the sheet.
    """
    masks = [places for k in range(max_mismatch + 1) for places in combinations(range(length), k)]
    rows = barcodes.select("ord", "barcode", reverse_complement("seq").alias("_s"))
    # a sheet is one small file whatever becomes of it, and one task would make all of its texts
    texts = sum(len(_LETTERS) ** len(m) for m in masks)
    tasks = barcodes.count() * texts // TEXTS_A_TASK + 1
    if tasks > 1:
        rows = rows.repartition(tasks, "ord", "barcode", "_s")
    near = None
    for k in range(max_mismatch + 1):
        places = F.explode(F.array(*[F.array(*[F.lit(p) for p in m]) for m in masks if len(m) == k])) if k else None
        fills = ["".join(x) for x in product(_LETTERS, repeat=k)]
        part = rows
        if k:
            part = part.withColumn("_p", places).withColumn("_f", F.explode(F.array(*[F.lit(x) for x in fills])))
            for j in range(k):
                part = part.withColumn(
                    "_s", F.overlay("_s", F.substring("_f", j + 1, 1), F.get("_p", F.lit(j)) + 1, F.lit(1))
                )
        part = part.select("ord", "barcode", F.col("_s").alias("tag"))
        near = part if near is None else near.unionByName(part)
    return near.groupBy("tag").agg(F.min_by("barcode", "ord").alias("barcode"))


def demultiplex(
    pairs: DataFrame, barcodes: DataFrame, max_mismatch: int = 1, length: int = 10, read_length: int = READ_LENGTH
) -> DataFrame:
    """Read pairs with their barcode; the second read loses the barcode part.

    The tag after ``read_length`` bases, which must be ``length`` long, is looked up in the table of allowed texts:
    one join for any number of reads, without comparing reads to barcodes.  The
    first barcode in sheet order wins; unmatched pairs are dropped.
    """
    tag = F.regexp_replace(F.substring("seq2", read_length + 1, length), "[^ACGTN]", "N")
    table = barcode_table(barcodes, max_mismatch, length)
    whole = pairs.where(F.length("seq2") == read_length + length)
    # Spark's size estimate of the table is that of the sheet: it is not to be broadcast
    out = whole.withColumn("tag", tag).join(table.hint("merge"), "tag").drop("tag")
    out = out.withColumn("seq2", F.substring("seq2", 1, read_length))
    if "qual2" in pairs.columns:
        out = out.withColumn("qual2", F.substring("qual2", 1, read_length))
    return out


def family_role(relation: Column) -> Column:
    """Role of a relation text; null when it is not a family role."""
    role = F.when(relation == WIFE, "Mother").when(relation == HUSBAND, "Father")
    for word in CHILD:
        role = role.when(relation.contains(word), "Proband")
    return (
        role.when(relation.contains(WIFE), "Maternal")
        .when(relation.contains(HUSBAND), "Paternal")
        .when(relation == EMBRYO, "Embryo")
    )


def member_gender(relation: Column) -> Column:
    def any_of(words: Sequence[str]) -> Column:
        return relation.rlike("|".join(words))

    return (
        F.when(relation == WIFE, "F").when(relation == HUSBAND, "M")
        .when(any_of(MALE_WORDS), "M").when(any_of(FEMALE_WORDS), "F").otherwise("unknown")
    )


def expand_sheet(sheet: DataFrame, data_dir: str) -> DataFrame:
    """Sequencing sheet → one row per read file of each family member.

    ``sheet`` (ordinal, family, progress, remark, relation, sampleID, barcode,
    chip, lane): an empty family repeats the one above; chips and lanes are
    '/'-separated and pair up; barcodes and lanes may be ranges a-b.  Embryos are
    numbered in sheet order within the family.
    """
    filled = running(
        sheet.withColumn("_one", F.lit(1)), ["_one"], "ordinal", 10_000, fills={"_family": F.col("family")}
    )
    rows = (
        filled.where((F.col("progress") == DONE) & F.col("remark").isNull())
        .withColumn("family", F.col("_family"))
        .withColumn("role", family_role(F.col("relation")))
    )
    numbered = running(
        rows, ["family"], "ordinal", 10_000, sums={"_no": (F.col("role") == "Embryo").cast("int")}
    )
    name = F.when(F.col("role") == "Embryo", F.concat("role", F.col("_no").cast("string"))).otherwise(F.col("role"))

    def span(text: Column) -> Column:
        ends = F.split(text, "-")
        return F.sequence(ends[0].cast("int"), F.element_at(ends, -1).cast("int"))

    lanes = F.transform(
        F.split("lane", "/"), lambda x: F.regexp_replace(x, "L0*", "")
    )
    runs = F.explode(F.arrays_zip(F.split("chip", "/").alias("chip"), lanes.alias("lane")))
    files = (
        numbered.select(
            "family", name.alias("sample"), "sampleID", "relation", member_gender(F.col("relation")).alias("gender"),
            F.explode(span(F.col("barcode"))).alias("b"), "chip", "lane",
        )
        .withColumn("r", runs)
        .withColumn("l", F.explode(span(F.col("r.lane"))))
    )
    lane = F.concat(F.lit("L"), F.lpad(F.col("l").cast("string"), 2, "0"))
    path = F.concat_ws(
        "/", F.lit(data_dir), F.col("r.chip"), lane,
        F.concat(F.concat_ws("_", F.col("r.chip"), lane, F.col("b").cast("string"), F.lit("1")), F.lit(".fq.gz")),
    )
    return files.select("family", "sample", "sampleID", path.alias("fq1"), "relation", "gender")


def add_proband_copies(info: DataFrame) -> DataFrame:
    """The sheet plus each embryo once more as a proband with ``-p`` on its id."""
    copies = (
        info.where(F.col("sample").contains("Embryo"))
        .withColumn("sample", F.lit("Proband"))
        .withColumn("sampleID", F.concat("sampleID", F.lit("-p")))
        .withColumn("relation", F.lit(PROBAND_RELATION))
    )
    return info.unionByName(copies)


def dedupe_samples(info: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    """First row of each key in source order (an aggregate, so no group is sorted)."""
    first = info.groupBy(*key).agg(F.min_by(F.struct(*info.columns), F.col(ordinal)).alias("_r"))
    return first.select(*[F.col("_r").getField(c).alias(c) for c in info.columns])


ANNOTATION_KEY = ("CHROM", "POS", "REF", "ALT", "sampleID", "Transcript", "HGVS.c")


def final_annotation(parts: Sequence[DataFrame], ordinal: str) -> DataFrame:
    """Union of annotation tables, first of each seven-column key, by position."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    key = [F.col(f"`{k}`") for k in ANNOTATION_KEY]
    first = out.groupBy(*key).agg(F.min_by(F.struct(*[q(c) for c in out.columns]), F.col(ordinal)).alias("_r"))
    rows = first.select(*[F.col("_r").getField(c).alias(c) for c in out.columns])
    return rows.orderBy("CHROM", "POS")


def order_trios(info: DataFrame, ordinal: str) -> DataFrame:
    """Third members in report order: grandmother, grandfather, others, paternal first;
    probands last; each sample once."""
    mother, father = F.col("relation").contains("母亲"), F.col("relation").contains("父亲")
    who = F.col("sample")
    rank = F.lit(None).cast("int")
    rank = F.when(who == "Proband", 6).otherwise(rank)
    for base, side in ((3, "Maternal"), (0, "Paternal")):
        place = F.when(mother, base).when(father, base + 1).otherwise(base + 2)
        rank = F.when(who == side, place).otherwise(rank)
    ranked = dedupe_samples(info, ["sampleID"], ordinal).withColumn("priority", rank)
    return ranked.where("priority is not null").withColumn(
        "ID", F.concat_ws("_", "sample", "sampleID")
    ).orderBy("priority", ordinal)


def haplotype_report(hap: DataFrame, members: Sequence[str]) -> DataFrame:
    """Informative SNPs with the members' alleles and the four haplotypes."""
    return hap.where("var_type = 'snp' and IF = 'yes'").select(
        "chrom", "pos", "dbSNP", "ref", F.array_join("alt", ",").alias("alt"),
        *[f"{m}_origin" for m in members],
        "F1", "F2", "M1", "M2", "Allele", "IF_filter", "Location",
    )
