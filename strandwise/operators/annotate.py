"""Variant annotation joins, representations and HGVS coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import col, q, round_even
from strandwise.functions.running import running
from strandwise.functions.sequence_text import complement, reverse_complement
from strandwise.operators.intervals import overlap_join
from strandwise.sources.sequence import base_at, sequence_at

SITE = ("chrom", "pos", "ref", "alt")
# Field order of an effect annotation when the header gives none.
ANN_FIELDS = (
    "Allele", "Annotation", "Annotation_Impact", "Gene_Name", "Gene_ID", "Feature_Type", "Feature_ID",
    "Transcript_BioType", "Rank", "HGVS.c", "HGVS.p", "cDNA.pos/cDNA.length", "CDS.pos/CDS.length",
    "AA.pos/AA.length", "Distance", "ERRORS/WARNINGS/INFO",
)
# The mitochondrial accession and its contig spellings.
MITO = "NC_012920.1"
MITO_NAMES = ("MT", "chrMT", "chrM_NC_012920.1")


def ann_fields(description: str) -> list[str]:
    """Field names out of the quoted list in an INFO header description."""
    quoted = description.split("'")
    return [f.strip().replace(" ", "") for f in quoted[1].split("|")] if len(quoted) > 2 else list(ANN_FIELDS)


def explode_ann(calls: DataFrame, fields: Sequence[str] = ANN_FIELDS) -> DataFrame:
    """One row per effect annotation x sample of long calls with an info map."""
    entry = F.split("_ann", "\\|")

    def field(name: str) -> Column:
        return F.get(entry, F.lit(list(fields).index(name)))

    gt = F.translate("gt", "|", "/")
    called = (gt != "./.") & F.col("ad").isNotNull()
    depth = F.aggregate("ad", F.lit(0).cast("long"), lambda acc, x: acc + x)
    return (
        calls.where(~F.array_contains("alt", "*"))
        .withColumn("_ann", F.explode(F.split(F.try_element_at("info", F.lit("ANN")), ",")))
        .select(
            "chrom",
            "pos",
            "ref",
            F.array_join("alt", ",").alias("alt"),
            "var_type",
            "sample",
            gt.alias("GT"),
            F.when(called, depth).alias("DP"),
            F.when(called, F.array_join(F.col("ad").cast("array<string>"), ",")).alias("AD"),
            field("Allele").alias("Allele"),
            field("Annotation").alias("Function"),
            field("Gene_Name").alias("Gene Symbol"),
            field("Feature_ID").alias("Transcript"),
            field("HGVS.c").alias("HGVS.c"),
            field("HGVS.p").alias("HGVS.p"),
        )
    )


def filter_annotation(
    ann: DataFrame, gene_trans: DataFrame, common: DataFrame, info: DataFrame, genes: Sequence[str], trio: str,
    order: str = "ord",
) -> DataFrame:
    """Annotations of the wanted genes for parents, current proband and embryos.

    Symbol and transcript are tested separately, as membership in the gene's lists;
    "HLA" has no table.  One row per matching gene of interest.  Of several ``info`` rows
    of a sample the first counts, by ``order``, the place in the sheet.
    """
    first = info.groupBy("sampleID").agg(F.min_by("sample", order).alias("sample"))
    wanted = first.where(
        F.col("sample").isin("Father", "Mother")
        | (F.concat_ws("_", "sample", "sampleID") == trio)
        | F.col("sample").contains("Embryo")
    ).select("sample", "sampleID")
    named = ann.join(common.select("Common Name", "Transcript", F.col("`HGVS.c`")), ["Transcript", "HGVS.c"], "left")
    rows = named.join(wanted, "sample")
    table = gene_trans.where(F.col("gene").isin(*[g for g in genes if g != "HLA"]))
    symbols = table.select("gene", "Gene Symbol").distinct()
    transcripts = table.select("gene", "Transcript").distinct()
    return rows.join(symbols, "Gene Symbol").join(transcripts, ["gene", "Transcript"], "left_semi")


def add_rsid(hap: DataFrame, dbsnp: DataFrame) -> DataFrame:
    """Add ``dbSNP`` by exact site and alleles."""
    return hap.join(dbsnp.select(*SITE, "dbSNP"), list(SITE), "left")


def _single(name: str) -> Column:
    return F.upper(name).isin("A", "C", "G", "T")


def score_join(variants: DataFrame, scores: DataFrame, style: str = "table") -> DataFrame:
    """Add ``dbSCSNV`` text ``ada|rf`` (table) or ``ALT|ada|rf`` (vcf); '.' where missing.

    The score table is joined on the exact site; Spark picks the join by its size.
    """
    keyed = scores.select(*SITE, F.col("ada").cast("string").alias("_a"), F.col("rf").cast("string").alias("_r"))
    joined = variants.join(keyed, list(SITE), "left")
    use = _single("ref") & _single("alt") if style == "vcf" else F.lit(True)
    parts = [F.coalesce(F.when(use, F.col(c)), F.lit(".")) for c in ("_a", "_r")]
    lead = [F.col("alt")] if style == "vcf" else []
    return joined.select(*variants.columns, F.concat_ws("|", *lead, *parts).alias("dbscSNV"))


def score_join_multi(variants: DataFrame, snv: DataFrame, indel: DataFrame) -> DataFrame:
    """Add ``SpliceAI``: all score texts of a variant joined by '/', contig without chr.

    Score tables hold (chrom, pos, ref, alt, ordinal, score).
    """
    one = F.col("ref").isin(*"ACGTacgt") & F.col("alt").isin(*"ACGTacgt")
    table = snv.where(one).unionByName(indel.where(~one))
    listed = table.groupBy(F.col("chrom").alias("_c"), "pos", "ref", "alt").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "score"))), lambda s: s["score"]), "/"
        ).alias("_s")
    )
    none = F.concat("alt", F.lit("|.|.|.|.|.|.|.|.|."))
    keyed = variants.withColumn("_c", F.replace(F.col("chrom"), F.lit("chr"), F.lit("")))
    return keyed.join(listed, ["_c", "pos", "ref", "alt"], "left").select(
        *variants.columns, F.coalesce("_s", none).alias("SpliceAI")
    )


def prepare_scores(raw: DataFrame, build: str = "hg19") -> DataFrame:
    """Score table of one genome build, main contigs only, laid out by position."""
    chrom, pos = ("chr", "pos") if build == "hg19" else ("hg38_chr", "hg38_pos")
    main = [f"chr{c}" for c in [*range(1, 23), "X", "Y"]]
    return (
        raw.select(
            F.concat(F.lit("chr"), F.col(chrom)).alias("chrom"),
            F.col(pos).cast("long").alias("pos"),
            "ref",
            "alt",
            F.col("ada_score").alias("ada"),
            F.col("rf_score").alias("rf"),
        )
        .where(F.col("chrom").isin(*main))
        .repartitionByRange("chrom", "pos")
        .sortWithinPartitions("chrom", "pos")
    )


def splice_window(
    variants: DataFrame, exons: DataFrame, ref_chunks: DataFrame, chunk_size: int
) -> DataFrame:
    """Donor or acceptor windows of SNVs with the reference and the mutated text.

    ``exons`` (chrom, start, stop 1-based closed, strand, gene, ordinal).  An exon
    under the variant wins; else one ending within 6 or starting within 20 bases,
    in the order donor +, acceptor +, donor -, acceptor -.  Windows: donor = last 3
    exon + 6 intron bases, acceptor = 20 intron + 3 exon bases, on the gene strand;
    the two splice bases and the mutated base are upper case.  What lies outside the contig reads N.
    """
    snv = variants.where(F.col("ref").isin(*"ACGTacgt") & F.col("alt").isin(*"ACGTacgt")).select(*SITE).distinct()
    offsets = (0, -6, 20, 6, -20)
    probes = F.array(
        *[F.struct(F.lit(i).alias("rank"), F.lit(o).alias("offset")) for i, o in enumerate(offsets)]
    )
    points = snv.withColumn("_p", F.explode(probes)).withColumn("start", F.col("pos") + F.col("_p.offset"))
    points = points.select(*SITE, F.col("_p.rank").alias("rank"), "start", (F.col("start") + 1).alias("stop"))
    closed = exons.select(
        "chrom", "start", (F.col("stop") + 1).alias("stop"), "strand", "gene", "ordinal"
    )
    exon = F.struct(F.col("b_start").alias("a"), (F.col("b_stop") - 1).alias("z"), "strand", "gene")
    hits = overlap_join(points, closed, long_intervals=True)
    found = hits.groupBy(*SITE).agg(
        *[F.min_by(F.when(F.col("rank") == i, exon), F.when(F.col("rank") == i, F.col("ordinal"))).alias(f"x{i}") for i in range(5)]
    )
    df = snv.join(found, list(SITE), "left")
    plus0 = F.col("x0.strand") == "+"
    pos, a, z = F.col("pos"), F.col("x0.a"), F.col("x0.z")
    kind0 = (
        F.when(plus0, F.when(pos + 2 >= z, "donor+").when(pos - 2 <= a, "acceptor+"))
        .otherwise(F.when(pos - 2 <= a, "donor-").when(pos + 2 >= z, "acceptor-"))
    )
    inside = F.col("x0").isNotNull()
    near = (
        F.when(F.col("x1.strand") == "+", "donor+")
        .when(F.col("x2.strand") == "+", "acceptor+")
        .when(F.col("x3.strand") == "-", "donor-")
        .when(F.col("x4.strand") == "-", "acceptor-")
    )
    kind = F.when(inside, kind0).otherwise(near)
    picked = (
        F.when(inside, F.col("x0"))
        .when(F.col("x1.strand") == "+", F.col("x1"))
        .when(F.col("x2.strand") == "+", F.col("x2"))
        .when(F.col("x3.strand") == "-", F.col("x3"))
        .when(F.col("x4.strand") == "-", F.col("x4"))
    )
    df = df.select(*SITE, kind.alias("kind"), picked.alias("e"))
    edge = F.when(F.col("kind").isin("donor+", "acceptor-"), F.col("e.z")).otherwise(F.col("e.a"))
    df = df.select(*SITE, "kind", F.col("e.gene").alias("gene"), edge.alias("edge"))
    k = F.col("kind")
    low = (
        F.when(k == "donor+", F.col("edge") - 2)
        .when(k == "acceptor+", F.col("edge") - 20)
        .when(k == "donor-", F.col("edge") - 6)
        .otherwise(F.col("edge") - 2)
    )
    width = F.when(k.startswith("donor"), 9).otherwise(23)
    outside = F.greatest(1 - low, F.lit(0))
    spans = df.where(k.isNotNull()).withColumn("start", low - 1 + outside).withColumn("stop", low - 1 + width)
    text = sequence_at(spans, ref_chunks, chunk_size, "_seq")
    minus = k.endswith("-")
    whole = F.rpad(F.concat(F.repeat(F.lit("N"), outside.cast("int")), "_seq"), width.cast("int"), F.lit("N"))
    seq = F.when(minus, reverse_complement(whole)).otherwise(whole)
    skip = F.when(k.startswith("donor"), 3).otherwise(18)
    marked = F.concat(
        F.lower(F.substr(seq, F.lit(1), skip)),
        F.substr(seq, skip + 1, F.lit(2)),
        F.lower(F.substr(seq, skip + 3)),
    )
    shift = F.when(k.startswith("donor"), 2).otherwise(20)
    index = F.when(minus, F.col("edge") - F.col("pos")).otherwise(F.col("pos") - F.col("edge")) + shift
    base = F.when(minus, complement(F.upper("alt"))).otherwise(F.col("alt"))
    shown = text.withColumn("wild", marked).withColumn("_i", index.cast("int")).withColumn("_b", base)
    mutant = F.concat(
        F.substr("wild", F.lit(1), F.col("_i")), F.col("_b"), F.substr("wild", F.col("_i") + 2)
    )
    windows = shown.select(
        *SITE, F.when(k.startswith("donor"), "ss5").otherwise("ss3").alias("site"), "wild", mutant.alias("mutant")
    )
    return df.select(*SITE, "gene").join(windows, list(SITE), "left")


def splice_score(windows: DataFrame, matrix: DataFrame) -> DataFrame:
    """Wild, mutant and relative score from a table (site, kmer upper case, score).

    A window with N, or missing from the table, has no score.
    """
    def looked(df: DataFrame, text: str, name: str) -> DataFrame:
        keyed = matrix.select("site", F.col("kmer").alias("_k"), F.col("score").alias(name))
        return df.withColumn("_k", F.upper(text)).join(keyed, ["site", "_k"], "left").drop("_k")

    df = looked(looked(windows, "wild", "_w"), "mutant", "_m")
    clear = ~F.upper(F.concat("wild", "mutant")).contains("N")
    w, m = F.when(clear, F.col("_w")), F.when(clear, F.col("_m"))
    return df.select(
        *windows.columns,
        round_even(w, 3).alias("score_wt"),
        round_even(m, 3).alias("score_mut"),
        round_even((m - w) / F.nullif(w, F.lit(0.0)), 3).alias("score_rel"),
    )


def select_transcripts(exons: DataFrame, tag: str = "RefSeq Select") -> DataFrame:
    """Exons of the tagged transcript, else of the gene's longest (ties: smallest id).

    ``exons`` (chrom, start, stop closed, strand, gene, tx, tag).
    """
    tagged = exons.where(F.col("tag") == tag)
    genes = tagged.select("gene").distinct()
    rest = exons.join(genes, "gene", "left_anti").where(F.col("tx").isNotNull() & (F.col("tx") != "."))
    sizes = rest.groupBy("gene", "tx").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("_n"))
    longest = sizes.groupBy("gene").agg(F.min_by("tx", F.struct(-F.col("_n"), F.col("tx"))).alias("tx"))
    return tagged.unionByName(rest.join(longest, ["gene", "tx"], "left_semi"))


def pick_transcript_version(
    related: DataFrame, wanted: DataFrame | None, how: str = "all", key: Sequence[str] = ("variant",), no_overlap: str = "all"
) -> DataFrame:
    """Transcripts to report per variant: newest version of each wanted accession.

    ``related`` (key, ordinal, tx); ``wanted`` (accession without version).  how:
    first keeps one.  Without any wanted accession: the first, or with ``all`` every
    related one (``no_overlap='none'``: nothing).
    """
    key = list(key)
    parts = F.split("tx", "\\.")
    rows = related.withColumn("_base", parts[0]).withColumn("_version", F.get(parts, F.lit(1)).cast("int"))
    if wanted is None:
        if how == "first":
            return related.groupBy(*key).agg(F.min_by("tx", "ordinal").alias("tx"))
        return related.select(*key, "tx")
    names = wanted.select(F.col("accession").alias("_base")).distinct().withColumn("_want", F.lit(True))
    flagged = rows.join(names, "_base", "left")
    some = flagged.groupBy(*key).agg(
        F.max(F.coalesce("_want", F.lit(False))).alias("_any"), F.min_by("tx", "ordinal").alias("_first")
    )
    hits = flagged.where("_want").groupBy(*key, "_base").agg(F.max_by("tx", "_version").alias("tx"))
    if how == "first":
        top = hits.groupBy(*key).agg(F.max_by("tx", "_base").alias("tx"))
        return some.join(top, key, "left").select(*key, F.coalesce("tx", "_first").alias("tx"))
    out = hits.select(*key, "tx")
    if no_overlap == "none":
        return out
    bare = some.where("not _any").select(*key)
    return out.unionByName(related.join(bare, key, "left_semi").select(*key, "tx"))


def variant_type(ref, alt, style: str = "hgvs") -> Column:
    """Variant class in one of three vocabularies.

    hgvs: dotted alleles, ins/del/snv/delins/ref.  vcf: anchored alleles,
    snv/ins/del/delins_eq/delins_neq.  star: del/ins/ref/snp/delins.
    """
    r, a = col(ref), col(alt)
    nr, na = F.length(r), F.length(a)
    if style == "hgvs":
        return (
            F.when(r == ".", "ins").when(a == ".", "del").when(r == a, "ref")
            .when((nr == 1) & (na == 1), "snv").otherwise("delins")
        )
    same = F.substring(r, 1, 1) == F.substring(a, 1, 1)
    if style == "vcf":
        return (
            F.when((nr == 1) & (na == 1), "snv")
            .when(~same, "delins_neq")
            .when(nr == 1, "ins")
            .when(na == 1, "del")
            .otherwise("delins_eq")
        )
    if style == "star":
        return (
            F.when((nr > 1) & (na == 1), "del").when((nr == 1) & (na > 1), "ins")
            .when((r == ".") | (a == "."), "ref").when((nr == 1) & (na == 1), "snp").otherwise("delins")
        )
    raise ValueError(f"unknown style: {style}")


def to_vcf(df: DataFrame, ref_chunks: DataFrame, chunk_size: int, style: str = "one_based") -> DataFrame:
    """Dotted or empty alleles → anchored POS, REF, ALT.

    one_based: (chrom, start, ref, alt), start = the variant's own first base; only
    insertions and deletions get an anchor (REF, ALT replace ref, alt).  bed: (chrom, start, stop, ref, alt) with
    0-based start; mixed changes are anchored too.
    """
    empty_ref = F.col("ref").isNull() | (F.col("ref") == ".")
    empty_alt = F.col("alt").isNull() | (F.col("alt") == ".")
    single = (F.length("ref") == 1) & (F.length("alt") == 1)
    kind = F.when(empty_ref, "ins").when(empty_alt, "del").when(single, "snv").otherwise("delins")
    df = df.withColumn("_kind", kind)
    k = F.col("_kind")
    if style == "one_based":
        at = F.when(k == "del", F.col("start") - 1).otherwise(F.col("start"))
        anchored = k.isin("ins", "del")
    elif style == "bed":
        at = F.when(k.isin("ins", "snv"), F.col("stop")).otherwise(F.col("start"))
        anchored = k != "snv"
    else:
        raise ValueError(f"unknown style: {style}")
    df = base_at(df.withColumn("POS", at), ref_chunks, chunk_size, "POS", "_base")
    base = F.upper("_base")

    def allele(name: str, empty: Column) -> Column:
        own = F.when(empty, "").otherwise(F.col(name))
        return F.when(anchored, F.concat(base, own)).otherwise(F.col(name))

    kept = [c for c in df.columns if c not in ("_base", "_kind", "POS", "ref", "alt")]
    return df.select(*kept, "POS", allele("ref", empty_ref).alias("REF"), allele("alt", empty_alt).alias("ALT"))


def vcf_to_vep(df: DataFrame) -> DataFrame:
    """Add ``Uploaded_variation``: anchors dropped from pure insertions and deletions."""
    kind = variant_type("ref", "alt", "vcf")
    bare = kind.isin("ins", "del")
    ref = F.when(kind == "ins", "-").when(kind == "del", F.expr("substring(ref, 2)")).otherwise(F.col("ref"))
    alt = F.when(kind == "ins", F.expr("substring(alt, 2)")).when(kind == "del", "-").otherwise(F.col("alt"))
    pos = F.when(bare, F.col("pos") + 1).otherwise(F.col("pos"))
    return df.withColumn(
        "Uploaded_variation", F.concat("chrom", F.lit("_"), pos.cast("string"), F.lit("_"), ref, F.lit("/"), alt)
    )


def vcf_to_bed_style(df: DataFrame) -> DataFrame:
    """Add #Chr, Start, Stop, Ref, Call: 0-based half-open with '.' for an empty allele."""
    kind = variant_type("ref", "alt", "vcf")
    shared = kind.isin("ins", "del", "delins_eq")
    rest_ref, rest_alt = F.expr("substring(ref, 2)"), F.expr("substring(alt, 2)")
    start = F.when(shared, F.col("pos")).otherwise(F.col("pos") - 1)
    ref = F.when(kind == "ins", ".").when(shared, rest_ref).otherwise(F.col("ref"))
    call = F.when(kind == "del", ".").when(shared, rest_alt).otherwise(F.col("alt"))
    stop = F.when(kind == "ins", F.col("pos")).otherwise(start + F.length(ref))
    kept = [c for c in df.columns if c not in ("ref", "alt")]
    return df.select(
        *kept, F.col("chrom").alias("#Chr"), start.alias("Start"), stop.alias("Stop"), ref.alias("Ref"), call.alias("Call")
    )


def contig_names(build: str = "GRCh37") -> dict[str, str]:
    """Contig name → accession; both spellings, from the numbering rule of the build."""
    # Version of each accession NC_000001 … NC_000024 per build.
    versions = {
        "GRCh37": "10 11 11 11 9 11 13 10 11 10 9 11 10 8 9 9 10 9 9 10 8 10 10 9",
        "GRCh38": "11 12 12 12 10 12 14 11 12 11 10 12 11 9 10 10 11 10 10 11 9 11 11 10",
    }[build].split()
    out = {}
    for i, v in enumerate(versions, start=1):
        name = {23: "X", 24: "Y"}.get(i, str(i))
        out[name] = out[f"chr{name}"] = f"NC_{i:06d}.{v}"
    return {**out, **dict.fromkeys(MITO_NAMES, MITO)}


def map_contig(df: DataFrame, source: str, target: str, build: str = "GRCh37", to: str = "accession") -> DataFrame:
    """Add the accession of a contig name, or the chr name of an accession.

    The map has a few dozen fixed entries and is a literal, not a join.
    """
    names = contig_names(build)
    if to == "name":
        names = {acc: n for n, acc in names.items() if n.startswith("chr")}
    literal = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.withColumn(target, F.try_element_at(literal, F.col(source)))


def genomic_hgvs(chrom, start, stop, ref, alt, accession) -> Column:
    """g. (m. on the mitochondrion) text from 0-based start, stop and dotted alleles."""
    c, s, e, r, a, ac = (col(x) for x in (chrom, start, stop, ref, alt, accession))
    kind = variant_type(r, a)
    head = F.concat(ac, F.when(c.contains("M"), ":m.").otherwise(":g."))
    first = (s + 1).cast("string")
    span = F.concat(first, F.lit("_"), e.cast("string"))
    change = F.concat(head, e.cast("string"), r, F.lit(">"), a)
    return (
        F.when(kind == "snv", change)
        .when(kind == "del", F.concat(head, F.when(s + 1 == e, e.cast("string")).otherwise(span), F.lit("del")))
        .when(kind == "delins", F.concat(head, span, F.lit("delins"), a))
        .when(kind == "ref", F.when((F.length(r) == 1) & (F.length(a) == 1), change).otherwise("."))
        .otherwise(F.concat(head, s.cast("string"), F.lit("_"), first, F.lit("ins"), a))
    )


_EDIT = r"([ACGTN]*)(>|delins|del|ins|dup)([ACGTN]*)$"


def _edit_fields(edit: Column, low: Column, high: Column) -> dict[str, Column]:
    """Start, Stop, Ref, Call, MuType of an edit over the closed span low..high."""
    before, op, after = (F.regexp_extract(edit, _EDIT, i) for i in (1, 2, 3))
    dot = F.lit(".")

    def text(x: Column) -> Column:
        return F.when(x == "", dot).otherwise(x)

    insert, dup = op == "ins", op == "dup"
    return {
        "Start": F.when(dup, high).when(insert, low).otherwise(low - 1),
        "Stop": F.when(insert, low).otherwise(high),
        "Ref": F.when(insert | dup, dot).when(op == ">", before).when(op == "del", text(after)).otherwise(dot),
        "Call": F.when(op == "del", dot).otherwise(text(after)),
        "MuType": F.when(op == ">", "sub").otherwise(op),
    }


def parse_genomic_hgvs(df: DataFrame, source: str = "variant") -> DataFrame:
    """g. text → #Chr, Start, Stop, Ref, Call, MuType, State; failures keep dots."""
    text = F.regexp_replace(source, " ", "")
    shape = r"^(NC_0+(\d+)\.\d+):[gm]\.(\d+)(?:_(\d+))?(" + _EDIT.rstrip("$") + r")$"
    ok = text.rlike(shape)
    number = F.regexp_extract(text, shape, 2)
    low = F.regexp_extract(text, shape, 3).try_cast("long")
    high = F.coalesce(F.nullif(F.regexp_extract(text, shape, 4), F.lit("")).try_cast("long"), low)
    name = F.when(number == "23", "X").when(number == "24", "Y").otherwise(number)
    fields = _edit_fields(F.regexp_extract(text, shape, 5), low, high)
    return df.select(
        "*",
        F.when(ok, name).otherwise(".").alias("#Chr"),
        *[F.when(ok, c.cast("string")).otherwise(".").alias(n) for n, c in fields.items()],
        F.when(ok, "success").otherwise("can not parse variant").alias("State"),
    )


def transcript_map(exons: DataFrame) -> DataFrame:
    """Exons with their place in the transcript: tx_start, tx_stop (1-based closed).

    ``exons`` (tx, exon_no in transcript order, start, stop closed …).
    """
    size = F.col("stop") - F.col("start") + 1
    out = running(exons, ["tx"], "exon_no", block=1000, sums={"tx_stop": size})
    return out.withColumn("tx_start", F.col("tx_stop") - size + 1)


_CODING = r"^([A-Z]{2}_\d+\.\d+):c\.([-*]?)(\d+)([+-]\d+)?(?:_([-*]?)(\d+)([+-]\d+)?)?(" + _EDIT.rstrip("$") + r")$"


def coding_to_genomic(df: DataFrame, tx_exons: DataFrame, source: str = "variant") -> DataFrame:
    """c. text → genomic coordinates through a transcript exon table.

    ``tx_exons`` comes from ``transcript_map`` with accession, strand, cds_start and
    cds_stop (transcript positions of the coding ends).  Intronic offsets, UTR
    positions, sub, del, ins, dup and delins; minus-strand bases are complemented.
    """
    text = F.regexp_replace(source, " ", "")

    def part(i: int) -> Column:
        return F.regexp_extract("_text", _CODING, i)

    rows = df.select(*df.columns).distinct().withColumn("_text", text)
    ok = F.col("_text").rlike(_CODING)
    two = part(6) != ""
    parsed = rows.where(ok).select(
        *df.columns,
        part(1).alias("tx"),
        F.array(
            F.struct(F.lit(0).alias("end"), part(2).alias("zone"), part(3).try_cast("long").alias("n"), F.coalesce(part(4).try_cast("long"), F.lit(0)).alias("off")),
            F.struct(
                F.lit(1).alias("end"),
                F.when(two, part(5)).otherwise(part(2)).alias("zone"),
                F.when(two, part(6)).otherwise(part(3)).try_cast("long").alias("n"),
                F.coalesce(F.when(two, part(7)).otherwise(part(4)).try_cast("long"), F.lit(0)).alias("off"),
            ),
        ).alias("_ends"),
        part(8).alias("_edit"),
    )
    ends = parsed.select(*df.columns, "tx", "_edit", F.explode("_ends").alias("e"))
    cds = tx_exons.groupBy("tx").agg(
        F.first("cds_start").alias("cds_start"), F.first("cds_stop").alias("cds_stop")
    )
    at = (
        F.when(F.col("e.zone") == "-", F.col("cds_start") - F.col("e.n"))
        .when(F.col("e.zone") == "*", F.col("cds_stop") + F.col("e.n"))
        .otherwise(F.col("cds_start") + F.col("e.n") - 1)
    )
    points = ends.join(cds, "tx").select(
        *df.columns, "tx", "_edit", "e", at.alias("start"), (at + 1).alias("stop")
    )
    table = tx_exons.select(
        "tx", F.col("tx_start").alias("start"), (F.col("tx_stop") + 1).alias("stop"), "accession", "strand",
        F.col("start").alias("g_start"), F.col("stop").alias("g_stop"),
    )
    hits = overlap_join(points, table, on=["tx"], long_intervals=False)
    inside = F.col("start") - F.col("b_start")
    plus = F.col("strand") == "+"
    spot = F.when(plus, F.col("g_start") + inside + F.col("e.off")).otherwise(
        F.col("g_stop") - inside - F.col("e.off")
    )
    both = hits.groupBy(*df.columns).agg(
        F.min(spot).alias("_low"), F.max(spot).alias("_high"), F.count(F.lit(1)).alias("_n"),
        F.first("accession").alias("_ac"), F.first("strand").alias("_strand"), F.first("_edit").alias("_edit"),
    )
    before, op, after = (F.regexp_extract("_edit", _EDIT, i) for i in (1, 2, 3))

    def turned(x: Column) -> Column:
        return F.when(F.col("_strand") == "-", reverse_complement(x)).otherwise(x)

    edit = F.concat(turned(before), op, turned(after))
    fields = _edit_fields(edit, F.col("_low"), F.col("_high"))
    place = F.when(F.col("_low") == F.col("_high"), F.col("_low").cast("string")).otherwise(
        F.concat(F.col("_low").cast("string"), F.lit("_"), F.col("_high").cast("string"))
    )
    number = F.regexp_extract("_ac", r"NC_0+(\d+)\.\d+", 1)
    name = F.when(number == "23", "X").when(number == "24", "Y").otherwise(number)
    done = both.where("_n = 2").select(
        *df.columns,
        F.concat("_ac", F.lit(":g."), place, edit).alias("g."),
        name.alias("#Chr"),
        *[c.cast("string").alias(n) for n, c in fields.items()],
    )
    out = ["g.", "#Chr", *fields]
    state = (
        F.when(F.col("`g.`").isNotNull(), "success")
        .when(~F.regexp_replace(source, " ", "").rlike(_CODING), "can not parse variant")
        .otherwise("position not in transcript")
    )
    return df.join(done, df.columns, "left").select(
        *df.columns, *[F.coalesce(F.col(f"`{n}`"), F.lit(".")).alias(n) for n in out], state.alias("State")
    )


def expand_gene_transcripts(df: DataFrame, tx_exons: DataFrame) -> DataFrame:
    """Gene + c. rows on every transcript of the gene; unknown genes keep one row.

    ``df`` (gene, c); ``tx_exons`` also has gene.
    """
    known = tx_exons.select("gene", F.col("tx").alias("Transcript")).distinct()
    rows = df.join(known, "gene", "left").withColumn(
        "variant", F.concat(F.coalesce("Transcript", F.lit("")), F.lit(":"), F.regexp_replace("c", " ", ""))
    )
    out = coding_to_genomic(rows.where("Transcript is not null"), tx_exons)
    lost = rows.where("Transcript is null").withColumn(
        "State", F.lit("transcript not find! Please check your gene name!")
    )
    dots = {c: F.lit(".") for c in ("g.", "#Chr", "Start", "Stop", "Ref", "Call", "MuType")}
    lost = lost.withColumns(dots).withColumn("Transcript", F.lit("."))
    return out.unionByName(lost.select(*[q(c) for c in out.columns])).drop("variant")


def split_alts(sites: DataFrame) -> DataFrame:
    """One row per ALT with its number and dotted alleles; shared anchor base dropped.

    ``sites`` (chrom, pos, ref, alt array …) → alt_no, start, stop, ref_, call,
    var_type; every ALT starts from the record's own coordinates.
    """
    rows = sites.select("*", F.posexplode("alt").alias("alt_no", "_alt"))
    r, a = F.col("ref"), F.col("_alt")
    all_single = F.forall("alt", lambda x: F.length(x) == 1) & (F.length(r) == 1)
    nr, na = F.length(r), F.length(a)
    same = F.substring(r, 1, 1) == F.substring(a, 1, 1)
    kind = (
        F.when(all_single | ((nr == 1) & (na == 1)), "snv")
        .when((nr == 1) & (na > 1), "ins")
        .when((nr > 1) & (na == 1), "del")
        .otherwise("delins")
    )
    rest_r, rest_a = F.expr("substring(ref, 2)"), F.expr("substring(_alt, 2)")
    drop = (kind == "delins") & same
    ref = F.when(kind == "ins", ".").when((kind == "del") | drop, rest_r).otherwise(r)
    call = F.when(kind == "del", ".").when((kind == "ins") | drop, rest_a).otherwise(a)
    start = F.when((kind == "snv") | ((kind == "delins") & ~same), F.col("pos") - 1).otherwise(F.col("pos"))
    stop = F.when(kind == "ins", F.col("pos")).otherwise(F.col("pos") - 1 + nr)
    return rows.select(
        *sites.columns, "alt_no", start.alias("start"), stop.alias("stop"), ref.alias("ref_"), call.alias("call"), kind.alias("kind")
    )


def rejoin_alts(rows: DataFrame, key: Sequence[str], value: str, sep: str = ",") -> DataFrame:
    """Per-ALT values of a record in ALT order, joined by ``sep``."""
    ordered = F.array_sort(F.collect_list(F.struct("alt_no", F.col(value).cast("string").alias("v"))))
    return rows.groupBy(*key).agg(F.array_join(F.transform(ordered, lambda x: x["v"]), sep).alias(value))


def parse_splice_scores(df: DataFrame, info: str = "info") -> DataFrame:
    """Three scores out of a chained INFO text ``a;b;c`` of |-separated entries.

    MaxEntScan: minus the relative score.  dbscSNV: mean of the two, or the one
    present.  SpliceAI: the largest of the four, compared as numbers.
    """
    parts = F.split(info, ";")

    def cells(i: int) -> Column:
        return F.split(F.get(parts, F.lit(i)), "\\|")

    def number(c: Column) -> Column:
        return c.try_cast("double")

    one, two, three = cells(0), cells(1), cells(2)
    a, b = number(F.try_element_at(two, F.lit(-2))), number(F.try_element_at(two, F.lit(-1)))
    both = F.when(a.isNotNull() & b.isNotNull(), (a + b) / 2).otherwise(F.coalesce(a, b))
    return df.withColumn("MaxEntScan", -number(F.try_element_at(one, F.lit(-1)))).withColumn(
        "dbscSNV", both
    ).withColumn("SpliceAI", F.greatest(*[number(F.get(three, F.lit(i))) for i in range(2, 6)]))
