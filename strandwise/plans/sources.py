"""Reader and writer queries (survey section 2.1), over files that Spark writes from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandwise.functions.stages import new_folder
from strandwise.operators.intervals import restrict_regions
from strandwise.plans.genotype import EMBRYOS, MEMBERS
from strandwise.plans.registry import query
from strandwise.sources import sequence, tables, vcf
from strandwise.sources.alignments import SAM_COLUMNS, read_sam
from strandwise.sources.layout import fetch_regions, write_by_position

_PEOPLE = [*MEMBERS, *EMBRYOS]


@query(
    "A1_read_table",
    """
select chrom, pos, case when site_id % 3 = 0 then null else ref end as ref, case when site_id % 5 = 0 then null else site_id / 4.0::double end as score from sites""",
)
def _(v):
    schema = T.StructType(
        [T.StructField("chrom", T.StringType()), T.StructField("pos", T.LongType()),
         T.StructField("ref", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    s = F.col("site_id")
    line = F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.when(s % 3 == 0, ".").otherwise(F.col("ref")),
        F.when(s % 5 == 0, ".").otherwise((s / 4).cast("string")),
    )
    rows = tables.parse_table(v("sites").select(line.alias("value")), schema, header="chrom\tpos\tref\tscore")
    path = new_folder(rows.sparkSession)
    tables.write_table(rows, path)
    return tables.read_table(rows.sparkSession, path, schema)


@query(
    "A2_read_bed",
    "select chrom, start, stop from (select chrom, start, stop from regions) t where chrom not like '%Y%' and chrom not like '%M%'",
)
def _(v):
    line = F.concat_ws("\t", "chrom", (F.col("start") + 1).cast("string"), F.col("stop").cast("string"))
    lines = v("regions").select(line.alias("value"))
    return tables.read_bed(lines.sparkSession, _saved(lines), one_based=True, windows=True)


def _saved(lines) -> str:
    """The lines as text files in a new folder."""
    path = new_folder(lines.sparkSession)
    lines.select("value").write.text(path)
    return path


def _vcf_lines(v, people):
    s = F.col("site_id")
    cell = F.when(F.col("gt") == "./.", "./.:.").otherwise(
        F.concat(F.col("gt"), F.lit(":"), F.col("ad0").cast("string"), F.lit(","), F.col("ad1").cast("string"), F.lit(":"),
                 (F.col("ad0") + F.col("ad1")).cast("string"))
    )
    sites = v("calls").groupBy("chrom", "pos", "ref", "alt", "filter", "site_id").agg(
        *[F.max(F.when(F.col("sample") == p, cell)).alias(p) for p in people]
    )
    line = F.concat_ws(
        "\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), "filter",
        F.concat(F.lit("QD=2.5;ID="), s.cast("string")), F.lit("GT:AD:DP"), *people,
    )
    return sites.select(line.alias("value"))


@query(
    "A3_read_vcf",
    """
select chrom, pos, ref, alt, sample, gt, case when gt <> './.' then ad0 end as ad0, case when gt <> './.' then ad1 end as ad1,
  case when gt <> './.' then ad0 + ad1 end as dp, filter, var_type, cast(site_id as varchar) as info_id from calls""",
)
def _(v):
    # parents and proband in one set of files, embryos in another
    paths = []
    for people in (MEMBERS, EMBRYOS):
        names = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *people])
        paths.append(_saved(vcf.headed(_vcf_lines(v, people), ["##fileformat=VCFv4.2", names])))
    rows = vcf.read_vcf(v("calls").sparkSession, paths)
    return rows.select(
        "chrom", "pos", "ref", F.col("alt")[0].alias("alt"), "sample", "gt", F.get("ad", F.lit(0)).alias("ad0"),
        F.get("ad", F.lit(1)).alias("ad1"), "dp", F.col("filter")[0].alias("filter"), "var_type",
        F.try_element_at("info", F.lit("ID")).alias("info_id"),
    )


@query(
    "A4_restrict_regions",
    """
select site_id from sites s where exists (select 1 from targets t where t.chrom = s.chrom and s.pos > t.start_extend + 9000 and s.pos <= t.end_extend)""",
)
def _(v):
    spans = v("targets").select("chrom", (F.col("start_extend") + 9000).alias("start"), F.col("end_extend").alias("stop"))
    return restrict_regions(v("sites"), spans).select("site_id")


@query(
    "A4_fetch_regions",
    """
select site_id from sites s where exists (select 1 from targets t where t.chrom = s.chrom and s.pos > t.start_extend + 9000 and s.pos <= t.end_extend)""",
)
def _(v):
    sites = v("sites")
    spans = v("targets").select("chrom", (F.col("start_extend") + 9000).alias("start"), F.col("end_extend").alias("stop"))
    path = new_folder(sites.sparkSession)
    write_by_position(sites, path)
    return fetch_regions(sites.sparkSession, path, sites.schema, spans).select("site_id")


@query(
    "A5_read_sam",
    "select qname, flag, rname, pos, cigar, seq, tlen, md from sam where flag & 2304 = 0",
)
def _(v):
    rows = v("sam").withColumn("mapq", F.lit(60))
    line = F.concat_ws(
        "\t", *[F.col(n).cast("string") for n, _ in SAM_COLUMNS], F.lit("NM:i:0"), F.concat(F.lit("MD:Z:"), "md")
    )
    return read_sam(rows.sparkSession, _saved(rows.select(line.alias("value")))).select(
        "qname", "flag", "rname", "pos", "cigar", "seq", "tlen", "md"
    )


@query("A6_read_fastp_json", "select sample, total_reads, raw_bases, q20 from fastp")
def _(v):
    head = F.concat_ws(
        "", F.lit('{"summary": {"before_filtering": {"total_bases": '), F.col("raw_bases").cast("string"),
        F.lit(', "q20_rate": '), F.col("q20").cast("string"),
        F.lit('}, "after_filtering": {"total_reads": '), F.col("total_reads").cast("string"), F.lit('}}, "other": [1]}'),
    )
    docs = v("fastp").select(F.concat(F.lit("/q/"), "sample", F.lit(".fastp.json")).alias("path"), head.alias("value"))
    return tables.parse_fastp_json(docs).select(
        "sample", "total_reads", "raw_bases", F.col("before_filtering.q20_rate").alias("q20")
    )


@query(
    "A7_read_report_kv",
    """
select sample as "sampleID", cast(raw_bases as varchar) as "Raw:", case when total_reads % 2 = 0 then 'even' end as "Parity:" from fastp""",
)
def _(v):
    lines = F.array(
        F.struct(F.lit(0).alias("line_no"), F.lit("Raw:\t0").alias("value")),
        F.struct(F.lit(1).alias("line_no"), F.concat(F.lit("   Raw:\t"), F.col("raw_bases").cast("string")).alias("value")),
        F.struct(F.lit(2).alias("line_no"), F.when(F.col("total_reads") % 2 == 0, "Parity:\teven").otherwise("Other:\t1").alias("value")),
    )
    rows = v("fastp").select(
        F.concat(F.lit("/s/"), "sample", F.lit(".stat")).alias("path"), F.explode(lines).alias("l")
    ).select("path", "l.*")
    return tables.parse_report_kv(rows, ["Raw:", "Parity:"])


@query(
    "A8_read_gff_exons",
    """
select chrom, start, stop, strand, gene, concat('e', cast(exon_no as varchar)) as id, case when tag = 'Select' then tag end as tag, tx from exons
where exon_no % 10 <> 3""",
)
def _(v):
    attrs = F.concat(
        F.lit("ID=e"), F.col("exon_no").cast("string"), F.lit(";gene="), "gene", F.lit(";"),
        F.when(F.col("tag") == "Select", "tag=Select;").otherwise(""), F.lit("transcript_id="), "tx",
    )
    kind = F.when(F.col("exon_no") % 10 == 3, "CDS").otherwise("exon")
    line = F.concat_ws(
        "\t", "chrom", F.lit("RefSeq"), kind, F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("."),
        "strand", F.lit("."), attrs,
    )
    lines = v("exons").select(line.alias("value"))
    return tables.read_gff_exons(lines.sparkSession, _saved(lines))


@query(
    "A9_read_fastq_pairs",
    """
select rec, concat('@r', cast(rec as varchar)) as name, seq1, repeat('I', length(seq1)) as qual1, seq2, repeat('F', length(seq2)) as qual2 from fq""",
)
def _(v):
    def lines(seq: str, mark: str):
        parts = F.array(
            F.concat(F.lit("@r"), F.col("rec").cast("string")), F.col(seq), F.lit("+"), F.repeat(F.lit(mark), F.length(seq))
        )
        return v("fq").select("rec", F.posexplode(parts).alias("i", "value")).select(
            (F.col("rec") * 4 + F.col("i")).alias("line_no"), "value"
        )

    def path(seq: str, mark: str) -> str:
        return _saved(lines(seq, mark).repartitionByRange("line_no").sortWithinPartitions("line_no"))

    pairs = tables.read_fastq_pairs(v("fq").sparkSession, path("seq1", "I"), path("seq2", "F"))
    # records are numbered in file order
    return pairs.withColumn("rec", F.regexp_extract("name", "[0-9]+", 0).cast("long"))


@query(
    "A10_union_by_glob",
    """
select sample, base_uni, null as c1, null as c4, 'a' as part from cover union all select sample, base_uni, c1, null, 'b' from cover
union all select sample, null, null, c4, 'c' from cover""",
)
def _(v):
    a = v("cover").select("sample", "base_uni", F.lit("a").alias("part"))
    b = v("cover").select("c1", "sample", "base_uni", F.lit("b").alias("part"))
    c = v("cover").select("c4", F.lit("c").alias("part"), "sample")
    return tables.union_by_name([a, b, c])


@query(
    "A10_union_by_glob_files",
    """
select sample, base_uni, case when size % 2 = 0 then 'a' else 'b' end as part from cover""",
)
def _(v):
    rows = v("cover").select("sample", "base_uni", F.when(F.col("size") % 2 == 0, "a").otherwise("b").alias("part"))
    path = new_folder(rows.sparkSession)
    tables.write_table(rows, path, by=["part"])
    schema = T.StructType([T.StructField("sample", T.StringType()), T.StructField("base_uni", T.LongType())])
    return tables.union_by_glob(rows.sparkSession, [f"{path}/part=*"], schema, {"part": "part=([^/]*)/"})


@query(
    "A11_write_table",
    """
select concat(chrom, chr(9), pos, chr(9), case when var_type = 'indel' then '.' else alt end) as value from sites""",
)
def _(v):
    rows = v("sites").select("chrom", "pos", F.when(F.col("var_type") != "indel", F.col("alt")).alias("alt"))
    path = new_folder(rows.sparkSession)
    tables.write_table(rows, path)
    return rows.sparkSession.read.text(path).where("value <> 'chrom\tpos\talt'")


@query(
    "A12_write_ndjson",
    """
select concat('{"chrom":"', chrom, '","pos":', pos, case when var_type = 'indel' then '' else concat(',"alt":"', alt, '"') end, '}') as value from sites""",
)
def _(v):
    rows = v("sites").select("chrom", "pos", F.when(F.col("var_type") != "indel", F.col("alt")).alias("alt"))
    path = new_folder(rows.sparkSession)
    tables.write_ndjson(rows, path)
    return rows.sparkSession.read.text(path)


@query(
    "A13_write_vcf_info",
    """
select concat_ws(chr(9), chrom, pos, '.', ref, alt, '.', filter, concat(case when site_id % 2 = 0 then concat('ID=', site_id, ';') else '' end, 'S=', alt, '|', length(alt))) as value from sites""",
)
def _(v):
    rows = v("sites").select(
        "chrom", "pos", F.lit(None).cast("string").alias("id"), "ref", "alt", F.lit(None).cast("string").alias("qual"), "filter",
        F.when(F.col("site_id") % 2 == 0, F.concat(F.lit("ID="), F.col("site_id").cast("string"))).alias("info"),
    )
    value = F.concat(F.col("alt"), F.lit("|"), F.length("alt").cast("string"))
    path = new_folder(rows.sparkSession)
    vcf.write_vcf_info(rows, ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"], "S", value, path)
    return rows.sparkSession.read.text(path).where(~F.col("value").startswith("#"))


@query(
    "A14_sequence_at",
    """
select region_id, substr(txt, g.start + 1, g.stop - g.start) as seq from regions g join ref_text t on g.chrom = t.chrom""",
)
def _(v):
    rows = v("regions").select("region_id", "chrom", "start", "stop")
    return sequence.sequence_at(rows, v("ref_chunks"), 12).select("region_id", "seq")


@query(
    "A14_base_at",
    """
select site_id, substr(txt, s.pos % 3000 + 100, 1) as base from sites s join ref_text t on s.chrom = t.chrom""",
)
def _(v):
    rows = v("sites").select("site_id", "chrom", (F.col("pos") % 3000 + 100).alias("p"))
    return sequence.base_at(rows, v("ref_chunks"), 12, "p", "base").select("site_id", "base")
