"""Annotation queries (survey section 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import annotate as an
from strandwise.plans.genotype import calls
from strandwise.plans.registry import query

_ANN_TEXT = """concat(alt, '|missense|', case when site_id % 2 = 0 then 'HIGH' else 'LOW' end, '|G', cast(site_id % 5 as string), '|id|transcript|NM_',
  cast(site_id % 7 as string), '|coding|1|c.', cast(site_id as string), 'A>G|p.X')"""
_ANN_TWO = f"concat({_ANN_TEXT}, ',', alt, '|intron|LOW|G9|id|transcript|NM_9|coding|2|c.9del|')"


def annotated(v):
    rows = calls(v).withColumn("_a", F.element_at("alt", 1))
    rows = rows.withColumn("info", F.create_map(F.lit("ANN"), F.expr(" ".join(_ANN_TWO.replace("concat(alt", "concat(_a").replace(", alt,", ", _a,").split()))))
    return an.explode_ann(rows.drop("_a"))


_ANN = """
select chrom, pos, ref, alt, sample, gt as "GT", case when gt <> './.' then ad0 + ad1 end as "DP",
  case when gt <> './.' then concat(ad0, ',', ad1) end as "AD", x.gene as "Gene Symbol", x.tx as "Transcript", x.hc as "HGVS.c"
from (select *, unnest([{'gene': concat('G', site_id % 5), 'tx': concat('NM_', site_id % 7), 'hc': concat('c.', site_id, 'A>G')},
  {'gene': 'G9', 'tx': 'NM_9', 'hc': 'c.9del'}]) as x from calls) t"""


@query("I1_explode_ann", _ANN)
def _(v):
    return annotated(v).select("chrom", "pos", "ref", "alt", "sample", "GT", "DP", "AD", "`Gene Symbol`", "Transcript", "`HGVS.c`")


@query(
    "I2_filter_annotation",
    f"""
select a.chrom, a.pos, a.sample, concat('ID', a.sample) as "sampleID", g.gene, a."Transcript",
  case when a."HGVS.c" = 'c.9del' then 'common' end as "Common Name"
from ({_ANN}) a join (select * from (values ('T1', 'G1'), ('T1', 'G9'), ('T2', 'G3')) as s(gene, sym)) g on g.sym = a."Gene Symbol"
where a.sample <> 'Proband' and ((g.gene = 'T1' and a."Transcript" in ('NM_1', 'NM_9', 'NM_3')) or (g.gene = 'T2' and a."Transcript" = 'NM_2'))""",
)
def _(v):
    ann = annotated(v)
    spark = ann.sparkSession
    trans = spark.createDataFrame(
        [("T1", "G1", "NM_1"), ("T1", "G9", "NM_9"), ("T1", "G1", "NM_3"), ("T2", "G3", "NM_2"), ("HLA", "G2", "NM_1")],
        "gene string, `Gene Symbol` string, Transcript string",
    )
    common = spark.createDataFrame([("common", "NM_9", "c.9del")], "`Common Name` string, Transcript string, `HGVS.c` string")
    info = ann.select("sample", F.concat(F.lit("ID"), "sample").alias("sampleID")).distinct()
    # the sheet names every sample again, later, as one that is not wanted
    info = info.withColumn("ord", F.lit(1)).unionByName(info.withColumn("ord", F.lit(2)).withColumn("sample", F.lit("Cousin")))
    out = an.filter_annotation(ann, trans, common, info, ["T1", "T2", "HLA"], "Proband_other")
    return out.select("chrom", "pos", "sample", "sampleID", "gene", "Transcript", "`Common Name`")


@query(
    "I3_add_rsid",
    """
select site_id, case when site_id % 3 = 1 then concat('rs', cust) end as "dbSNP" from sites""",
)
def _(v):
    snp = v("sites").where("site_id % 3 = 1").select("chrom", "pos", "ref", "alt", F.concat(F.lit("rs"), "cust").alias("dbSNP"))
    return an.add_rsid(v("sites"), snp).select("site_id", "dbSNP")




@query(
    "I4_score_join",
    """
select site_id, round(ada, 6) as ada, round(rf, 6) as rf, s.alt is null as no_alt from sites s
left join scores c on s.chrom = c.chrom and s.pos = c.pos and s.ref = c.ref and s.alt = c.alt""",
)
def score_join(v):
    parts = F.split("dbscSNV", "\\|")
    out = an.score_join(v("sites"), v("scores"))
    return out.select(
        "site_id", F.round(parts[0].try_cast("double"), 6).alias("ada"), F.round(parts[1].try_cast("double"), 6).alias("rf"),
        F.lit(False).alias("no_alt"),
    )


@query(
    "I4_score_join_vcf",
    """
select site_id, s.alt, round(case when length(s.alt) = 1 then ada end, 6) as ada from sites s
left join scores c on s.chrom = c.chrom and s.pos = c.pos and s.ref = c.ref and s.alt = c.alt""",
)
def _(v):
    parts = F.split("dbscSNV", "\\|")
    out = an.score_join(v("sites"), v("scores"), "vcf")
    return out.select("site_id", parts[0].alias("alt"), F.round(parts[1].try_cast("double"), 6).alias("ada"))


@query(
    "I5_score_join_multi",
    """
select s.site_id, coalesce(t.x, concat(s.alt, '|.|.|.|.|.|.|.|.|.')) as "SpliceAI" from sites s left join (
  select site_id, string_agg(concat(alt, '|g', k), '/' order by k) as x from (
    select *, unnest(range(0, site_id % 3)) as k from sites) u group by site_id) t on t.site_id = s.site_id""",
)
def _(v):
    rows = v("sites").where("site_id % 3 > 0").select(
        F.substring("chrom", 4, 5).alias("chrom"), "pos", "ref", "alt",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("site_id") % 3 - 1)).alias("ordinal"),
    ).withColumn("score", F.concat("alt", F.lit("|g"), "ordinal"))
    snv, indel = rows.where("length(alt) = 1"), rows.where("length(alt) > 1")
    return an.score_join_multi(v("sites"), snv, indel).select("site_id", "SpliceAI")


@query(
    "I6_prepare_scores",
    """
select chrom, pos + 11 as pos, ref, alt, ada, rf from scores where chrom <> 'chrX'""",
)
def _(v):
    name = F.substring("chrom", 4, 5)
    other = F.when(name == "X", "Un_1").otherwise(name)
    raw = v("scores").select(
        name.alias("chr"), "pos", "ref", "alt", other.alias("hg38_chr"), (F.col("pos") + 11).alias("hg38_pos"),
        F.col("ada").alias("ada_score"), F.col("rf").alias("rf_score"),
    )
    return an.prepare_scores(raw, "hg38")


def _probe(off: int, name: str) -> str:
    return f"""(select min_by({{'a': g.start, 'z': g.stop, 's': g.strand, 'g': g.gene}}, g.region_id) from regions g
    where g.chrom = v.chrom and v.pos + {off} between g.start and g.stop) as {name}"""


_SPLICE = f"""
with p as (select v.*, {", ".join(_probe(o, n) for o, n in ((0, 'x0'), (-6, 'x1'), (20, 'x2'), (6, 'x3'), (-20, 'x4')))} from snv v),
k as (select *, case when x0 is not null then x0.g when x1.s = '+' then x1.g when x2.s = '+' then x2.g when x3.s = '-' then x3.g
    when x4.s = '-' then x4.g end as gene,
  case when x0 is not null then case when x0.s = '+' then case when pos + 2 >= x0.z then 'd+' when pos - 2 <= x0.a then 'a+' end
      else case when pos - 2 <= x0.a then 'd-' when pos + 2 >= x0.z then 'a-' end end
    when x1.s = '+' then 'd+' when x2.s = '+' then 'a+' when x3.s = '-' then 'd-' when x4.s = '-' then 'a-' end as kind,
  case when x0 is not null then x0 when x1.s = '+' then x1 when x2.s = '+' then x2 when x3.s = '-' then x3 when x4.s = '-' then x4 end as e from p),
w as (select k.*, case kind when 'd+' then substr(txt, e.z + 48, 9) when 'a+' then substr(txt, e.a + 30, 23)
    when 'd-' then reverse(translate(substr(txt, e.a + 44, 9), 'ACGT', 'TGCA')) when 'a-' then reverse(translate(substr(txt, e.z + 48, 23), 'ACGT', 'TGCA')) end as t,
  case kind when 'd+' then pos - e.z + 2 when 'a+' then pos - e.a + 20 when 'd-' then e.a - pos + 2 when 'a-' then e.z - pos + 20 end as i
  from k join (select chrom, concat(repeat('N', 50), txt, repeat('N', 50)) as txt from ref_text) r on r.chrom = k.chrom),
m as (select *, case when kind like 'd%' then concat(lower(left(t, 3)), substr(t, 4, 2), lower(substr(t, 6)))
    else concat(lower(left(t, 18)), substr(t, 19, 2), lower(substr(t, 21))) end as wild from w),
f as (select chrom, pos, ref, alt, gene, case when kind like 'd%' then 'ss5' when kind like 'a%' then 'ss3' end as site, wild,
  concat(left(wild, i), case when kind like '%-' then translate(alt, 'ACGT', 'TGCA') else alt end, substr(wild, i + 2)) as mutant, kind from m)"""


def _windows(v):
    exons = v("regions").withColumnRenamed("region_id", "ordinal")
    return an.splice_window(v("snv"), exons, v("ref_chunks"), 12)


@query(
    "I7_splice_window",
    _SPLICE + """ select chrom, pos, ref, alt, gene, site, case when kind is not null then wild end as wild,
  case when kind is not null then mutant end as mutant from f""",
)
def _(v):
    return _windows(v)


_G = "length(regexp_replace(upper({0}), '[^G]', '', 'g')) + 0.5::double"


@query(
    "I8_splice_score",
    _SPLICE + f""" select chrom, pos, ref, alt, w as score_wt, m as score_mut, round_even((m - w) / w, 3) as score_rel from (
  select *, case when upper(concat(wild, mutant)) not like '%N%' and kind is not null then {_G.format('wild')} end as w,
    case when upper(concat(wild, mutant)) not like '%N%' and kind is not null then {_G.format('mutant')} end as m from f) t""",
)
def _(v):
    win = _windows(v)
    kmers = win.where("site is not null").select("site", F.explode(F.array(F.upper("wild"), F.upper("mutant"))).alias("kmer")).distinct()
    matrix = kmers.withColumn("score", F.length(F.regexp_replace("kmer", "[^G]", "")) + F.lit(0.5))
    return an.splice_score(win, matrix).select("chrom", "pos", "ref", "alt", "score_wt", "score_mut", "score_rel")


@query(
    "I9_select_transcripts",
    """
select gene, tx, exon_no from exons where tag = 'Select' and gene <> 'Brand#11'
union all select e.gene, e.tx, exon_no from (select * from exons where gene = 'Brand#11' or gene not in (select gene from exons where tag = 'Select')) e
  join (select gene, tx, row_number() over (partition by gene order by sum(stop - start + 1) desc, tx) as rn from exons group by 1, 2) l
  on l.gene = e.gene and l.tx = e.tx and rn = 1""",
)
def _(v):
    bare = F.when(F.col("gene") == "Brand#11", ".").otherwise(F.col("tag"))
    return an.select_transcripts(v("exons").withColumn("tag", bare), "Select").select("gene", "tx", "exon_no")


_RELATED = """
select cust as variant, site_id as ordinal, concat('NM_', cast(site_id % 11 as varchar), '.', cast(site_id % 4 + 1 as varchar)) as tx from sites"""


def _related(v):
    tx = F.concat(F.lit("NM_"), F.col("site_id") % 11, F.lit("."), F.col("site_id") % 4 + 1)
    rel = v("sites").select(F.col("cust").alias("variant"), F.col("site_id").alias("ordinal"), tx.alias("tx"))
    wanted = v("sites").where("site_id % 11 in (2, 5)").select(F.concat(F.lit("NM_"), F.col("site_id") % 11).alias("accession"))
    return rel, wanted


@query(
    "I10_pick_transcript_all",
    f"""
select variant, max_by(tx, split_part(tx, '.', 2)::int) as tx from ({_RELATED}) r where split_part(tx, '.', 1) in ('NM_2', 'NM_5')
group by variant, split_part(tx, '.', 1)
union all select variant, tx from ({_RELATED}) r where variant not in (select variant from ({_RELATED}) q
  where split_part(tx, '.', 1) in ('NM_2', 'NM_5'))""",
)
def _(v):
    rel, wanted = _related(v)
    return an.pick_transcript_version(rel, wanted)


@query(
    "I10_pick_transcript_first",
    f"""
select variant, coalesce(max_by(tx, concat(split_part(tx, '.', 1), split_part(tx, '.', 2)))
  filter (where split_part(tx, '.', 1) in ('NM_2', 'NM_5')), min_by(tx, ordinal)) as tx from ({_RELATED}) r group by variant""",
)
def _(v):
    rel, wanted = _related(v)
    return an.pick_transcript_version(rel, wanted, "first")


@query(
    "I11_variant_type",
    """
select site_id, case when ref = '.' then 'ins' when alt = '.' then 'del' when length(ref) = 1 and length(alt) = 1 and ref <> alt then 'snv'
    when ref = alt then 'ref' else 'delins' end as hgvs,
  case when length(ref) > 1 and length(alt) = 1 then 'del' when length(ref) = 1 and length(alt) > 1 then 'ins'
    when ref = '.' or alt = '.' then 'ref' when length(ref) = 1 and length(alt) = 1 then 'snp' else 'delins' end as star from dotted""",
)
def _(v):
    return v("dotted").select("site_id", an.variant_type("ref", "alt").alias("hgvs"), an.variant_type("ref", "alt", "star").alias("star"))


_VCF_KIND = """
select *, case when length(ref) = 1 and length(alt) = 1 then 'snv' when left(ref, 1) <> left(alt, 1) then 'delins_neq'
  when length(ref) = 1 then 'ins' when length(alt) = 1 then 'del' else 'delins_eq' end as kind from anchored"""


@query("I11_variant_type_vcf", f"select site_id, kind from ({_VCF_KIND}) t")
def _(v):
    return v("anchored").select("site_id", an.variant_type("ref", "alt", "vcf").alias("kind"))


@query(
    "I12_to_vcf",
    """
select site_id, p as "POS", case when site_id % 4 in (0, 1) then concat(substr(txt, p, 1), case site_id % 4 when 0 then '' else ref end) else ref end as "REF",
  case when site_id % 4 in (0, 1) then concat(substr(txt, p, 1), case site_id % 4 when 1 then '' else alt end) else alt end as "ALT"
from (select d.*, case site_id % 4 when 1 then start - 1 else start end as p, txt from dotted d join ref_text r on r.chrom = d.chrom) t""",
)
def _(v):
    return an.to_vcf(v("dotted"), v("ref_chunks"), 12).select("site_id", "POS", "REF", "ALT")


@query(
    "I12_bed_to_vcf",
    """
select site_id, p as "POS", case when site_id % 4 <> 2 then concat(substr(txt, p, 1), case site_id % 4 when 0 then '' else ref end) else ref end as "REF",
  case when site_id % 4 <> 2 then concat(substr(txt, p, 1), case site_id % 4 when 1 then '' else alt end) else alt end as "ALT"
from (select d.*, case when site_id % 4 in (0, 2) then start + 1 else start end as p, txt from (
    select * from dotted where site_id % 4 <> 3 or length(alt) > 0) d join ref_text r on r.chrom = d.chrom) t""",
)
def _(v):
    rows = v("dotted").withColumn("stop", F.col("start") + 1)
    return an.to_vcf(rows, v("ref_chunks"), 12, "bed").select("site_id", "POS", "REF", "ALT")


@query(
    "I13_vcf_to_vep",
    f"""
select site_id, case kind when 'ins' then concat(chrom, '_', pos + 1, '_-/', substr(alt, 2)) when 'del' then concat(chrom, '_', pos + 1, '_', substr(ref, 2), '/-')
  else concat(chrom, '_', pos, '_', ref, '/', alt) end as "Uploaded_variation" from ({_VCF_KIND}) t""",
)
def _(v):
    return an.vcf_to_vep(v("anchored")).select("site_id", "Uploaded_variation")


@query(
    "I13_vcf_to_bed_style",
    f"""
select site_id, case when kind in ('ins', 'del', 'delins_eq') then pos else pos - 1 end as "Start",
  case kind when 'ins' then pos when 'snv' then pos else pos - 1 + length(ref) end as "Stop",
  case when kind = 'ins' then '.' when kind in ('del', 'delins_eq') then substr(ref, 2) else ref end as "Ref",
  case when kind = 'del' then '.' when kind in ('ins', 'delins_eq') then substr(alt, 2) else alt end as "Call" from ({_VCF_KIND}) t""",
)
def _(v):
    return an.vcf_to_bed_style(v("anchored")).select("site_id", "Start", "Stop", "Ref", "Call")


_AC = "case {0} when 'chr1' then 'NC_000001.10' when 'chr2' then 'NC_000002.11' when 'chr3' then 'NC_000003.11' when 'chrX' then 'NC_000023.10' when 'chrY' then 'NC_000024.9' when 'chrMT' then 'NC_012920.1' end"


@query("I14_map_contig", f"select site_id, {_AC.format('chrom')} as ac, chrom as back from sites")
def _(v):
    out = an.map_contig(v("sites"), "chrom", "ac")
    return an.map_contig(out, "ac", "back", to="name").select("site_id", "ac", "back")


@query(
    "I15_genomic_hgvs",
    f"""
select site_id, concat(ac, case when c = 'chrMT' then ':m.' else ':g.' end, case site_id % 4 when 0 then concat(start, '_', start + 1, 'ins', alt)
  when 1 then concat(start + 1, '_', stop, 'del') when 2 then concat(stop, ref, '>', alt) else concat(start + 1, '_', stop, 'delins', alt) end) as g
from (select *, {_AC.format('c')} as ac from (select *, case when chrom = 'chr3' then 'chrMT' else chrom end as c,
  start + case site_id % 4 when 0 then 0 else length(ref) end as stop from dotted) t) u""",
)
def _(v):
    c = F.when(F.col("chrom") == "chr3", "chrMT").otherwise(F.col("chrom"))
    rows = v("dotted").withColumn("chrom", c).withColumn(
        "stop", F.col("start") + F.when(F.col("ref") == ".", 0).otherwise(F.length("ref"))
    )
    rows = an.map_contig(rows, "chrom", "ac")
    return rows.select("site_id", an.genomic_hgvs("chrom", "start", "stop", "ref", "alt", "ac").alias("g"))


@query(
    "I16_parse_genomic_hgvs",
    """
select site_id, case when k = 5 then '.' when chrom = 'chrX' then 'X' when chrom = 'chrY' then 'Y' else substr(chrom, 4) end as "#Chr",
  case k when 0 then concat(pos - 1) when 1 then concat(pos - 1) when 2 then concat(pos + 3) when 3 then concat(pos) when 4 then concat(pos - 1) else '.' end as "Start",
  case k when 0 then concat(pos) when 1 then concat(pos + 2) when 2 then concat(pos + 3) when 3 then concat(pos) when 4 then concat(pos) else '.' end as "Stop",
  case k when 0 then ref else '.' end as "Ref", case k when 0 then left(alt, 1) when 2 then 'ACGT' when 3 then 'GG' when 4 then 'TT' else '.' end as "Call",
  case k when 0 then 'sub' when 1 then 'del' when 2 then 'dup' when 3 then 'ins' when 4 then 'delins' else '.' end as "MuType",
  case when k = 5 then 'can not parse variant' else 'success' end as "State" from (select *, site_id % 6 as k from sites) t""",
)
def _(v):
    p, k = F.col("pos"), F.col("site_id") % 6
    rows = an.map_contig(v("sites"), "chrom", "ac")
    body = (
        F.when(k == 0, F.concat(p, "ref", F.lit(">"), F.substring("alt", 1, 1)))
        .when(k == 1, F.concat(p, F.lit("_"), p + 2, F.lit("del")))
        .when(k == 2, F.concat(p, F.lit("_"), p + 3, F.lit("dupACGT")))
        .when(k == 3, F.concat(p, F.lit("_"), p + 1, F.lit("insGG")))
        .when(k == 4, F.concat(p, F.lit("delinsTT")))
        .otherwise("what")
    )
    rows = rows.select("site_id", F.concat("ac", F.lit(":g. "), body).alias("variant"))
    return an.parse_genomic_hgvs(rows).drop("variant")


_CODE = """
with x as (select *, sum(stop - start + 1) over (partition by tx order by exon_no) as t1,
    sum(stop - start + 1) over (partition by tx order by exon_no) - (stop - start) as t0 from tx_exons),
c0 as (select *, region_id % 7 as k, region_id % 50 + 1 as n from coding),
p as (select *, case k when 2 then 4 - 2 when 4 then 60 + 3 else 4 + n - 1 end as a,
  case k when 1 then 4 + n + 2 - 1 when 5 then 4 + n when 2 then 2 when 4 then 63 else 4 + n - 1 end as b,
  case k when 3 then 5 when 6 then -3 else 0 end as o from c0),
g as (select p.*, xa.accession, xa.strand, case when xa.strand = '+' then xa.start + (a - xa.t0) + o else xa.stop - (a - xa.t0) - o end as ga,
  case when xb.strand = '+' then xb.start + (b - xb.t0) + o else xb.stop - (b - xb.t0) - o end as gb
  from p left join x xa on xa.tx = p.tx and a between xa.t0 and xa.t1 left join x xb on xb.tx = p.tx and b between xb.t0 and xb.t1),
h as (select *, least(ga, gb) as lo, greatest(ga, gb) as hi, ga is not null and gb is not null as ok, strand = '-' as neg from g),
r as (select region_id, gene, tx, c, ok, case when ok then case accession when 'NC_000023.10' then 'X' when 'NC_000024.10' then 'Y'
    else cast(cast(substr(accession, 4, 6) as int) as varchar) end else '.' end as "#Chr",
  case when not ok then '.' when k = 3 then concat(hi) when k = 5 then concat(lo) else concat(lo - 1) end as "Start",
  case when not ok then '.' when k = 5 then concat(lo) else concat(hi) end as "Stop",
  case when not ok then '.' else case k when 0 then case when neg then 'T' else 'A' end when 2 then case when neg then 'G' else 'C' end
    when 4 then case when neg then 'C' else 'G' end else '.' end end as "Ref",
  case when not ok then '.' else case k when 0 then case when neg then 'C' else 'G' end when 2 then case when neg then 'A' else 'T' end
    when 4 then case when neg then 'T' else 'A' end when 5 then case when neg then 'TC' else 'GA' end
    when 6 then case when neg then 'AA' else 'TT' end else '.' end end as "Call",
  case when not ok then '.' else case k when 1 then 'del' when 3 then 'dup' when 5 then 'ins' when 6 then 'delins' else 'sub' end end as "MuType",
  case when ok then 'success' else 'position not in transcript' end as "State" from h)"""
_OUT = ["#Chr", "Start", "Stop", "Ref", "Call", "MuType", "State"]


@query(
    "I17_coding_to_genomic",
    _CODE + """ select region_id, "#Chr", "Start", "Stop", "Ref", "Call", "MuType", "State" from r""",
)
def _(v):
    table = an.transcript_map(v("tx_exons"))
    rows = v("coding").select("region_id", F.concat_ws(":", "tx", "c").alias("variant"))
    return an.coding_to_genomic(rows, table).select("region_id", *[f"`{c}`" for c in _OUT])


@query(
    "I18_expand_gene_transcripts",
    """
select d.gene, d.c, coalesce(x.tx, '.') as "Transcript", case when x.tx is null then 'transcript not find! Please check your gene name!'
  when ok then 'success' else 'position not in transcript' end as "State"
from (select distinct case when region_id % 9 = 0 then concat('lost', region_id) else gene end as gene, concat('c.', region_id % 50 + 1, 'A>G') as c,
  region_id % 50 + 4 as a from coding) d
left join (select tx, gene, sum(stop - start + 1) as n from tx_exons group by 1, 2) x on x.gene = d.gene,
lateral (select a <= x.n as ok) l""",
)
def _(v):
    gene = F.when(F.col("region_id") % 9 == 0, F.concat(F.lit("lost"), "region_id")).otherwise(F.col("gene"))
    c = F.concat(F.lit("c."), F.col("region_id") % 50 + 1, F.lit("A>G"))
    rows = v("coding").select(gene.alias("gene"), c.alias("c")).distinct()
    return an.expand_gene_transcripts(rows, an.transcript_map(v("tx_exons"))).select("gene", "c", "Transcript", "State")


_TWO_ALTS = """
select site_id, pos, ref, case when site_id % 3 = 0 then [alt, concat(ref, 'GG')] else [alt] end as alts,
  case when site_id % 3 = 0 then [alt, concat(ref, 'GG')] else [alt] end as alt from anchored"""


@query(
    "I19_split_alts",
    f"""
select site_id, cast(i as int) as alt_no, pos - 1 + case when kind = 'snv' or (kind = 'delins' and left(ref, 1) <> left(a, 1)) then 0 else 1 end as start,
  case when kind = 'ins' then '.' when kind = 'del' or (kind = 'delins' and left(ref, 1) = left(a, 1)) then substr(ref, 2) else ref end as ref_,
  case when kind = 'del' then '.' when kind = 'ins' or (kind = 'delins' and left(ref, 1) = left(a, 1)) then substr(a, 2) else a end as call, kind
from (select *, case when length(ref) = 1 and length(a) = 1 then 'snv' when length(ref) = 1 then 'ins' when length(a) = 1 then 'del' else 'delins' end as kind
  from (select *, alts[i + 1] as a from (select *, unnest(range(0, len(alts))) as i from ({_TWO_ALTS}) t) u) w) z""",
)
def _(v):
    return an.split_alts(_two(v)).select("site_id", "alt_no", "start", "ref_", "call", "kind")


def _two(v):
    extra = F.array("alt", F.concat("ref", F.lit("GG")))
    return v("anchored").withColumn("alt", F.when(F.col("site_id") % 3 == 0, extra).otherwise(F.array("alt")))


@query("I19_rejoin_alts", f"select site_id, array_to_string(alts, ',') as v from ({_TWO_ALTS}) t")
def _(v):
    rows = _two(v).select("site_id", F.posexplode("alt").alias("alt_no", "v"))
    return an.rejoin_alts(rows, ["site_id"], "v")


@query(
    "I20_parse_splice_scores",
    """
select site_id, -(site_id % 50 - 20) / 10.0::double as "MaxEntScan",
  case site_id % 4 when 0 then (site_id % 9 + site_id % 7) / 20.0::double when 1 then site_id % 7 / 10.0::double when 2 then site_id % 9 / 10.0::double end as "dbscSNV",
  case when site_id % 5 = 0 then null else greatest(site_id % 13, site_id % 17, 2) / 10.0::double end as "SpliceAI" from sites""",
)
def _(v):
    s = F.col("site_id")

    def tenth(n: int):
        return ((s % n) / 10).cast("string")

    dot = F.lit(".")
    one = F.concat_ws("|", "alt", F.lit("g"), F.lit("1.0"), F.lit("2.0"), ((s % 50 - 20) / 10).cast("string"))
    two = F.concat_ws("|", "alt", F.when(s % 4 == 1, dot).when(s % 4 == 3, dot).otherwise(tenth(9)), F.when(s % 4 >= 2, dot).otherwise(tenth(7)))
    hide = s % 5 == 0
    three = F.concat_ws(
        "|", "alt", F.lit("g"), F.when(hide, dot).otherwise(tenth(13)), F.when(hide, dot).otherwise(tenth(17)),
        F.when(hide, dot).otherwise(F.lit("0.2")), dot, F.lit("99"), F.lit("1"), F.lit("2"), F.lit("3"),
    )
    rows = v("sites").select("site_id", F.concat_ws(";", one, two, three).alias("info"))
    return an.parse_splice_scores(rows).drop("info")
