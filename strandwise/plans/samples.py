"""Sample, sheet and report queries (survey section 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions.sequence_text import reverse_complement
from strandwise.operators import samples as sm
from strandwise.plans.genotype import EMBRYOS, MEMBERS, haplotypes
from strandwise.plans.registry import query

_RC = "reverse(translate(barcode, 'ACGT', 'TGCA'))"


def _demux(mismatch: int) -> str:
    same = " + ".join(f"(case when substr(t, {i}, 1) = substr(s, {i}, 1) then 1 else 0 end)" for i in range(1, 11))
    return f"""
select rec, seq1, left(seq2, 4) as seq2, barcode from (select *, row_number() over (partition by rec order by ord) as rn from (
  select f.rec, f.seq1, f.seq2, b.ord, concat('b', b.ord) as barcode, substr(f.seq2, 5) as t, b.s
  from (select rec, seq1, concat('ACGT', case when rec % 13 = 0 then concat('N', substr(seq2, 2)) else seq2 end) as seq2 from fq) f
  cross join (select ord, {_RC} as s from barcodes) b) x
where {same} >= 10 - {mismatch}) y where rn = 1"""


def _pairs(v):
    tag = F.when(F.col("rec") % 13 == 0, F.concat(F.lit("N"), F.expr("substring(seq2, 2)"))).otherwise(F.col("seq2"))
    return v("fq").select("rec", "seq1", F.concat(F.lit("ACGT"), tag).alias("seq2"))


def _barcodes(v):
    return v("barcodes").select("ord", F.concat(F.lit("b"), "ord").alias("barcode"), F.col("barcode").alias("seq"))


@query("K1_demultiplex", _demux(1))
def _(v):
    return sm.demultiplex(_pairs(v), _barcodes(v), 1, read_length=4)


@query("K1_demultiplex_two", _demux(2))
def _(v):
    return sm.demultiplex(_pairs(v), _barcodes(v), 2, read_length=4)


@query("K2_reverse_complement", "select rec, reverse(translate(seq1, 'ACGT', 'TGCA')) as rc from fq")
def _(v):
    return v("fq").select("rec", reverse_complement("seq1").alias("rc"))


# one family per ten customers' orders, the sheet in site order
_SHEET = """
select site_id as ordinal, case when site_id % 10 = 0 then concat('F', cast(site_id as varchar)) end as family,
  case when site_id % 17 = 3 then 'x' else '已下机' end as progress, case when site_id % 23 = 4 then 'bad' end as remark,
  case site_id % 10 when 0 then '女方' when 1 then '男方' when 2 then '女儿' when 3 then '女方母亲' when 4 then '男方父亲' when 5 then '男方' else '胚胎' end as relation,
  concat('ID', cast(site_id as varchar)) as sid, case when site_id % 3 = 0 then '7-9' else '12' end as barcode,
  case when site_id % 4 = 0 then 'V1/V2' else 'V3' end as chip, case when site_id % 4 = 0 then 'L01-L02/L04' else 'L03' end as lane from sites"""


def _sheet(v):
    s = F.col("site_id")
    words = ["女方", "男方", "女儿", "女方母亲", "男方父亲", "男方"]
    relation = F.get(F.array(*[F.lit(w) for w in words]), (s % 10).cast("int"))
    return v("sites").select(
        s.alias("ordinal"),
        F.when(s % 10 == 0, F.concat(F.lit("F"), s.cast("string"))).alias("family"),
        F.when(s % 17 == 3, "x").otherwise("已下机").alias("progress"),
        F.when(s % 23 == 4, "bad").alias("remark"),
        F.coalesce(relation, F.lit("胚胎")).alias("relation"),
        F.concat(F.lit("ID"), s.cast("string")).alias("sampleID"),
        F.when(s % 3 == 0, "7-9").otherwise("12").alias("barcode"),
        F.when(s % 4 == 0, "V1/V2").otherwise("V3").alias("chip"),
        F.when(s % 4 == 0, "L01-L02/L04").otherwise("L03").alias("lane"),
    )


@query(
    "K3_expand_sheet",
    f"""
with s as ({_SHEET.strip()}),
f as (select *, last_value(family ignore nulls) over (order by ordinal) as fam from s),
k as (select *, sum(case when relation = '胚胎' then 1 else 0 end) over (partition by fam order by ordinal) as no from f where progress = '已下机' and remark is null),
r as (select fam as family, case relation when '女方' then 'Mother' when '男方' then 'Father' when '女儿' then 'Proband' when '女方母亲' then 'Maternal'
    when '男方父亲' then 'Paternal' else concat('Embryo', cast(no as varchar)) end as sample, sid as "sampleID", relation,
  case relation when '女方' then 'F' when '男方' then 'M' when '女儿' then 'F' when '女方母亲' then 'F' when '男方父亲' then 'M' else 'unknown' end as gender,
  unnest(case when barcode = '12' then [12] else [7, 8, 9] end) as b, chip from k),
l as (select *, unnest(case when chip = 'V3' then [{{'c': 'V3', 'l': 3}}] else [{{'c': 'V1', 'l': 1}}, {{'c': 'V1', 'l': 2}}, {{'c': 'V2', 'l': 4}}] end) as x from r)
select family, sample, "sampleID", concat('/data/', x.c, '/L0', x.l, '/', x.c, '_L0', x.l, '_', b, '_1.fq.gz') as fq1, relation, gender from l""",
)
def _(v):
    return sm.expand_sheet(_sheet(v), "/data")


_INFO = """
select site_id as ordinal, case site_id % 9 when 0 then 'Father' when 1 then 'Mother' when 2 then 'Proband' when 3 then 'Maternal' when 4 then 'Paternal'
  when 5 then 'Maternal' when 6 then 'Paternal' when 7 then 'Paternal' else 'Embryo1' end as sample,
  concat('ID', cast(site_id % 5000 as varchar)) as sid, case site_id % 9 when 3 then '女方母亲' when 4 then '男方父亲' when 5 then '女方父亲'
  when 6 then '男方母亲' when 7 then '男方弟' else 'x' end as relation from sites"""


def _info(v):
    s = F.col("site_id")
    roles = ["Father", "Mother", "Proband", "Maternal", "Paternal", "Maternal", "Paternal", "Paternal", "Embryo1"]
    words = {3: "女方母亲", 4: "男方父亲", 5: "女方父亲", 6: "男方母亲", 7: "男方弟"}
    relation = F.lit("x")
    for k, w in words.items():
        relation = F.when(s % 9 == k, w).otherwise(relation)
    return v("sites").select(
        s.alias("ordinal"),
        F.get(F.array(*[F.lit(r) for r in roles]), (s % 9).cast("int")).alias("sample"),
        F.concat(F.lit("ID"), (s % 5000).cast("string")).alias("sampleID"),
        relation.alias("relation"),
    )


@query(
    "K4_add_proband_copies",
    f"""
select sample, sid as "sampleID", relation from ({_INFO}) i union all
select 'Proband', concat(sid, '-p'), '先证者' from ({_INFO}) i where sample like '%Embryo%'""",
)
def _(v):
    return sm.add_proband_copies(_info(v)).drop("ordinal")


@query(
    "K5_dedupe_samples",
    f"""
select ordinal, sample, sid as "sampleID", relation from (select *, row_number() over (partition by sid order by ordinal) as rn from ({_INFO}) i) t where rn = 1""",
)
def _(v):
    return sm.dedupe_samples(_info(v), ["sampleID"], "ordinal")


@query(
    "L1_final_annotation",
    """
select "CHROM", "POS", "sampleID", "HGVS.c", extra from (select *, row_number() over (partition by "CHROM", "POS", "REF", "ALT", "sampleID", "Transcript", "HGVS.c" order by o) as rn from (
  select site_id * 10 as o, chrom as "CHROM", pos as "POS", ref as "REF", alt as "ALT", sample as "sampleID", 'NM_1' as "Transcript", concat('c.', site_id) as "HGVS.c", null as extra from calls
  union all select site_id * 10 + 1, chrom, pos, ref, alt, sample, 'NM_1', concat('c.', site_id - site_id % 2), 'second' from calls) t) u where rn = 1""",
)
def _(v):
    s = F.col("site_id")
    base = [
        F.col("chrom").alias("CHROM"), F.col("pos").alias("POS"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"),
        F.col("sample").alias("sampleID"), F.lit("NM_1").alias("Transcript"),
    ]
    one = v("calls").select((s * 10).alias("o"), *base, F.concat(F.lit("c."), s.cast("string")).alias("HGVS.c"))
    two = v("calls").select((s * 10 + 1).alias("o"), *base, F.concat(F.lit("c."), (s - s % 2).cast("string")).alias("HGVS.c"), F.lit("second").alias("extra"))
    return sm.final_annotation([one, two], "o").select("CHROM", "POS", "sampleID", "`HGVS.c`", "extra")


@query(
    "L2_order_trios",
    f"""
select "sampleID", sample, priority, concat(sample, '_', "sampleID") as "ID" from (
  select sid as "sampleID", sample, cast(case when sample = 'Proband' then 6 else case sample when 'Paternal' then 0 else 3 end
    + case when relation like '%母亲%' then 0 when relation like '%父亲%' then 1 else 2 end end as int) as priority
  from (select *, row_number() over (partition by sid order by ordinal) as rn from ({_INFO}) i) t
  where rn = 1 and sample in ('Paternal', 'Maternal', 'Proband')) u""",
)
def _(v):
    return sm.order_trios(_info(v), "ordinal").select("sampleID", "sample", "priority", "ID")


@query(
    "L3_haplotype_report",
    """
select chrom, pos, case when site_id % 2 = 0 then concat('rs', site_id) end as "dbSNP", h_f1 as "F1", h_m2 as "M2", allele as "Allele",
  if_filter as "IF_filter" from hap where var_type = 'snp' and if_ = 'yes'""",
)
def _(v):
    from strandwise.operators.annotate import add_rsid

    snp = v("sites").where("site_id % 2 = 0").select(
        "chrom", "pos", "ref", F.array("alt").alias("alt"), F.concat(F.lit("rs"), "site_id").alias("dbSNP")
    )
    out = sm.haplotype_report(add_rsid(haplotypes(v), snp), [*MEMBERS, *EMBRYOS])
    return out.select("chrom", "pos", "dbSNP", "F1", "M2", "Allele", "IF_filter")
