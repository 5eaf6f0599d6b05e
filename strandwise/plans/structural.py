"""Structural variant queries (survey section 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import structural as sv
from strandwise.operators.intervals import reciprocal_overlap
from strandwise.plans.registry import query

_EXT = 600
_GOOD = f"""
good as (select * from pair_reads where flag & (4 | 8 | 256 | 512 | 1024 | 2048) = 0),
pr as (select a.*, m.start as m_start, m.stop as m_stop, m.cigar as m_cigar from good a join good m
  on a.sample = m.sample and a.qname = m.qname and a.chrom = m.chrom and (a.flag & 64) <> (m.flag & 64)),
lft as (select p.*, b.cnv_name, bp_left, bp_right from pr p join breakpoints b on b.chrom = p.chrom
  and p.start < bp_left and p.stop > bp_left - {_EXT}),
rgt as (select p.*, b.cnv_name, bp_left, bp_right from pr p join breakpoints b on b.chrom = p.chrom
  and p.start < bp_right + {_EXT} and p.stop > bp_right - 1),
prs as (select sample, qname, cnv_name from lft where stop <= bp_left and m_start + 1 >= bp_right
    and (bp_right - bp_left) / cast(m_start + 1 - stop as double) >= 0.5
  union select sample, qname, cnv_name from rgt where start + 1 >= bp_right and m_stop <= bp_left
    and (bp_right - bp_left) / cast(start + 1 - m_stop as double) >= 0.5),
ext as (select * from pair_reads where flag & (256 | 2048) <> 0 and (cigar like '%S%' or cigar like '%H%')),
spl as (select l.sample, l.qname, l.cnv_name from lft l where m_stop > stop and m_stop <= bp_left and m_cigar like '%S%'
    and exists (select 1 from ext e where e.sample = l.sample and e.qname = l.qname and e.chrom = l.chrom
      and e.start < l.bp_right and e.stop > l.bp_right - 1)
  union select r.sample, r.qname, r.cnv_name from rgt r where m_start < start and m_start + 1 >= bp_right and m_cigar like '%S%'
    and exists (select 1 from ext e where e.sample = r.sample and e.qname = r.qname and e.chrom = r.chrom
      and e.start < r.bp_left and e.stop > r.bp_left - 1))"""


@query("F1_deletion_pairs", f"with {_GOOD.strip()} select * from prs")
def _(v):
    return sv.deletion_pairs(v("pair_reads"), v("breakpoints"), _EXT, min_rate=0.5)


@query("F2_deletion_splits", f"with {_GOOD.strip()} select * from spl")
def _(v):
    return sv.deletion_splits(v("pair_reads"), v("breakpoints"), _EXT)


@query(
    "F3_breakpoint_call",
    f"""
with {_GOOD.strip().replace(">= 0.5", ">= 0.9")},
sup as (select sample, cnv_name, count(*) as n from (select * from prs union select * from spl) t group by 1, 2),
fl as (select chrom, cnv_name, bp_left - {_EXT} as a, bp_left - 1 as z from breakpoints union all
  select chrom, cnv_name, bp_right, bp_right + {_EXT} from breakpoints),
dep as (select s.sample, f.cnv_name, f.a, f.z, coalesce(sum(case when r.start is not null then least(r.stop, f.z) - greatest(r.start, f.a) end), 0) / cast(f.z - f.a as double) as m
  from fl f cross join (select unnest(['S0', 'S1', 'S2', 'S3']) as sample) s
  left join pair_reads r on r.sample = s.sample and r.chrom = f.chrom and r.start < f.z and f.a < r.stop
    and r.flag & (4 | 256 | 512 | 1024) = 0 group by s.sample, f.cnv_name, f.a, f.z),
dm as (select sample, cnv_name, sum(m) * 0.5 as m from dep group by 1, 2)
select sample, cnv_name, mean_reads_count, support_reads_count, ratio,
  case when ratio is null or mean_reads_count < thres_mean_reads then 'unknown'
    when ratio < thres_normal and support_reads_count < thres_support_reads then '2'
    when ratio >= thres_hom_del and support_reads_count >= thres_support_reads then '0'
    when ratio >= thres_normal and support_reads_count >= thres_support_reads then '1' else 'unknown' end as copy_num
from (select dm.sample, dm.cnv_name, m as mean_reads_count, coalesce(n, 0) as support_reads_count,
  coalesce(n, 0) / nullif(m, 0) as ratio, b.* exclude (cnv_name) from dm join breakpoints b on b.cnv_name = dm.cnv_name
  left join sup on sup.sample = dm.sample and sup.cnv_name = dm.cnv_name) t""",
)
def _(v):
    return sv.breakpoint_call(v("pair_reads"), v("breakpoints"), ["S0", "S1", "S2", "S3"], _EXT)


_SV = """
select sample, chrom, start, stop, 'DEL' as svtype, cast(case when ord = 3 then 0 else qname % 40 end as bigint) as pe_support_count,
  cast(qname % 23 as bigint) as sr_support_count from reads where ord % 2 = 1 and chrom <> 'chrY'"""


def _sv_sites(v):
    from strandwise.sources.vcf import parse_vcf

    pe = F.when(F.col("ord") == 3, "").otherwise(F.concat(F.lit(";PE="), F.col("qname") % 40))
    info = F.concat(
        F.lit("SVTYPE="), F.when(F.col("ord") % 2 == 1, "DEL").otherwise("DUP"), F.lit(";END="), "stop", pe,
        F.lit(";SR="), F.col("qname") % 23,
    )
    chrom = F.when(F.col("chrom") == "chrY", "chrM").otherwise(F.col("chrom"))
    line = F.concat_ws(
        "\t", chrom, F.col("start").cast("string"), F.lit("."), F.lit("N"), F.lit("<DEL>"), F.lit("."), F.lit("PASS"),
        info, F.lit("GT"), F.lit("0/1"),
    )
    # each line has one genotype, of the read's own sample
    return parse_vcf(v("reads").select(line.alias("value"), F.array("sample").alias("_s")), F.col("_s")).select(
        "chrom", "pos", "info", "sample"
    )


@query("F4_parse_sv_info", _SV)
def _(v):
    return sv.parse_sv_info(_sv_sites(v))


@query(
    "F5_filter_sv",
    f"""
select * from (select r.sample, concat('del', c.name) as cnv_name, r.start, r.stop, pe_support_count, sr_support_count,
  (least(r.stop, c.stop) - greatest(r.start, c.start)) / cast(c.stop - c.start as double) as overlap_rate_aim,
  (least(r.stop, c.stop) - greatest(r.start, c.start)) / cast(r.stop - r.start as double) as overlap_rate_self
  from ({_SV}) r join catalog c on r.chrom = c.chrom and r.start < c.stop and c.start < r.stop) t
where overlap_rate_aim >= 0.6 and overlap_rate_self >= 0.6 and pe_support_count >= 5 and sr_support_count >= 4""",
)
def _(v):
    limits = v("catalog").withColumn("cnv_name", F.concat(F.lit("del"), "name")).drop("name")
    hits = reciprocal_overlap(sv.parse_sv_info(_sv_sites(v)), limits)
    table = limits.select("cnv_name").withColumns(
        {"pe_threshold": F.lit(5), "sr_threshold": F.lit(4), "overlap_rate": F.lit(0.6)}
    )
    cols = ["sample", "cnv_name", "start", "stop", "pe_support_count", "sr_support_count", "overlap_rate_aim", "overlap_rate_self"]
    return sv.filter_sv(hits.select(*cols), table)
