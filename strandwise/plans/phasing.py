"""Linked-read phasing queries (survey section 2.7, phase sets)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import phasing as ph
from strandwise.operators.genotype import haplotype_counts
from strandwise.operators.intervals import assign_location
from strandwise.plans.genotype import calls
from strandwise.plans.registry import query


def phased(v):
    third = F.floor(F.col("dp") / 3)
    return v("phased").withColumn("alt", F.array("alt")).withColumn("ad", F.array(F.col("dp") - third, third))


def linked(v):
    family = ph.linked_family_calls(calls(v), ["Father", "Mother"], ["Embryo1"])
    return ph.phase_family(ph.phase_block(phased(v)), family, "M", 0)


@query(
    "G9_phased_variant",
    """
select s.site_id, p.ps, p.gt, case when p.gt in ('1|0', '1|1') then 0 when p.gt = '0|1' then 1 end as allele_number
from (select * from sites where site_id % 5 = 0) s left join (
  select chrom, pos, ref, alt, case when site_id % 2 = 0 then gt else '0|1' end as gt, case when site_id % 2 = 0 then ps else 'A' end as ps from phased) p
on p.chrom = s.chrom and p.pos = s.pos and p.ref = s.ref and p.alt = s.alt""",
)
def _(v):
    targets = v("sites").where("site_id % 5 = 0").select("site_id", "chrom", "pos", "ref", "alt")
    # two records a site: the second of even sites, and the first of odd ones, is 0|1 in set A
    rows = phased(v)
    again = rows.withColumn("gt", F.lit("0|1")).withColumn("ps", F.lit("A"))
    both = rows.withColumn("ord", F.col("site_id") % 2).unionByName(again.withColumn("ord", (F.col("site_id") + 1) % 2))
    return ph.phased_variant(targets, both).select("site_id", "ps", "gt", "allele_number")


@query(
    "G10_phased_deletion",
    """
with t as (select chrom, start, case when name % 2 = 0 then start + 40000 else stop end as stop, name from catalog),
d as (select chrom, start, stop, concat('P', cast(region_id as varchar)) as ps,
  case region_id % 3 when 0 then '1|0' when 1 then '0|1' else '1|1' end as gt, region_id % 2 = 0 as big from regions
  where region_id % 5 <> 2)
select t.name, ps, gt, case when gt in ('1|0', '1|1') then 0 when gt = '0|1' then 1 end as allele_number
from t left join (select * from (select t.name as n, d.ps, d.gt, row_number() over (partition by t.name order by
    (least(t.stop, d.stop) - greatest(t.start, d.start)) / cast(t.stop - t.start as double) desc, d.start, d.stop, d.ps) as rn
  from t join d on t.chrom = d.chrom and t.start < d.stop and d.start < t.stop and d.big = (t.stop - t.start > 30000)) x
  where rn = 1) b on b.n = t.name""",
)
def _(v):
    stop = F.when(F.col("name") % 2 == 0, F.col("start") + 40000).otherwise(F.col("stop"))
    targets = v("catalog").withColumn("stop", stop)
    gt = F.when(F.col("region_id") % 3 == 0, "1|0").when(F.col("region_id") % 3 == 1, "0|1").otherwise("1|1")
    dels = v("regions").select(
        "chrom", "start", "stop", F.when(F.col("region_id") % 5 == 2, "DUP").otherwise("DEL").alias("svtype"),
        F.concat(F.lit("P"), "region_id").alias("ps"), gt.alias("gt"), "region_id",
    )
    small, large = dels.where("region_id % 2 = 1"), dels.where("region_id % 2 = 0")
    return ph.phased_deletion(targets, small, large, ["name"]).select("name", "ps", "gt", "allele_number")


@query(
    "G11_phase_block",
    """
select chrom, pos, ps, gt as "GT_lfr", case gt when '0|1' then concat(ref, '|', alt) when '1|0' then concat(alt, '|', ref)
  else concat(alt, '|', alt) end as "TGT_lfr", dp as "DP_lfr", round_even(floor(dp / 3.0) / dp, 3) as "Ratio_lfr" from phased""",
)
def _(v):
    return ph.phase_block(phased(v)).select("chrom", "pos", "ps", "GT_lfr", "TGT_lfr", "DP_lfr", "Ratio_lfr")


@query(
    "G11_block_range",
    "select chrom, ps, min(pos) as ps_start, max(pos) as ps_stop from phased group by chrom, ps",
)
def _(v):
    return ph.block_range(ph.phase_block(phased(v)))


@query(
    "G12_phase_family",
    """
select chrom, pos, ps, m1 as "M1", m2 as "M2", f_dp as "Father_DP",
  case m when '0/0' then concat(ref, '/', ref) when '0/1' then concat(ref, '/', alt) else concat(alt, '/', alt) end as "Mother_TGT"
from linked where pos > 3000 - 500 and pos < 60000 + 800""",
)
def _(v):
    family = ph.linked_family_calls(calls(v), ["Father", "Mother"], ["Embryo1"])
    out = ph.phase_family(
        ph.phase_block(phased(v)), family, "M", 0, window=(500, 800), start=F.lit(3000), stop=F.lit(60000)
    )
    return out.select("chrom", "pos", "ps", "M1", "M2", "Father_DP", "Mother_TGT")


@query(
    "G13_linked_informative",
    """
select chrom, pos, case when yes then 'yes' else 'no' end as "IF", allele as "Allele", if_filter as "IF_filter" from linked_if""",
)
def _(v):
    return ph.linked_informative(linked(v), "M", 24).select("chrom", "pos", "IF", "Allele", "IF_filter")


@query(
    "G14_linked_support",
    """
select chrom, pos, case when raw_hap <> '.' and e_dp < 22 then concat(raw_hap, '-LowDepth') else raw_hap end as "Embryo1_hap"
from linked_if""",
)
def _(v):
    site = ph.linked_informative(linked(v), "M", 24)
    return ph.linked_support(site, "Embryo1", "M", 22).select("chrom", "pos", "Embryo1_hap")


@query(
    "G15_linked_counts",
    """
select "Variant", sample, count(*) filter (where h = 'M1' and location = 'upstream') as "M1-U",
  count(*) filter (where h = 'M1' and location = 'internal') as "M1-I",
  count(*) filter (where h = 'M2' and location = 'downstream') as "M2-D", count(*) filter (where h = 'F1') as "F1-U"
from (select chrom as "Variant", 'IF' as sample, allele as h, location from linked_if where if_filter = 'Pass' and var_type <> 'indel'
  union all select chrom, 'Embryo1', case when raw_hap <> '.' and e_dp < 22 then 'low' else raw_hap end, location
  from linked_if where if_filter = 'Pass' and var_type <> 'indel') t group by 1, 2""",
)
def _(v):
    site = ph.linked_support(ph.linked_informative(linked(v), "M", 24), "Embryo1", "M", 22)
    site = site.withColumn("Location", assign_location("pos", F.lit(20000), F.lit(60000))).withColumn(
        "Variant", F.col("chrom")
    )
    return haplotype_counts(site, ["Embryo1"], ["Variant"]).select(
        "Variant", "sample", "`M1-U`", "`M1-I`", "`M2-D`", "`F1-U`"
    )


_SETS = """
met as (select c.name, c.chrom, c.start, c.stop, p.ps, min(p.pos) as first from catalog c join phased p
  on p.chrom = c.chrom and p.pos >= c.start and p.pos <= c.stop group by all),
spans as (select chrom, ps, min(pos) as a, max(pos) as z,
  count(*) filter (where length(ref) = 1 and length(alt) = 1 and gt <> '1|1') as n from phased group by 1, 2)"""


@query(
    "G16_phase_set_stats",
    f"""
with {_SETS.strip()}
select m.name, m.chrom, m.ps, a as "PS_start", z as "PS_stop", n as "PS_size",
  (least(z, m.stop) - greatest(a, m.start)) / cast(m.stop - m.start as double) as "Overlap_Rate",
  first = max(first) over (partition by m.name) as is_last
from met m join spans s on s.chrom = m.chrom and s.ps = m.ps qualify n > 1""",
)
def _(v):
    out = ph.phase_set_stats(phased(v), v("catalog"), ["name"])
    return out.select("name", "chrom", "ps", "PS_start", "PS_stop", "PS_size", "Overlap_Rate", "is_last")


@query(
    "G17_phase_set_span",
    f"""
with {_SETS.strip()}
select c.name, c.chrom, coalesce(a, c.start) as ps_start, coalesce(z, c.stop) as ps_stop from catalog c left join (
  select * from (select m.name as n0, a, z, row_number() over (partition by m.name order by
    (least(z, m.stop) - greatest(a, m.start)) / cast(m.stop - m.start as double) desc, first desc) as rn
  from met m join spans s on s.chrom = m.chrom and s.ps = m.ps) x where rn = 1) b on b.n0 = c.name""",
)
def _(v):
    return ph.phase_set_span(phased(v), v("catalog"), ["name"])


@query(
    "G18_candidate_sites",
    """
select chrom, pos, abs(pos - (20000 + 40001) / 2.0::double) as distance from linked
where var_type = 'snp' and m = '0/1' and f = '0/0' and gt_lfr = '1|0' and least(m_dp, f_dp, dp_lfr) >= 15
  and ratio_lfr between 0.3 and 0.6""",
)
def _(v):
    out = ph.candidate_sites(linked(v), "Mother", "hap1", F.lit(20000), F.lit(40001), low=0.3)
    return out.select("chrom", "pos", "distance")
