"""Family genotype queries (survey section 2.7, trio part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions.columns import round_even

from strandwise.operators import genotype as gt
from strandwise.operators.intervals import overlap_join
from strandwise.plans.registry import query

MEMBERS = ["Father", "Mother", "Proband"]
EMBRYOS = ["Embryo1", "Embryo2", "Embryo3"]


def calls(v, name="calls"):
    """The call view in reader shape: alt, filter and ad as arrays."""
    return (
        v(name)
        .withColumn("alt", F.array("alt"))
        .withColumn("filter", F.array("filter"))
        .withColumn("ad", F.array("ad0", "ad1"))
        .withColumn("dp", F.col("ad0") + F.col("ad1"))
        .drop("ad0", "ad1")
    )


def family(v):
    return gt.family_calls(calls(v), MEMBERS, EMBRYOS)


def haplotypes(v):
    site = gt.core_haplotype(family(v))
    points = site.withColumn("start", F.col("pos") - 1).withColumn("stop", F.col("pos"))
    genes = v("targets").select(
        "gene", "chrom", F.col("start_extend").alias("start"), F.col("end_extend").alias("stop"),
        F.col("start").alias("g_start"), F.col("stop").alias("g_stop"),
    )
    tagged = overlap_join(points, genes).drop("start", "stop", "b_start", "b_stop")
    return gt.family_haplotypes(
        tagged, MEMBERS, EMBRYOS, start="g_start", stop="g_stop", trio_depth=24, embryo_depth=14
    )


@query(
    "G1_correct_genotype",
    """
select site_id, sample, gtc as corrected from fixed_call""",
)
def _(v):
    rows = calls(v).where("filter[0] <> 'LowQual' and gt <> './.' and dp > 0")
    share = round_even(F.col("ad")[1] / F.col("dp"), 3)
    trio = gt.correct_genotype("gt", share)
    simple = gt.correct_genotype("gt", share, "simple")
    return rows.select(
        "site_id", "sample", F.when(F.col("sample").isin(*MEMBERS), trio).otherwise(simple).alias("corrected")
    )


@query(
    "G2_family_calls",
    """
select chrom, pos, f_dp as "Father_DP", f as "Father_GT_correct", p_dp as "Proband_DP", p as "Proband_GT_correct",
  e2_dp as "Embryo2_DP", e2 as "Embryo2_GT_correct",
  case m when '0/0' then concat(ref, '/', ref) when '0/1' then concat(ref, '/', alt) else concat(alt, '/', alt) end as "Mother_correct"
from fam""",
)
def _(v):
    return family(v).select(
        "chrom", "pos", "Father_DP", "Father_GT_correct", "Proband_DP", "Proband_GT_correct",
        "Embryo2_DP", "Embryo2_GT_correct", "Mother_correct",
    )


@query(
    "G3_core_haplotype",
    """
select chrom, pos, h_f1 as "F1", h_f2 as "F2", h_m1 as "M1", h_m2 as "M2", if_ as "IF" from core""",
)
def _(v):
    return gt.core_haplotype(family(v)).select("chrom", "pos", "F1", "F2", "M1", "M2", "IF")


_NONCORE = """
select chrom, pos, {cols}, if_ as "IF" from (
  select fam.*, case when {own} = '0/1' and {other} in ('0/0', '1/1') and p in ('0/0', '1/1') then 'yes' else 'no' end as if_ from fam) t"""


def _side(own: str, other: str, first: str, fixed: str) -> str:
    one = "case when if_ = 'no' then '.' when p = '0/0' then alt else ref end"
    two = "case when if_ = 'no' then '.' when p = '0/0' then ref else alt end"
    hom = f"case when if_ = 'no' then '.' when {other} = '0/0' then ref else alt end"
    cols = f'{one} as "{first}1", {two} as "{first}2", {hom} as "{fixed}1", {hom} as "{fixed}2"'
    return _NONCORE.format(cols=cols, own=own, other=other)


@query("G4_noncore_maternal", _side("m", "f", "M", "F"))
def _(v):
    # the third member of the test family stands in for the grandparent
    rows = family(v).withColumnRenamed("Proband_GT_correct", "Maternal_GT_correct")
    return gt.noncore_haplotype(rows, "Maternal").select("chrom", "pos", "F1", "F2", "M1", "M2", "IF")


@query("G4_noncore_paternal", _side("f", "m", "F", "M"))
def _(v):
    rows = family(v).withColumnRenamed("Proband_GT_correct", "Paternal_GT_correct")
    return gt.noncore_haplotype(rows, "Paternal").select("chrom", "pos", "F1", "F2", "M1", "M2", "IF")


@query("G5_informative_allele", """select chrom, pos, allele as "Allele" from core where if_ = 'yes'""")
def _(v):
    rows = gt.core_haplotype(family(v)).where("IF = 'yes'")
    return rows.select("chrom", "pos", gt.informative_allele().alias("Allele"))


@query(
    "G6_embryo_haplotype",
    """
select gene, chrom, pos, location as "Location", if_filter as "IF_filter", sample, hap from emb""",
)
def _(v):
    per = F.array(*[F.struct(F.lit(e).alias("sample"), F.col(f"{e}_hap").alias("hap")) for e in EMBRYOS])
    return haplotypes(v).select("gene", "chrom", "pos", "Location", "IF_filter", F.explode(per).alias("x")).select(
        "gene", "chrom", "pos", "Location", "IF_filter", "x.sample", "x.hap"
    )


@query("G7_haplotype_counts", "select * from counted")
def haplotype_counts(v):
    return gt.haplotype_counts(haplotypes(v), EMBRYOS)


def _part(side: str, place: str) -> str:
    n1, n2 = f'i."{side}1-{place}"', f'i."{side}2-{place}"'
    a, b = f'e."{side}1-{place}"', f'e."{side}2-{place}"'
    r1, r2 = f"{a} / cast({n1} as double)", f"{b} / cast({n2} as double)"
    return f"""case when {n1} > 0 and {n2} > 0 then case when {r1} > 0.2 and {r2} < 0.05 then '{side}1'
      when {r1} < 0.05 and {r2} > 0.2 then '{side}2' else '-' end
    when {n1} > 0 then case when {r1} > 0.2 then '{side}1' else '-' end
    when {n2} > 0 then case when {r2} > 0.2 then '{side}2' else '-' end else '-' end"""


def _verdict(side: str) -> str:
    return ", '|', ".join(_part(side, p) for p in "UID")


@query(
    "G8_haplotype_verdict",
    f"""
select e.gene, e.sample, concat({_verdict("F")}) as "Paternal", concat({_verdict("M")}) as "Maternal"
from counted e join counted i on e.gene = i.gene and i.sample = 'IF' where e.sample <> 'IF'""",
)
def _(v):
    counts = gt.haplotype_counts(haplotypes(v), EMBRYOS)
    return gt.haplotype_verdict(counts).select("gene", "sample", "Paternal", "Maternal")


@query(
    "G30_allele_ratio_plot",
    """
select chrom, pos, sample, ad0 + ad1 as depth, round_even(ad1 / cast(ad0 + ad1 as double), 4) as ratio,
  case when length(ref) > 1 or length(alt) > 1 then 'indel' else 'snv' end as var_type,
  case when gt = '1/1' then 'Hom' else 'Het' end as genotype from calls where gt in ('0/1', '1/1') and sample = 'Father'""",
)
def _(v):
    out = gt.allele_ratio_sites(calls(v).where("sample = 'Father'"), "plot")
    return out.select("chrom", "pos", F.lit("Father").alias("sample"), "depth", "ratio", "var_type", "genotype")


@query(
    "G30_allele_ratio_roh",
    """
select chrom, pos, ad0 + ad1 as dp, ad1 as dp_alt, ad1 / cast(ad0 + ad1 as double) as ratio,
  case when gt = '0/1' then 'het' else 'hom' end as genotype from calls
where sample = 'Mother' and ad0 + ad1 >= 10 and var_type = 'snp'""",
)
def _(v):
    return gt.allele_ratio_sites(calls(v).where("sample = 'Mother'"), "roh")


def _ibs_sql(group: str) -> str:
    g, ga = (f"{group}, ", f"a.{group}, ") if group else ("", "")
    on = f" and m.{group} = p.{group}" if group else ""
    return f"""
with dose as (select chrom, site_id, sample, case gt when '0/0' then 0 when '0/1' then 1 when '1/1' then 2 end as d
  from calls where gt <> './.'),
p as (select {ga}a.sample as "IID1", b.sample as "IID2", count(*) filter (where abs(a.d - b.d) = 2) as "IBS0",
  count(*) filter (where abs(a.d - b.d) = 1) as "IBS1", count(*) filter (where a.d = b.d) as "IBS2", count(*) as n
  from dose a join dose b on a.site_id = b.site_id
    and list_position(['Father', 'Mother', 'Proband', 'Embryo1', 'Embryo2', 'Embryo3'], a.sample)
      < list_position(['Father', 'Mother', 'Proband', 'Embryo1', 'Embryo2', 'Embryo3'], b.sample) group by all),
f as (select {g}site_id, sum(d) / cast(2 * count(*) as double) as x from dose group by all),
m as (select {g}avg(2 * x * x * (1 - x) * (1 - x)) as e00, avg(4 * x * x * x * (1 - x) + 4 * x * (1 - x) * (1 - x) * (1 - x)) as e10,
  avg(2 * x * x * (1 - x) + 2 * x * (1 - x) * (1 - x)) as e11 from f {"group by " + group if group else ""}),
z as (select p.*, least(1.0, "IBS0" / (e00 * n)) as z0, e10, e11 from p join m on true{on}),
y as (select *, least(1 - z0, greatest(0.0, ("IBS1" - z0 * e10 * n) / (e11 * n))) as z1 from z)
select {g}"IID1", "IID2", "IBS0", "IBS1", "IBS2", z0 as "Z0", z1 as "Z1", 1 - z0 - z1 as "Z2", z1 / 2 + 1 - z0 - z1 as "PI_HAT" from y"""


@query("G32_pairwise_ibs", _ibs_sql(""))
def _(v):
    return gt.pairwise_ibs(calls(v), [*MEMBERS, *EMBRYOS])


@query("G32_pairwise_ibs_contig", _ibs_sql("chrom"))
def _(v):
    return gt.pairwise_ibs(calls(v), [*MEMBERS, *EMBRYOS], per_contig=True)




@query(
    "G31_relatedness_matrix",
    """
select "IID1", max(n) filter (where "IID2" = 'Mother') as "Mother", max(n) filter (where "IID2" = 'Embryo1') as "Embryo1"
from (select a.sample as "IID1", b.sample as "IID2", count(*) as n from calls a join calls b on a.site_id = b.site_id
  and a.gt = b.gt and a.gt <> './.'
  and list_position(['Father', 'Mother', 'Proband', 'Embryo1', 'Embryo2', 'Embryo3'], a.sample)
    < list_position(['Father', 'Mother', 'Proband', 'Embryo1', 'Embryo2', 'Embryo3'], b.sample) group by 1, 2) t group by 1""",
)
def _(v):
    pairs = gt.pairwise_ibs(calls(v), [*MEMBERS, *EMBRYOS])
    return gt.relatedness_matrix(pairs, "IBS2", ["Mother", "Embryo1"])
