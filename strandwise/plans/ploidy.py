"""Ploidy queries (survey section 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import ploidy as pl
from strandwise.plans.genotype import calls
from strandwise.plans.registry import query

_RATIO = """
select sample, chrom, unnest([ad0, ad1]) / cast(ad0 + ad1 as double) as ratio from calls
where gt = '0/1' and var_type = 'snp' and ad0 + ad1 > 10"""


@query("H1_het_ratios", f"select * from ({_RATIO}) t where ratio > 0")
def _(v):
    return pl.het_ratios(calls(v))


@query(
    "H1_het_ratios_regions",
    """
select sample, chrom, unnest([ad0, ad1]) / cast(ad0 + ad1 as double) as ratio from calls c
where gt = '0/1' and var_type = 'snp' and ad0 + ad1 > 10 and ad0 > 0 and ad1 > 0 and exists (
  select 1 from catalog g where g.chrom = c.chrom and c.pos > g.start and c.pos <= g.stop)""",
)
def _(v):
    return pl.het_ratios(calls(v).where("ad[0] > 0 and ad[1] > 0"), v("catalog"))


@query("H2_fit_two_peaks")
def _(v):
    return pl.fit_two_peaks(pl.het_ratios(calls(v)))


def _peaks(v):
    ratios = pl.het_ratios(calls(v))
    return pl.peak_quality(pl.fit_two_peaks(ratios), ratios)


@query("H3_peak_quality")
def _(v):
    return _peaks(v)


_DEPTH = """
with x as (select sample, chrom, cast(ad0 + ad1 as double) as x from calls where var_type = 'snp'),
p as (select sample, chrom, avg(x) as m, stddev_pop(x) as s, count(*) as n from x group by 1, 2),
h as (select sample, chrom, least(cast(floor(x) as bigint), 99) as b, count(*) as c from x where x >= 0 and x <= 100 group by all),
t as (select sample, chrom, sum(c) as total from h group by 1, 2),
g as (select p.sample, p.chrom, coalesce(h.c, 0) / cast(t.total as double) as y,
    exp(-pow(b.b + 0.5 - m, 2) / (2 * s * s)) / sqrt(2 * pi() * s * s) as f
  from p join t on t.sample = p.sample and t.chrom = p.chrom cross join (select unnest(range(0, 100)) as b) b
  left join h on h.sample = p.sample and h.chrom = p.chrom and h.b = b.b),
q as (select sample, chrom, 1 - sum(pow(y - f, 2)) / (sum(y * y) - sum(y) * sum(y) / 100) as r2 from g group by 1, 2)
select p.sample, p.chrom, m as depth_mean, s as depth_scale, n as n_sites, r2 as depth_r2_score from p join q
on q.sample = p.sample and q.chrom = p.chrom"""


@query("H4_fit_depth", _DEPTH)
def _(v):
    return pl.fit_depth(calls(v))


# peak fits of the test data come from a rule, so that the decision has an oracle
_FITS = """
select sample, chrom, case when chrom in ('chr1', 'chrX') then 0.9 else 0.5 end as ratio_r2_score,
  case when chrom = 'chr1' then 0.35 else 0.1 end as ratio_separate from sparse_calls group by sample, chrom"""


def _fits(v):
    two = v("sparse_calls").select("sample", "chrom").distinct()
    return two.select(
        "sample", "chrom", F.when(F.col("chrom").isin("chr1", "chrX"), 0.9).otherwise(0.5).alias("ratio_r2_score"),
        F.when(F.col("chrom") == "chr1", 0.35).otherwise(0.1).alias("ratio_separate"),
    )


_PLOIDY = f"""
select n.sample, n.chrom, coalesce(p, cast(round_even(m / one, 0) as int)) as ploidy,
  case when few then variant_num when p > 0 then ratio_separate else m / one end as score,
  case when few then 'variant_num' when p > 0 then 'ratio_separate' else 'depth_ratio' end as func
from (select sample, chrom, count(*) as variant_num, avg(ad0 + ad1) filter (where var_type = 'snp') as m, count(*) < 100 as few from sparse_calls
    group by 1, 2) n
join (select f.sample, f.chrom, ratio_separate, case when few then 0 when f.chrom = 'chr1' then 3 when f.chrom = 'chrX' then 2 end as p
  from ({_FITS}) f join (select sample, chrom, count(*) < 100 as few from sparse_calls group by 1, 2) c on c.sample = f.sample and c.chrom = f.chrom) f
  on f.sample = n.sample and f.chrom = n.chrom
join (select s.sample, avg((ad0 + ad1) / case s.chrom when 'chr1' then 3.0::double else 2.0::double end) as one from sparse_calls s
  join (select sample, chrom from sparse_calls group by 1, 2 having count(*) >= 100) d on d.sample = s.sample and d.chrom = s.chrom
  where var_type = 'snp' and s.chrom in ('chr1', 'chrX') group by s.sample) o on o.sample = n.sample"""


def _ploidy(v):
    # the mitochondrial contig has few sites of its own
    some = calls(v, "sparse_calls")
    return pl.call_ploidy(_fits(v), pl.fit_depth(some), some, min_sites=100)


@query("H5_call_ploidy", f"select * from ({_PLOIDY}) t")
def _(v):
    return _ploidy(v).select("sample", "chrom", "ploidy", "score", "func")


@query(
    "H6_karyotype",
    """
select sample, concat(sum(p), ',', string_agg(case when chrom in ('chrX', 'chrY') then repeat(substr(chrom, 4), p::int) end, '' order by chrom),
  coalesce(string_agg(case when chrom not in ('chrX', 'chrY') then case p when 1 then concat('H', substr(chrom, 4)) when 3 then concat('T', substr(chrom, 4)) end end, '' order by chrom), '')) as karyotype
from (select sample, chrom, count(*) filter (where gt = '0/1') % 4 as p from calls group by 1, 2) t group by sample""",
)
def _(v):
    rows = v("calls").groupBy("sample", "chrom").agg(
        (F.count_if(F.col("gt") == "0/1") % 4).cast("int").alias("ploidy")
    )
    return pl.karyotype(rows)


@query(
    "L4_ploidy_report",
    f"""
select sample, chrom as "Chromosome", ploidy as "Ploidy", func as "Func", score as "Score" from ({_PLOIDY}) t""",
)
def _(v):
    return pl.ploidy_report(_ploidy(v)).drop("R-square", "weak")
