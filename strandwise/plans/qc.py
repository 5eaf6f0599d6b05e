"""Quality control queries (survey section 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import qc
from strandwise.operators.genotype import ado_rate
from strandwise.plans.genotype import EMBRYOS, calls
from strandwise.plans.registry import query

_NAMES = {
    "reads_uni": "reads_on_target(rm_dup)", "reads_dup": "reads_on_target(dup)",
    "base_uni": "base_on_target(rm_dup)", "base_dup": "base_on_target(dup)",
    "c1": "coverage>=1(rm_dup)", "c4": "coverage>=4(rm_dup)",
    "c10": "coverage>=10(rm_dup)", "c20": "coverage>=20(rm_dup)",
}


def cover(v):
    return v("cover").withColumnsRenamed(_NAMES)


def _fastp(v):
    return v("fastp").select("sample", "total_reads", "raw_bases")


def _shares(den: str = "sum(size)") -> str:
    cells = [("base_uni", "mean_depth(rm_dup)")] + [(f"c{k}", f"coverage>={k}(rm_dup)") for k in (1, 4, 10, 20)]
    return ", ".join(f'round_even(sum({c}) / cast({den} as double), 4) as "{n}"' for c, n in cells)


_SAMPLE_QC = f"""
select t.sample, genome_size, concat(cast(cast(round_even(coalesce(raw_bases, 0) / 1e9, 0) as bigint) as varchar), 'G') as raw_bases,
  round_even(n_all / cast(total_reads as double), 4) as mapped_rate,
  round_even(n_uni / cast(total_reads as double), 4) as "mapped_rate(rm_dup)", dup_rate, "mean_depth(rm_dup)",
  "coverage>=1(rm_dup)", "coverage>=4(rm_dup)", "coverage>=10(rm_dup)", "coverage>=20(rm_dup)"
from (select sample, concat(cast(cast(round_even(sum(size) / 1e6, 0) as bigint) as varchar), 'M') as genome_size,
    round_even(sum(reads_dup) / cast(sum(reads_dup) + sum(reads_uni) as double), 4) as dup_rate, {_shares()}
  from cover where chromosome <> 'chrM' group by sample) t
join (select sample, sum(reads_uni + reads_dup) as n_all, sum(reads_uni) as n_uni from cover group by sample) a on a.sample = t.sample
left join fastp f on f.sample = t.sample"""


@query("D1_sample_qc", _SAMPLE_QC)
def sample_qc(v):
    return qc.sample_qc(cover(v), _fastp(v))


@query(
    "D1_sample_qc_mitochondrion",
    f"""
select sample, concat(cast(cast(round_even(sum(size) / 1e6, 0) as bigint) as varchar), 'M') as genome_size, {_shares()}
from cover where chromosome <> 'chr3' group by sample""",
)
def _(v):
    renamed = cover(v).withColumn("chromosome", F.when(F.col("chromosome") == "chr3", "chrM").otherwise(F.col("chromosome")))
    out = qc.sample_qc(renamed, missing_totals="zero")
    return out.drop("raw_bases", "mapped_rate", "mapped_rate(rm_dup)", "dup_rate")


_SEX = """
select sample, x as "depX", y as "depY", round_even(x / nullif(m, 0), 4) as "XRatio",
  round_even(y / nullif(m, 0), 4) as "YRatio",
  case when m <> 0 then case when round_even(y / m, 4) > 0.25 then 'M' else 'F' end end as gender
from (select sample, sum(base_uni) / cast(sum(size) as double) as m,
  round_even(sum(base_uni) filter (where chromosome = 'chrX') / cast(sum(size) filter (where chromosome = 'chrX') as double), 4) as x,
  round_even(sum(base_uni) filter (where chromosome = 'chrY') / cast(sum(size) filter (where chromosome = 'chrY') as double), 4) as y
  from cover group by sample) t"""


@query("D2_infer_sex", _SEX)
def _(v):
    return qc.infer_sex(cover(v))


_GENE = f"select sample, gene, {_shares('sum(size) - sum(n_size)')} from cover group by sample, gene"


@query("D3_gene_qc", _GENE)
def _(v):
    return qc.gene_qc(cover(v))


@query(
    "D3_gene_unknown_bases",
    """
select region_id, cast(length(regexp_replace(substr(txt, greatest(g.start, 1), g.stop - greatest(g.start, 1) + 1), '[^N]', '', 'g'))
  as bigint) as n_size from regions g join ref_text t on g.chrom = t.chrom""",
)
def _(v):
    from strandwise.sources.sequence import unknown_bases

    rows = v("regions").select("region_id", "chrom", "start", "stop")
    return unknown_bases(rows, v("ref_chunks"), 12).select("region_id", "n_size")


_INFO = "select distinct sample, case when sample = 'S3' then 'unknown' else gender end as gender_provided from cover"


@query(
    "D4_qc_verdicts",
    f"""
select q.sample, raw_bases, case when gender_provided = 'unknown' then 'NA' when gender_provided = gender then 'PASS'
    else 'NO PASS' end as gender_result,
  case when "coverage>=4(rm_dup)" >= 0.9 then 'PASS' else 'NO PASS' end as cov_result,
  case when cast(replace(raw_bases, 'G', '') as bigint) >= 45 then 'PASS' else 'NO PASS' end as rawbase_result,
  case when "mean_depth(rm_dup)" >= 15 then 'PASS' else 'NO PASS' end as mean_depth_result
from ({_SAMPLE_QC}) q join ({_SEX}) s on q.sample = s.sample join ({_INFO}) i on q.sample = i.sample""",
)
def _(v):
    df = qc.sample_qc(cover(v), _fastp(v)).join(qc.infer_sex(cover(v)), "sample").join(_info(v), "sample")
    return qc.qc_verdicts(df).select(
        "sample", "raw_bases", "gender_result", "cov_result", "rawbase_result", "mean_depth_result"
    )


def _info(v):
    provided = F.when(F.col("sample") == "S3", "unknown").otherwise(F.col("gender"))
    return v("cover").select("sample", provided.alias("gender_provided")).distinct()


_GENES = ["G0", "G1", "G2"]
_ADO = """
select gene, sample, count(*) as meet, cast(sum(case when g in (left(f, 1), left(m, 1)) and d >= 4 then 1 else 0 end) as bigint) as "ADO",
  round_even(sum(case when g in (left(f, 1), left(m, 1)) and d >= 4 then 1 else 0 end) / cast(count(*) as double), 4) as rate
from (select tag.gene, e.sample, f.gt as f, m.gt as m, e.ad0 + e.ad1 as d,
    case when e.gt in ('0/0', '1/1') then left(e.gt, 1) end as g
  from calls f join calls m on f.site_id = m.site_id and m.sample = 'Mother'
  join calls e on e.site_id = f.site_id and e.sample like 'Embryo%'
  join (select site_id, 'all_gene' as gene from sites where chrom not in ('chrX', 'chrY') union all
    select s.site_id, t.gene from sites s join targets t on s.chrom = t.chrom and s.pos > t.start_extend and s.pos <= t.end_extend) tag
  on tag.site_id = f.site_id
  where f.sample = 'Father' and f.filter <> 'LowQual' and f.var_type = 'snp' and f.gt in ('0/0', '1/1') and m.gt in ('0/0', '1/1')
    and f.gt <> m.gt and f.ad0 + f.ad1 >= 10 and m.ad0 + m.ad1 >= 10) t group by gene, sample"""


@query("D6_ado_rate", _ADO)
def _(v):
    return ado_rate(calls(v), v("targets"), EMBRYOS)


_DEPTHS = ", ".join(f"""max("mean_depth(rm_dup)") filter (where gene = '{g}') as "mean_depth(rm_dup)_{g}\"""" for g in _GENES)


def _family_ado(v):
    # the sheet's first embryos carry the samples' names here
    names = F.create_map(*[F.lit(x) for i, e in enumerate(EMBRYOS) for x in (e, f"S{i}")])
    gene = F.translate("gene", "T_chr", "G")
    rates = ado_rate(calls(v), v("targets"), EMBRYOS)
    return rates.withColumn("sample", names[F.col("sample")]).withColumn(
        "gene", F.when(F.col("gene") == "all_gene", F.col("gene")).otherwise(F.concat(F.lit("G"), F.element_at(F.split("gene", "chr"), -1)))
    )


@query(
    "D5_qc_wide",
    f"""
select i.sample, gender_provided, "mean_depth(rm_dup)_G1", genome_size, "ADO_all_gene", "ADO_G1" from ({_INFO}) i
left join ({_SAMPLE_QC}) q on q.sample = i.sample
left join (select sample, {_DEPTHS} from ({_GENE}) g group by sample) d on d.sample = i.sample
left join (select concat('S', cast(cast(substr(sample, 7) as int) - 1 as varchar)) as sample,
  max(rate) filter (where gene = 'all_gene') as "ADO_all_gene", max(rate) filter (where gene = 'T_chr1') as "ADO_G1"
  from ({_ADO}) a group by 1) a on a.sample = i.sample""",
)
def _(v):
    out = qc.qc_wide(_info(v), qc.sample_qc(cover(v), _fastp(v)), qc.gene_qc(cover(v)), _family_ado(v), _GENES)
    return out.select("sample", "gender_provided", "`mean_depth(rm_dup)_G1`", "genome_size", "ADO_all_gene", "ADO_G1")


def _summary(v):
    return v("fastp").select(
        "sample",
        F.col("total_reads").alias("number_reads"),
        F.col("q20").alias("r1_q30_bases_fract"),
        F.col("q30").alias("r2_q30_bases_fract"),
    )


_LFR_GENES = ", ".join(
    f"""max("{f}") filter (where gene = '{g}') as "{f}_{g}\""""
    for g in _GENES
    for f in ("mean_depth(rm_dup)", "coverage>=10(rm_dup)")
)


@query(
    "D7_linked_read_qc",
    f"""
select f.sample, total_reads as number_reads, (q20 + q30) / 2 as q30_bases_fract, genome_size, "mean_depth(rm_dup)_G2",
  "coverage>=10(rm_dup)_G0" from fastp f join ({_SAMPLE_QC}) q on q.sample = f.sample
join (select sample, {_LFR_GENES} from ({_GENE}) g group by sample) d on d.sample = f.sample""",
)
def _(v):
    out = qc.linked_read_qc(_summary(v), qc.sample_qc(cover(v), _fastp(v)), qc.gene_qc(cover(v)), _GENES)
    return out.select(
        "sample", "number_reads", "q30_bases_fract", "genome_size", "`mean_depth(rm_dup)_G2`", "`coverage>=10(rm_dup)_G0`"
    )


@query(
    "D8_report_qc",
    f"""
select sample, 'wgs' as kind, raw_bases, "coverage>=4(rm_dup)" as cov, null as gene_cov from ({_SAMPLE_QC}) q where raw_bases is not null
union all
select f.sample, 'lfr', concat(cast(cast(round_even(total_reads / 1e7, 0) as bigint) as varchar), 'G'), "coverage>=10(rm_dup)", gc
from fastp f join ({_SAMPLE_QC}) q on q.sample = f.sample
join (select sample, max("coverage>=10(rm_dup)") filter (where gene = 'G0') as gc from ({_GENE}) g group by sample) d on d.sample = f.sample""",
)
def _(v):
    wgs = qc.sample_qc(cover(v), _fastp(v)).join(qc.infer_sex(cover(v)), "sample").join(_info(v), "sample")
    wgs = wgs.withColumn("sampleID", F.lit("wgs"))
    lfr = qc.linked_read_qc(
        _summary(v), wgs.drop("raw_bases", "mapped_rate"), qc.gene_qc(cover(v)), _GENES
    ).withColumn("sampleID", F.lit("lfr"))
    return qc.report_qc(wgs, lfr).select(
        "sample",
        F.col("sampleID").alias("kind"),
        "raw_bases",
        F.col("`coverage(rm_dup)`").alias("cov"),
        F.col("`gene_coverage(rm_dup)_G0`").alias("gene_cov"),
    )


@query(
    "D9_fastq_quality",
    """
select sample as "sampleID", q20 as "Q20_before_filtering", q30 as "Q30_before_filtering",
  q20 / 2 as "Q20_after_filtering", q30 / 2 as "Q30_after_filtering" from fastp""",
)
def _(v):
    text = F.to_json(
        F.struct(
            F.struct(
                F.struct(F.col("q20").alias("q20_rate"), F.col("q30").alias("q30_rate"), F.col("raw_bases").alias("total_bases")).alias("before_filtering"),
                F.struct((F.col("q20") / 2).alias("q20_rate"), (F.col("q30") / 2).alias("q30_rate"), F.col("total_reads")).alias("after_filtering"),
            ).alias("summary")
        )
    )
    from strandwise.sources.tables import parse_fastp_json

    docs = v("fastp").select(F.concat(F.lit("/d/"), "sample", F.lit(".fastp.json")).alias("path"), text.alias("value"))
    return qc.fastq_quality(parse_fastp_json(docs))


@query(
    "D10_merge_family_qc",
    """
select sample, base_uni, c1, concat('F', cast(size % 7 as varchar)) as "Family" from cover where chromosome <> 'chr2' union all
select sample, base_uni, null, 'FX' from cover where chromosome = 'chr2'""",
)
def _(v):
    one = v("cover").where("chromosome <> 'chr2'").selectExpr(
        "sample", "base_uni", "c1", "concat('/w/F', size % 7, '/QC.tsv') as path"
    )
    two = v("cover").where("chromosome = 'chr2'").selectExpr("sample", "base_uni", "'/w/FX/QC.tsv' as path")
    return qc.merge_family_qc([one, two])


@query(
    "D11_attach",
    """
select sample as "sampleID", sum(base_uni)::bigint as base, q20 from cover join fastp using (sample) group by sample, q20""",
)
def _(v):
    base = v("cover").groupBy(F.col("sample").alias("sampleID")).agg(F.sum("base_uni").alias("base"))
    return qc.attach(base, v("fastp").withColumnRenamed("sample", "sampleID"), ["q20"])
