"""Depth and read statistics queries (survey section 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions.columns import q
from strandwise.operators import coverage as cv
from strandwise.operators import intervals as iv
from strandwise.plans.registry import query
from strandwise.sources.alignments import base_depth_of_calls, read_blocks


@query("C1_base_depth", "select chrom, start, stop, depth from depth_run where stop is not null")
def _(v):
    return cv.base_depth(v("reads").select("chrom", "start", "stop"), block=1000)


@query(
    "C1_base_depth_per_base",
    """
select chrom, pos, count(*) as depth from (
  select rname as chrom, pos - 1 + i + gap as pos, substr(seq, cast(clip + i + more + 1 as bigint), 1) as base,
    ord(substr(qual, cast(clip + i + more + 1 as bigint), 1)) - 33 as bq
  from (select *, case when cigar like '%D%' and i >= len then 2 else 0 end as gap, case when cigar like '%I%' and i >= len then 1 else 0 end as more
    from (select *, unnest(range(0, len + case when cigar like '%D%' then 4 when cigar like '%I%' then 5 else 0 end)) as i
      from sam where flag & 1796 = 0) s) t
) u where bq >= 15 and base in ('A', 'C', 'G', 'T') group by chrom, pos""",
)
def _(v):
    return base_depth_of_calls(v("sam"), min_quality=15)


@query(
    "C1_aligned_blocks",
    """
select rname as chrom, pos - 1 as start, pos - 1 + len as stop, count(*) as n from sam
where flag & 1796 = 0 group by 1, 2, 3
union all
select rname, pos - 1 + len + 2, pos - 1 + len + 6, count(*) from sam
where flag & 1796 = 0 and cigar like '%D%' group by 1, 2, 3
union all
select rname, pos - 1 + len, pos - 1 + len + 5, count(*) from sam
where flag & 1796 = 0 and cigar like '%I%' group by 1, 2, 3""",
)
def _(v):
    blocks = read_blocks(v("sam"))
    main = F.col("start") == F.col("read_start")
    kind = F.when(main, 0).when(F.col("cigar").contains("D"), 1).otherwise(2)
    return (
        blocks.groupBy("chrom", "start", "stop", kind.alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .drop("k")
    )


_BREADTH = ", ".join(
    f"""cast(sum(case when d.uni >= {c} then 1 else 0 end) as bigint) as "coverage>={c}(rm_dup)\""""
    for c in (1, 4, 10, 20)
)
_COVER = f"""
select g.region_id, g.chrom, g.start, g.stop, g.gene, g.stop - g.start as size,
  coalesce(n.reads_uni, 0) as "reads_on_target(rm_dup)", coalesce(n.reads_dup, 0) as "reads_on_target(dup)",
  cast(coalesce(sum(d.uni), 0) as bigint) as "base_on_target(rm_dup)",
  cast(coalesce(sum(d.dup), 0) as bigint) as "base_on_target(dup)", {_BREADTH}
from regions g
left join (select chrom, pos, sum(case when is_dup then 0 else 1 end) as uni,
  sum(case when is_dup then 1 else 0 end) as dup from per_base group by chrom, pos) d
  on d.chrom = g.chrom and d.pos >= g.start and d.pos < g.stop
left join (select x.region_id, cast(sum(case when r.is_dup then 0 else 1 end) as bigint) as reads_uni,
  cast(sum(case when r.is_dup then 1 else 0 end) as bigint) as reads_dup
  from regions x join reads r on r.chrom = x.chrom and r.start < x.stop and x.start < r.stop
  group by x.region_id) n on n.region_id = g.region_id
group by g.region_id, g.chrom, g.start, g.stop, g.gene, n.reads_uni, n.reads_dup"""


@query("C2_region_coverage", _COVER)
def region_coverage(v):
    return cv.region_coverage(
        v("reads").select("chrom", "start", "stop", "is_dup"),
        v("regions").select("region_id", "chrom", "start", "stop", "gene"),
    )


@query(
    "C3_region_depth",
    """
select sample, region_id, base, base / cast(size as double) as mean_depth, n / cast(size as double) as coverage
from (select s.sample, g.region_id, g.stop - g.start as size,
  cast(coalesce(sum(d.depth), 0) as bigint) as base, count(d.depth) as n
  from (select *, unnest(['S0', 'S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7']) as sample from regions) g
  join (select unnest(['S0', 'S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7']) as sample) s on s.sample = g.sample
  left join (select sample, chrom, pos, count(*) as depth from per_base where not is_dup group by 1, 2, 3) d
  on d.sample = g.sample and d.chrom = g.chrom and d.pos >= g.start and d.pos < g.stop
  group by s.sample, g.region_id, g.stop, g.start) t""",
)
def _(v):
    return cv.region_depth(
        v("reads"),
        v("regions").select("region_id", "chrom", "start", "stop"),
        sample="sample",
        samples=[f"S{i}" for i in range(8)],
    ).select("sample", "region_id", "base", "mean_depth", "coverage")


@query("C4_bedgraph", "select chrom, start, stop, depth from depth_run where depth > 0")
def _(v):
    return cv.bedgraph(v("reads").select("chrom", "start", "stop"))


@query(
    "C5_on_off_target",
    """
select chromosome, base, offtarget, base - offtarget as ontarget, all_base,
  base / cast(all_base as double) as base_rate, offtarget / cast(all_base as double) as offtarget_rate,
  (base - offtarget) / cast(all_base as double) as ontarget_rate
from (select chromosome, base, offtarget, cast(sum(base) over () as bigint) as all_base from (
  select case d.chrom when 'chrX' then 'Unlocalized' when 'chrY' then 'Decoy' when 'chr3' then 'Unplaced'
    else d.chrom end as chromosome, cast(sum(depth) as bigint) as base,
    cast(sum(case when t.pos is null then depth else 0 end) as bigint) as offtarget
  from base_depth d left join target_base t on d.chrom = t.chrom and d.pos = t.pos group by 1) a) b""",
)
def _(v):
    names = F.create_map(
        *[F.lit(x) for x in ("chrX", "chr4_g_random", "chrY", "chrUn_7_decoy", "chr3", "chrUn_9")]
    )
    renamed = F.coalesce(names[F.col("chrom")], F.col("chrom"))
    depth = cv.bedgraph(v("reads").withColumn("chrom", renamed))
    return cv.on_off_target(depth, v("regions").withColumn("chrom", renamed))


@query(
    "C6_read_stats",
    """
with p as (select *, flag & 4 = 0 as mapped, flag & 1024 <> 0 as dup,
  len + case when cigar like '%D%' then 6 when cigar like '%I%' then 5 else 0 end as mlen
  from sam where flag & 2304 = 0)
select *, total_reads * max_len as all_bases, gc_bases * 100 / cast(mapped_bases as double) as gc_rate,
  mapped_reads * 100 / cast(total_reads as double) as mapping_rate,
  duplicate_reads * 100 / cast(mapped_reads as double) as duplication_rate,
  mismatch_reads * 100 / cast(mapped_reads as double) as mismatch_rate,
  indel_reads * 100 / cast(mapped_reads as double) as indel_rate
from (select count(*) as total_reads, cast(max(length(seq)) as int) as max_len,
  count(*) filter (where mapped) as mapped_reads, count(*) filter (where mapped and dup) as duplicate_reads,
  count(*) filter (where mapped and flag & 8 = 0) as pair_mapped_reads,
  count(*) filter (where mapped and (cigar like '%I%' or cigar like '%D%')) as indel_reads,
  count(*) filter (where mapped and md_sub) as mismatch_reads,
  cast(sum(mlen) filter (where mapped) as bigint) as mapped_bases,
  cast(sum(mlen) filter (where mapped and not dup) as bigint) as mapped_bases_rmdup,
  cast(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) filter (where mapped) as bigint) as gc_bases,
  cast(sum(length(regexp_replace(seq, '[^AT]', '', 'g'))) filter (where mapped) as bigint) as at_bases,
  cast(sum(length(regexp_replace(seq, '[^N]', '', 'g'))) filter (where mapped) as bigint) as n_bases from p) t""",
)
def _(v):
    return cv.read_stats(v("sam"))


def _share(kind: str, k: int, name: str) -> str:
    return f"sum(case when {kind} >= {k} then 1 else 0 end) * 100 / cast(count(*) as double) as {name}"


_CAPTURE = f"""
with tb as (select t.chrom, t.pos, coalesce(d.depth, 0) as depth, coalesce(u.n, 0) as uniq from target_base t
  left join base_depth d on d.chrom = t.chrom and d.pos = t.pos
  left join (select chrom, pos, count(*) as n from per_base where not is_dup group by 1, 2) u
  on u.chrom = t.chrom and u.pos = t.pos),
b as (select count(*) as target_size, cast(sum(depth) as bigint) as target_bases,
  cast(sum(uniq) as bigint) as target_bases_rmdup,
  {", ".join(_share("depth", k, f"coverage_{k}x") for k in (1, 4, 10, 20))},
  {", ".join(_share("uniq", k, f"coverage_{k}x_rmdup") for k in (1, 4, 10, 20))} from tb),
h as (select r.*, exists (select 1 from regions g where r.chrom = g.chrom and r.start < g.stop and g.start < r.stop)
  as hit from reads r),
m as (select count(*) as mapped_reads, count(*) filter (where not is_dup) as mapped_reads_rmdup,
  sum(stop - start) as mb, sum(stop - start) filter (where not is_dup) as mbu,
  count(*) filter (where hit) as target_reads, count(*) filter (where hit and not is_dup) as target_reads_rmdup,
  count(*) * max(stop - start) as ab from h)
select b.*, mapped_reads, mapped_reads_rmdup, target_reads, target_reads_rmdup,
  target_bases_rmdup * 100 / cast(ab as double) as use_rate,
  target_reads * 100 / cast(mapped_reads as double) as specificity,
  target_reads_rmdup * 100 / cast(mapped_reads_rmdup as double) as specificity_rmdup,
  target_bases * 100 / cast(mb as double) as efficiency,
  target_bases_rmdup * 100 / cast(mbu as double) as efficiency_rmdup,
  target_bases / cast(target_size as double) as mean_depth,
  target_bases_rmdup / cast(target_size as double) as mean_depth_rmdup from b, m"""


@query("C7_capture_metrics", _CAPTURE)
def _(v):
    reads = v("reads").withColumn("length", F.col("stop") - F.col("start"))
    return cv.capture_metrics(reads, v("regions"))


@query(
    "C7_capture_flanks",
    """
with fl as (select distinct chrom, unnest(range(greatest(start - 6, 0), least(stop + 6, (select max(length)
    from chrom_len c where c.chrom = i.chrom)))) as pos from island i),
fb as (select f.chrom, f.pos, coalesce(u.n, 0) as uniq from fl f
  left join (select chrom, pos, count(*) as n from per_base where not is_dup group by 1, 2) u
  on u.chrom = f.chrom and u.pos = f.pos)
select count(*) as flanking_size, sum(uniq) / cast(count(*) as double) as flanking_depth_rmdup,
  sum(case when uniq >= 4 then 1 else 0 end) * 100 / cast(count(*) as double) as flanking_4x_rmdup from fb""",
)
def _(v):
    reads = v("reads").withColumn("length", F.col("stop") - F.col("start"))
    return cv.capture_metrics(reads, v("regions"), v("chrom_len"), 6).select(
        "flanking_size", "flanking_depth_rmdup", "flanking_4x_rmdup"
    )


_TARGET_DEPTH = """
select t.chrom, t.pos, coalesce(d.depth, 0) as depth from target_base t
left join base_depth d on d.chrom = t.chrom and d.pos = t.pos"""


@query(
    "C8_depth_histogram",
    f"""
select depth, n_bases, n_bases / cast(total as double) as fraction, n_at_least,
  n_at_least / cast(total as double) as fraction_at_least
from (select depth, n_bases, cast(sum(n_bases) over () as bigint) as total,
  cast(sum(n_bases) over (order by depth desc) as bigint) as n_at_least
  from (select depth, count(*) as n_bases from ({_TARGET_DEPTH}) x group by depth) y) z""",
)
def _(v):
    return cv.depth_histogram(cv.target_depth_runs(v("reads"), v("regions")))


@query(
    "C9_insert_size_histogram",
    """
select least(tlen, 2000) as insert_size, count(*) as n, count(*) * 2 / cast((select count(*) from sam
  where flag & 2308 = 0 and flag & 8 = 0) as double) as fraction
from sam where flag & 2308 = 0 and tlen > 0 group by 1""",
)
def _(v):
    return cv.insert_size_histogram(v("sam"))


@query(
    "C10_contig_depth",
    f"""
select chrom, count(*) as target_size, round_even(sum(case when depth > 0 then 1 else 0 end)
  / cast(count(*) as double), 4) as coverage, round_even(sum(depth) / cast(count(*) as double), 2) as depth
from ({_TARGET_DEPTH}) x group by chrom""",
)
def _(v):
    return cv.contig_depth(cv.target_depth_runs(v("reads"), v("regions")))


@query(
    "C11_classify_reads",
    """
select chrom, start, stop, qname, ord, case
  when exists (select 1 from catalog c where c.chrom = r.chrom and r.start < c.stop and c.start < r.stop) then 'target'
  when exists (select 1 from (select chrom, start, stop from regions where region_id % 3 = 0) g
    where g.chrom = r.chrom and r.start < g.stop and g.start < r.stop) then 'flank' else 'other' end as place
from reads r""",
)
def _(v):
    return cv.classify_reads(
        v("reads").select("chrom", "start", "stop", "qname", "ord"),
        v("catalog"),
        v("regions").where("region_id % 3 = 0"),
    )


@query(
    "C12_base_composition",
    """
select site_id, ref, alt, n_a as "A", n_c as "C", n_g as "G", n_t as "T",
  case alt when 'A' then n_a when 'C' then n_c when 'G' then n_g when 'T' then n_t else 0 end
    / cast(n_a + n_c + n_g + n_t as double) as alt_ratio,
  case ref when 'A' then n_a when 'C' then n_c when 'G' then n_g when 'T' then n_t else 0 end
    / cast(n_a + n_c + n_g + n_t as double) as ref_ratio
from (select site_id, ref, alt, count(*) filter (where base = 'A') as n_a, count(*) filter (where base = 'C') as n_c,
  count(*) filter (where base = 'G') as n_g, count(*) filter (where base = 'T') as n_t from (
    select s.site_id, s.ref, s.alt, substr('ACGT', cast((c.ad0 + c.ad1) % 4 + 1 as bigint), 1) as base
    from sites s join calls c on s.site_id = c.site_id) t group by 1, 2, 3) u""",
)
def _(v):
    bases = v("calls").select(
        "site_id", "ref", "alt", F.expr("substring('ACGT', cast((ad0 + ad1) % 4 + 1 as int), 1)").alias("base")
    )
    return cv.base_composition(bases, ["site_id"])


@query(
    "C13_side_depth_ratio",
    """
select name, 1 - before / cast(nullif(after, 0) as double) as depth_ratio from (
  select c.name, sum(case when d.pos < c.start + 9 then d.depth else 0 end) as before,
    sum(case when d.pos >= c.start + 9 then d.depth else 0 end) as after
  from catalog c join base_depth d on d.chrom = c.chrom and d.pos >= c.start - 5 and d.pos < c.start + 23
  group by c.name) t""",
)
def _(v):
    sites = v("catalog").select("chrom", "name", (F.col("start") + 10).alias("pos"))
    depth = cv.bedgraph(v("reads").select("chrom", "start", "stop"))
    return cv.side_depth_ratio(depth, sites).select("name", "depth_ratio")


@query(
    "C14_clipped_read_ratio",
    """
select region_id, count(*) as n_reads, avg(case when s.cigar like '%S%' then 1.0 else 0.0 end) as clip_ratio
from (select *, pos - 1 as start, pos - 1 + len + case when cigar like '%D%' then 6 when cigar like '%I%'
  then 5 else 0 end as stop from sam where flag & 1540 = 0) s
join regions g on s.rname = g.chrom and s.start < g.stop and g.start < s.stop group by region_id""",
)
def _(v):
    reads = v("sam").select(
        F.col("rname").alias("chrom"),
        (F.col("pos") - 1).alias("start"),
        (F.col("pos") - 1 + cv.mapped_length(F.col("cigar"))).alias("stop"),
        "flag",
        "cigar",
    )
    return cv.clipped_read_ratio(reads, v("regions").select("chrom", "start", "stop", "region_id"), ["region_id"])


@query(
    "C15_interval_mean_depth",
    """
select c.name, round_even(coalesce(sum(d.n), 0) / cast(c.stop - c.start as double), 3) as mean_depth from catalog c
left join (select chrom, pos, count(*) as n from per_base where not is_dup group by 1, 2) d
on d.chrom = c.chrom and d.pos >= c.start and d.pos < c.stop group by c.name, c.start, c.stop""",
)
def _(v):
    return cv.interval_mean_depth(v("reads"), v("catalog"), 3).select("name", "mean_depth")
