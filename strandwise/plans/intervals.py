"""Interval queries (survey section 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import intervals as iv
from strandwise.plans.registry import query
from strandwise.sources import sequence


@query("B1_merge_intervals", "select chrom, start, stop from island")
def _(v):
    return iv.merge_intervals(v("regions"))


@query(
    "B2_union_with_extension",
    """
select chrom, min(start) as start, max(stop) as stop from (
  select *, sum(f) over (partition by chrom order by start, stop rows unbounded preceding) as g from (
    select *, case when start > coalesce(max(stop) over (partition by chrom order by start, stop
      rows between unbounded preceding and 1 preceding) + 7, -1) then 1 else 0 end as f from regions) t
) u group by chrom, g""",
)
def _(v):
    return iv.union_with_extension(v("regions"), 7)


@query(
    "B3_slop",
    """
select r.chrom, greatest(0, start - 15) as start, least(length, stop + 15) as stop, gene, region_id, strand
from regions r join chrom_len c on r.chrom = c.chrom""",
)
def _(v):
    return iv.slop(v("regions"), 15, v("chrom_len")).select(
        "chrom", "start", "stop", "gene", "region_id", "strand"
    )


@query(
    "B4_flank_segments",
    """
select * from (
  select chrom, start, stop from (
    select i.chrom, greatest(0, i.start - 6) as start, i.start as stop,
      lag(i.stop) over (partition by i.chrom order by i.start) as prev, i.start as s0
    from island i) t where prev is null or s0 - prev > 6
  union all
  select i.chrom, i.stop,
    case when lead(i.start) over (partition by i.chrom order by i.start) - i.stop <= 6
      then lead(i.start) over (partition by i.chrom order by i.start)
      else least(c.length, i.stop + 6) end
  from island i join chrom_len c on i.chrom = c.chrom
) u where start < stop""",
)
def _(v):
    return iv.flank_segments(v("regions"), 6, v("chrom_len"))


@query(
    "B5_intersect_intervals",
    """
select a.chrom, greatest(a.start, b.start) as start, least(a.stop, b.stop) as stop, a.region_id, b.name
from regions a join catalog b on a.chrom = b.chrom and a.start < b.stop and b.start < a.stop""",
)
def _(v):
    return iv.intersect_intervals(v("regions").drop("gene", "strand"), v("catalog"))


@query(
    "B6_subtract_intervals",
    """
select chrom, depth, count(*) as n_bases, cast(sum(pos) as bigint) as sum_pos
from base_depth d where not exists (select 1 from target_base t where t.chrom = d.chrom and t.pos = d.pos)
group by chrom, depth""",
)
def _(v):
    from strandwise.operators.coverage import bedgraph

    left = iv.subtract_intervals(bedgraph(v("reads")), v("regions"), payload="depth")
    n = F.col("stop") - F.col("start")
    spread = ((F.col("start") + F.col("stop") - 1) * n / 2).cast("long")
    return left.groupBy("chrom", "depth").agg(F.sum(n).alias("n_bases"), F.sum(spread).alias("sum_pos"))


@query(
    "B6_subtract_plain",
    """
select chrom, count(*) as n_bases, cast(sum(pos) as bigint) as sum_pos from base_depth d
where not exists (select 1 from target_base t where t.chrom = d.chrom and t.pos = d.pos) group by chrom""",
)
def _(v):
    left = iv.subtract_intervals(v("reads"), v("regions"))
    n = F.col("stop") - F.col("start")
    spread = ((F.col("start") + F.col("stop") - 1) * n / 2).cast("long")
    return left.groupBy("chrom").agg(F.sum(n).alias("n_bases"), F.sum(spread).alias("sum_pos"))


_PAIRS = """
select r.chrom, r.qname, r.start, r.stop, g.region_id from reads r join regions g
on r.chrom = g.chrom and r.start < g.stop and g.start < r.stop"""


@query("B7_overlap_join", _PAIRS)
def _(v):
    return iv.overlap_join(
        v("reads").select("chrom", "qname", "start", "stop"),
        v("regions").select("chrom", "start", "stop", "region_id"),
        bin_size=128,
        long_intervals=False,
    ).drop("b_start", "b_stop")


@query("B7_overlap_join_salted", _PAIRS)
def _(v):
    return iv.overlap_join(
        v("reads").select("chrom", "qname", "start", "stop"),
        v("regions").select("chrom", "start", "stop", "region_id"),
        bin_size=128,
        hot_rows=100,
    ).drop("b_start", "b_stop")


@query(
    "B7_overlap_left",
    """
select g.chrom, g.start, g.stop, g.region_id, c.name from regions g left join catalog c
on g.chrom = c.chrom and g.start < c.stop and c.start < g.stop""",
)
def _(v):
    return iv.overlap_join(
        v("regions").select("chrom", "start", "stop", "region_id"), v("catalog"), "left"
    ).drop("b_start", "b_stop")


@query(
    "B7_overlap_semi",
    """
select chrom, qname, start, stop from reads r where exists (select 1 from catalog c
where r.chrom = c.chrom and r.start < c.stop and c.start < r.stop)""",
)
def _(v):
    return iv.overlap_join(v("reads").select("chrom", "qname", "start", "stop"), v("catalog"), "semi")


@query(
    "B7_overlap_anti",
    """
select chrom, qname, start, stop from reads r where not exists (select 1 from catalog c
where r.chrom = c.chrom and r.start < c.stop and c.start < r.stop)""",
)
def _(v):
    return iv.overlap_join(v("reads").select("chrom", "qname", "start", "stop"), v("catalog"), "anti")


@query(
    "B7_count_overlaps",
    """
select g.chrom, g.start, g.stop, g.region_id, count(r.start) as n_overlaps from regions g left join reads r
on r.chrom = g.chrom and r.start < g.stop and g.start < r.stop group by 1, 2, 3, 4""",
)
def _(v):
    return iv.count_overlaps(v("regions").select("chrom", "start", "stop", "region_id"), v("reads"))


@query(
    "B8_point_in_interval",
    """
select site_id, chrom, pos, region_id, gene from (
  select s.site_id, s.chrom, s.pos, g.region_id, g.gene,
    row_number() over (partition by s.site_id order by g.region_id) as rn
  from sites s join regions g on s.chrom = g.chrom and s.pos - 6 between g.start and g.stop
) t where rn = 1""",
)
def _(v):
    return iv.point_in_interval(
        v("sites").select("site_id", "chrom", "pos"),
        v("regions").select("chrom", "start", "stop", "region_id", "gene"),
        -6,
        point_key=["site_id"],
        ordinal="region_id",
    ).select("site_id", "chrom", "pos", "region_id", "gene")


@query(
    "B9_reciprocal_overlap",
    """
select * from (
  select r.qname, r.chrom, r.start, r.stop, c.name,
    (least(r.stop, c.stop) - greatest(r.start, c.start)) / cast(c.stop - c.start as double) as overlap_rate_aim,
    (least(r.stop, c.stop) - greatest(r.start, c.start)) / cast(r.stop - r.start as double) as overlap_rate_self
  from reads r join catalog c on r.chrom = c.chrom and r.start < c.stop and c.start < r.stop
) t where overlap_rate_aim >= 0.5 and overlap_rate_self >= 0.5""",
)
def _(v):
    return iv.reciprocal_overlap(
        v("reads").select("qname", "chrom", "start", "stop"), v("catalog")
    ).drop("b_start", "b_stop")


def _best(order: str, fallback: bool) -> str:
    start = "coalesce(b_start, t.start)" if fallback else "b_start"
    stop = "coalesce(b_stop, t.stop)" if fallback else "b_stop"
    return f"""
select t.name, t.chrom, {start} as b_start, {stop} as b_stop, rate from catalog t left join (
  select * from (
    select c.name, g.start as b_start, g.stop as b_stop,
      (least(g.stop, c.stop) - greatest(g.start, c.start)) / cast(c.stop - c.start as double) as rate,
      row_number() over (partition by c.name order by
        (least(g.stop, c.stop) - greatest(g.start, c.start)) / cast(c.stop - c.start as double) desc,
        g.region_id {order}) as rn
    from catalog c join (select * from regions where region_id % 3 = 1) g
    on g.chrom = c.chrom and c.start < g.stop and g.start < c.stop
  ) u where rn = 1
) b on t.name = b.name"""


@query("B10_best_overlap_first", _best("asc", False))
def _(v):
    return iv.best_overlap(
        v("catalog"), v("regions").where("region_id % 3 = 1"), key=["name"], order=["region_id"]
    ).select("name", "chrom", "b_start", "b_stop", "rate")


@query("B10_best_overlap_last", _best("desc", True))
def _(v):
    return iv.best_overlap(
        v("catalog"),
        v("regions").where("region_id % 3 = 1"),
        key=["name"],
        order=["region_id"],
        ties="last",
        fallback=True,
    ).select("name", "chrom", "b_start", "b_stop", "rate")


@query(
    "B11_overlap_rate",
    """
select region_id, greatest(least(stop, 5000) - greatest(start, 200), 0) / cast(stop - start as double) as rate
from regions""",
)
def _(v):
    rate = iv.overlap_rate(F.lit(200), F.lit(5000), "start", "stop")
    return v("regions").select("region_id", rate.alias("rate"))


@query(
    "B12_sliding_windows",
    """
select region_id, chrom, start + k * 4 as win_start,
  case when k = n then stop else start + k * 4 + 10 end as win_stop
from (select *, unnest(range(0, n + 1)) as k from (
  select *, case when stop - start <= 10 then 0 else cast(floor((stop - start - 10) / 4.0) as bigint) end as n
  from regions where stop - start >= 5) t) u""",
)
def _(v):
    return iv.sliding_windows(v("regions"), 10, 4, 5).select(
        "region_id", "chrom", "win_start", "win_stop"
    )


@query(
    "B13_window_gc",
    """
select region_id, chrom, start, stop, case when length(replace(seq, 'N', '')) = 0 then 0.0 else
  round_even(length(regexp_replace(seq, '[^GC]', '', 'g')) / cast(length(replace(seq, 'N', '')) as double), 3)
  end as gc
from (select g.*, substr(txt, g.start + 1, g.stop - g.start) as seq
  from regions g join ref_text t on g.chrom = t.chrom) u""",
)
def _(v):
    return sequence.window_gc(
        v("regions").select("region_id", "chrom", "start", "stop"), v("ref_chunks"), 12
    )


@query(
    "B14_tile_mean",
    """
select sample, chrom, cast(floor(start / 1000.0) as bigint) as tile, round(avg(start), 6) as pos,
  round(avg(mean_depth), 6) as dp from bins group by 1, 2, 3""",
)
def _(v):
    rows = v("bins").withColumnsRenamed({"start": "pos", "mean_depth": "dp"})
    out = iv.tile_mean(rows, 1000, ["sample", "chrom"])
    return out.withColumn("pos", F.round("pos", 6)).withColumn("dp", F.round("dp", 6))


@query(
    "B15_gaps_between",
    """
select tx, exon_no, case when strand = '-' then nstop + 1 else stop + 1 end as start,
  case when strand = '-' then start - 1 else nstart - 1 end as stop
from (select *, lead(start) over (partition by tx order by exon_no) as nstart,
  lead(stop) over (partition by tx order by exon_no) as nstop from exons) t where nstart is not null""",
)
def _(v):
    return iv.gaps_between(v("exons"), ["tx"], "exon_no").select("tx", "exon_no", "start", "stop")


@query(
    "B16_callable_regions",
    """
select chrom, count(*) as n_bases, cast(sum(pos) as bigint) as sum_pos from (
  select chrom, unnest(range(0, length)) as pos from chrom_len) g
where not exists (select 1 from (
  select chrom, min(start) as start, max(stop) as stop from (
    select *, sum(f) over (partition by chrom order by start, stop rows unbounded preceding) as k from (
      select chrom, start, stop, case when start > coalesce(max(stop) over (partition by chrom order by start, stop
        rows between unbounded preceding and 1 preceding) + 1, -1) then 1 else 0 end as f
      from (select chrom, start, stop from catalog union all
            select chrom, start, stop from regions where region_id % 7 = 0) x) y) z group by chrom, k
  ) m where m.chrom = g.chrom and g.pos >= m.start and g.pos < m.stop)
group by chrom""",
)
def _(v):
    genome = v("chrom_len").select("chrom", F.lit(0).cast("long").alias("start"), F.col("length").alias("stop"))
    left = iv.callable_regions(genome, v("catalog"), v("regions").where("region_id % 7 = 0"))
    n = F.col("stop") - F.col("start")
    spread = ((F.col("start") + F.col("stop") - 1) * n / 2).cast("long")
    return left.groupBy("chrom").agg(F.sum(n).alias("n_bases"), F.sum(spread).alias("sum_pos"))


@query(
    "B17_nearest_phase_set",
    """
select distinct name, steps, ps from (
  select *, min(steps) over (partition by name) as best from (
    select c.name, p.ps,
      cast(ceil(greatest(c.start - p.pos, p.pos - c.stop, 0) / 100.0) as bigint) as steps
    from catalog c join phased p on c.chrom = p.chrom) t) u where steps = best""",
)
def _(v):
    return iv.nearest_phase_set(v("catalog"), v("phased"), 100, key=["name"])


@query(
    "B18_distance_rank",
    "select site_id, abs(pos - (4000 + 9001) / 2.0::double) as distance from phased where chrom = 'chr2'",
)
def _(v):
    hits = v("phased").where("chrom = 'chr2'")
    return iv.distance_rank(hits, F.lit(4000), F.lit(9001)).select("site_id", "distance")


@query(
    "B19_contig_order",
    """
select site_id, cast(case substr(chrom, 4) when 'X' then 23 when 'Y' then 24 else cast(
  case when substr(chrom, 4) in ('X', 'Y') then '0' else substr(chrom, 4) end as int) end as int) as rank
from sites""",
)
def _(v):
    return v("sites").select("site_id", iv.contig_order("chrom").alias("rank"))


@query(
    "B20_parse_region",
    """
select site_id, chrom, pos as start, case when site_id % 2 = 0 then pos else pos + 9 end as stop,
  case when site_id % 2 = 0 then ref end as ref, case when site_id % 2 = 0 then alt end as alt from sites""",
)
def _(v):
    text = F.when(
        F.col("site_id") % 2 == 0,
        F.concat_ws("-", F.expr("substring(chrom, 4)"), "pos", "ref", "alt"),
    ).otherwise(F.concat("chrom", F.lit(":"), "pos", F.lit("-"), F.col("pos") + 9))
    return v("sites").select("site_id", iv.parse_region(text).alias("r")).select("site_id", "r.*")


@query(
    "B21_mate_region_reads",
    """
with wanted as (
  select chrom, min(start) as start, max(stop) as stop from (
    select *, sum(f) over (partition by chrom order by start, stop rows unbounded preceding) as k from (
      select chrom, start, stop, case when start > coalesce(max(stop) over (partition by chrom order by start, stop
        rows between unbounded preceding and 1 preceding) + 5, -1) then 1 else 0 end as f from catalog where name % 3 = 0) y) z
  group by chrom, k),
spots as (
  select * from wanted union all
  select distinct m.mate_chrom, m.mate_start, m.mate_start + 1 from mates m where exists (
    select 1 from wanted w where w.chrom = m.chrom and m.start < w.stop and w.start < m.stop)),
final as (
  select chrom, min(start) as start, max(stop) as stop from (
    select *, sum(f) over (partition by chrom order by start, stop rows unbounded preceding) as k from (
      select chrom, start, stop, case when start > coalesce(max(stop) over (partition by chrom order by start, stop
        rows between unbounded preceding and 1 preceding) + 5, -1) then 1 else 0 end as f from spots) y) z
  group by chrom, k)
select chrom, start, stop, qname, ord from mates m where exists (
  select 1 from final w where w.chrom = m.chrom and m.start < w.stop and w.start < m.stop)""",
)
def _(v):
    return iv.mate_region_reads(v("mates"), v("catalog").where("name % 3 = 0"), 5).select(
        "chrom", "start", "stop", "qname", "ord"
    )


@query(
    "B22_assign_location",
    """
select site_id, case when pos < 3000 then 'upstream' when pos > 8001 then 'downstream' else 'internal' end
as location from sites""",
)
def _(v):
    return v("sites").select(
        "site_id", iv.assign_location("pos", F.lit(3000), F.lit(8001)).alias("location")
    )
