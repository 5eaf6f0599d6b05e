"""Copy-number queries (survey section 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import copynumber as cn
from strandwise.plans.registry import query

_RATIO = """
select b.*, case when gender = 'M' and chrom = 'chrX' then 2 else 1 end * mean_depth / m as ratio
from bins b join (select sample as s, sum(base) / sum(size) as m from bins group by sample) t on b.sample = t.s"""


def ratios(v):
    return cn.normalize_depth(v("bins"))


@query("E1_normalize_depth", f"select sample, chrom, start, ratio from ({_RATIO}) r")
def _(v):
    return ratios(v).select("sample", "chrom", "start", "ratio")


def _lowess(extra: str) -> str:
    """Textbook robust LOWESS in SQL: row-level weights, three bisquare passes."""
    steps = [
        f"""r as ({_RATIO}),
u as (select sample, round_even(gc, 3) as gc, ratio as y, chrom, start from r
  where mean_depth > 10 and size > 20 and gc > 0.2 and gc < 0.8 {extra}),
e as (select sample, quantile_cont(y, 0.05) as lo, quantile_cont(y, 0.95) as hi from u group by sample),
f as (select u.* from u join e on u.sample = e.sample and y > lo and y < hi),
w0 as (select *, 1.0::double as rw from f),
nn as (select sample, gc, count(*) as n from f group by all),
kk as (select sample, cast(floor(sum(n) * 2 / 3.0::double + 1e-10) as bigint) as k from nn group by sample),
dd as (select a.sample, a.gc as g0, b.gc as g1, abs(a.gc - b.gc) as d, b.n from nn a join nn b on a.sample = b.sample),
cc as (select *, sum(n) over (partition by sample, g0 order by d range unbounded preceding) as c from dd),
hh as (select cc.sample, g0, min(d) as h from cc join kk on cc.sample = kk.sample where c >= k group by all),
tt as (select dd.sample, dd.g0, dd.g1, case when h > 0 then pow(greatest(0, 1 - pow(d / h, 3)), 3) else
  case when d = 0 then 1.0 else 0.0 end end as t from dd join hh on dd.sample = hh.sample and dd.g0 = hh.g0)"""
    ]
    for i in range(4):
        steps.append(
            f"""s{i} as (select sample, gc, sum(rw) as a, sum(rw * y) as b from w{i} group by all),
m{i} as (select tt.sample, g0, sum(t * a) as sw, sum(t * a * g1) / sum(t * a) as mx, sum(t * b) / sum(t * a) as my
  from tt join s{i} s on s.sample = tt.sample and s.gc = g1 group by all),
l{i} as (select tt.sample, tt.g0 as gc, max(my) + case when sum(t * a * pow(g1 - mx, 2)) > 1e-12
    then sum(t * b * (g1 - mx)) / sum(t * a * pow(g1 - mx, 2)) else 0 end * (tt.g0 - max(mx)) as fit
  from tt join s{i} s on s.sample = tt.sample and s.gc = g1 join m{i} m on m.sample = tt.sample and m.g0 = tt.g0 group by tt.sample, tt.g0)"""
        )
        if i < 3:
            steps.append(
                f"""a{i} as (select f.*, abs(y - fit) as a from f join l{i} l on f.sample = l.sample and f.gc = l.gc),
d{i} as (select sample, median(a) as mad from a{i} group by sample),
w{i + 1} as (select sample, gc, y, case when a < 6 * mad then pow(1 - pow(a / (6 * mad), 2), 2) else 0 end as rw
  from a{i} join d{i} using (sample))"""
            )
    return "with " + ",\n".join(steps) + f""",
g as (select sample, gc, (select fit from l3 where l3.sample = x.sample and l3.gc >= x.gc order by l3.gc limit 1) as up,
  (select fit from l3 where l3.sample = x.sample and l3.gc <= x.gc order by l3.gc desc limit 1) as down
  from (select distinct sample, round_even(gc, 3) as gc from r) x)
select r.sample, r.chrom, r.start, coalesce(up, down, 1.0) as lowess, ratio / coalesce(up, down, 1.0) as ratio_gc_fix
from r join g on r.sample = g.sample and round_even(r.gc, 3) = g.gc"""


@query("E2_gc_correct", _lowess("and ratio > 0.1 and ratio < 5"))
def gc_correct(v):
    return cn.gc_correct(ratios(v)).select("sample", "chrom", "start", "lowess", "ratio_gc_fix")


@query("E2_gc_correct_exons", _lowess(""))
def _(v):
    return cn.gc_correct(ratios(v), "exons").select("sample", "chrom", "start", "lowess", "ratio_gc_fix")


def _as_fixed(v):
    return ratios(v).withColumnRenamed("ratio", "ratio_gc_fix")


_BATCH = f"""
select b.*, case when m = 0 then 1 else m end as ratio_control, b.ratio / case when m = 0 then 1 else m end as ratio_batch_fix
from ({_RATIO}) b join (select chrom, start, median(ratio) as m from ({_RATIO}) x group by 1, 2) t
on b.chrom = t.chrom and b.start = t.start"""


@query("E3_batch_correct", f"select sample, chrom, start, ratio_control, ratio_batch_fix from ({_BATCH}) t")
def batch_correct(v):
    return cn.batch_correct(_as_fixed(v)).select("sample", "chrom", "start", "ratio_control", "ratio_batch_fix")


@query(
    "E3_batch_correct_sex",
    f"""
select sample, chrom, start, ratio / case when m = 0 then 1 else m end as ratio_batch_fix from (
  select b.*, case when n.k >= 10 then t.m else a.m end as m
  from ({_RATIO}) b join (select chrom, start, gender, median(ratio) as m from ({_RATIO}) x group by 1, 2, 3) t
  on b.chrom = t.chrom and b.start = t.start and b.gender = t.gender
  join (select chrom, start, median(ratio) as m from ({_RATIO}) y group by 1, 2) a on b.chrom = a.chrom and b.start = a.start
  join (select gender, count(distinct sample) as k from bins group by gender) n on n.gender = b.gender) z""",
)
def _(v):
    return cn.batch_correct(_as_fixed(v), sex_matched=True).select("sample", "chrom", "start", "ratio_batch_fix")


@query(
    "E3_batch_correct_spread",
    f"select sample, chrom, start, ratio_batch_fix from ({_BATCH}) t",
)
def _(v):
    from strandwise.functions.quantiles import exact_quantiles

    rows = _as_fixed(v)
    line = exact_quantiles(rows, ["chrom", "start"], "ratio_gc_fix", {"m": 0.5})
    fixed = F.col("ratio_gc_fix") / F.when(F.col("m") == 0, 1.0).otherwise(F.col("m"))
    return rows.join(line, ["chrom", "start"]).select("sample", "chrom", "start", fixed.alias("ratio_batch_fix"))


@query("E3_cohort_state", f"select sample, chrom, start, ratio_control, ratio_batch_fix from ({_BATCH}) t")
def _(v):
    """Two batches of samples merge into a stored state; the medians are read from it."""
    from strandwise.functions.stages import new_folder
    from strandwise.operators.cohort import add_batch, correct_by_cohort

    rows = _as_fixed(v)
    path = new_folder(rows.sparkSession)
    first = F.col("sample") < "S15"
    add_batch(rows.where(~first), path, "later")
    add_batch(rows.where(first), path, "earlier")
    return correct_by_cohort(rows, path).select("sample", "chrom", "start", "ratio_control", "ratio_batch_fix")


@query("E4_clamp_log2", f"select sample, chrom, start, log2(greatest(0.0625, least(16, ratio_batch_fix))) as log2ratio from ({_BATCH}) t")
def _(v):
    rows = cn.batch_correct(_as_fixed(v))
    return rows.select("sample", "chrom", "start", cn.clamp_log2("ratio_batch_fix").alias("log2ratio"))


@query(
    "E5_cv_windows",
    f"""
select sample, round_even(stddev_samp(x) / avg(x), 3) as cv from (select sample,
  case when ratio_batch_fix > 0.3 and ratio_batch_fix < 4 then ratio_batch_fix end as x from ({_BATCH}) t) u group by sample""",
)
def _(v):
    return cn.cv(cn.batch_correct(_as_fixed(v)))


@query(
    "E5_cv_exons",
    """
select sample, case when count(*) filter (where x > 0.75) = 0 then stddev_samp(x) / avg(x)
  when count(*) filter (where x > 0.75 and x < 1.3) / cast(count(*) filter (where x > 0.75) as double) >= 0.95
  then stddev_samp(x) filter (where x > 0.75 and x < 1.3) / avg(x) filter (where x > 0.75 and x < 1.3)
  else stddev_samp(x) filter (where x > 0.75) / avg(x) filter (where x > 0.75) end as cv
from (select sample, ratio_batch_fix as x from exon_calls) t group by sample""",
)
def _(v):
    return cn.cv(v("exon_calls"), variant="exons")


# every series gains 1 from 5,000 to 12,000, on a small deterministic noise
_STEPS = """
select sample, chrom, start, cast((start / 100 * 7919) % 101 as double) / 1000 + case when start >= 5000 and start < 12000 then 1 else 0 end as x from bins"""


def _steps(v):
    inside = (F.col("start") >= 5000) & (F.col("start") < 12000)
    noise = ((F.col("start") / 100 * 7919) % 101).cast("double") / 1000
    return v("bins").select("sample", "chrom", "start", (noise + F.when(inside, 1.0).otherwise(0.0)).alias("x"))


@query(
    "E6_segment",
    f"""
select sample, chrom, min(start) as start, max(start) as last_start, count(*) as num_mark, round(avg(x), 6) as seg_mean
from (select *, case when start < 5000 then 0 when start < 12000 then 1 else 2 end as part from ({_STEPS}) s) t group by sample, chrom, part""",
)
def _(v):
    found = cn.segment(_steps(v), "x")
    # a mean of 32 marks may end in a 5 at the seventh place; the twelfth drops what the order of summing adds
    return found.select("sample", "chrom", "start", "last_start", "num_mark", F.round(F.round("seg_mean", 12), 6).alias("seg_mean"))


# depth with a small term that no two bins share, so that no two arcs are equal
_ROUGH = """
select sample, chrom, start, x, row_number() over (partition by sample, chrom order by start) as j from (
  select sample, chrom, start, mean_depth + cast((start / 100 * 7919) % 1009 as double) / 10007 as x from bins) t"""


@query(
    "E6_best_arc",
    f"""
with r as ({_ROUGH}),
m as (select sample, chrom, avg(x) as mean, count(*) as n from r group by 1, 2),
b as (select r.sample, r.chrom, j, n, sum(x - mean) over (partition by r.sample, r.chrom order by j) as b from r
    join m on m.sample = r.sample and m.chrom = r.chrom
  union all select sample, chrom, 0, n, 0 from m),
z as (select a.sample, a.chrom, a.n, a.j as j1, c.j as j2, pow(c.b - a.b, 2) * a.n / cast((c.j - a.j) * (a.n - (c.j - a.j)) as double) as stat
  from b a join b c on c.sample = a.sample and c.chrom = a.chrom and c.j < c.n and c.j - a.j >= 2 and a.n - (c.j - a.j) >= 2)
select sample, chrom, n, max(round(stat, 5)) as stat, arg_max(j1, stat) as j1, arg_max(j2, stat) as j2 from z group by 1, 2, 3""",
)
def _(v):
    from strandwise.functions.running import running
    from strandwise.operators.arcs import best_arcs

    noise = ((F.col("start") / 100 * 7919) % 1009).cast("double") / 10007
    rows = v("bins").select("sample", "chrom", "start", (F.col("mean_depth") + noise).alias("x"))
    facts = rows.groupBy("sample", "chrom").agg(F.avg("x").alias("mean"), F.count(F.lit(1)).alias("n"), F.var_pop("x").alias("var"))
    rows = running(rows.join(facts, ["sample", "chrom"]), ["sample", "chrom"], "start", sums={"j": F.lit(1), "b": F.col("x") - F.col("mean")})
    placed = rows.select("sample", "chrom", "x", "j", "b", "n", (F.col("var") * F.col("n")).alias("tss"))
    found = best_arcs(placed, ["sample", "chrom"], "x", "j", 2, 0.01, permuted=64, block=16)
    return found.select("sample", "chrom", "n", F.round("stat", 5).alias("stat"), "j1", "j2")


@query(
    "E6_smooth_outliers",
    f"""
with s as (select sample, chrom, start, case when start % 1700 = 0 then 9 when start % 1900 = 0 then -7 else x end as x from ({_STEPS}) a),
d as (select *, x - lag(x) over (partition by sample, chrom order by start) as step from s),
n as (select sample, chrom, sqrt(avg(step * step) / 2) as sd from d group by 1, 2),
w as (select s.*, sd, max(x) over (partition by s.sample, s.chrom order by start rows between 5 preceding and 1 preceding) as a,
  max(x) over (partition by s.sample, s.chrom order by start rows between 1 following and 5 following) as b,
  min(x) over (partition by s.sample, s.chrom order by start rows between 5 preceding and 1 preceding) as c,
  min(x) over (partition by s.sample, s.chrom order by start rows between 1 following and 5 following) as e,
  median(x) over (partition by s.sample, s.chrom order by start rows between 5 preceding and 5 following) as mid
  from s join n on n.sample = s.sample and n.chrom = s.chrom)
select sample, chrom, start, round(case when x > greatest(a, b) + 2 * sd then mid + sd when x < least(c, e) - 2 * sd then mid - sd else x end, 6) as x from w""",
)
def _(v):
    start = F.col("start")
    spiked = _steps(v).withColumn("x", F.when(start % 1700 == 0, 9.0).when(start % 1900 == 0, -7.0).otherwise(F.col("x")))
    smooth = cn.smooth_outliers(spiked, "x", region=5, outlier=2.0, shrink=1.0, block=16)
    return smooth.select("sample", "chrom", "start", F.round("x", 6).alias("x"))


@query(
    "E7_spread_segments",
    """
select sample, chrom, start, seg_mean, pow(2, seg_mean) as copy_ratio from (
  select sample, chrom, start, last_value(case when start % 1300 = 0 then ln(mean_depth) end ignore nulls)
    over (partition by sample, chrom order by start) as seg_mean from bins) t""",
)
def _(v):
    segs = v("bins").where("start % 1300 = 0").select("sample", "chrom", "start", F.log("mean_depth").alias("seg_mean"))
    return cn.spread_segments(v("bins"), segs).select("sample", "chrom", "start", "seg_mean", "copy_ratio")


_CALL = """
select *, case when gender = 'M' and chrom = 'chrX' then case when x > 1.5 then 2 when x <= 0.3 then 0 else 1 end
    when x < 0.2 then 0 when x <= 0.75 then 1 when x > 1.3 then 3 else 2 end as copy_num,
  case when gender = 'M' and chrom = 'chrX' then case when x > 1.5 then 'DUP' when x <= 0.3 then 'DEL' else 'NORMAL' end
    when x <= 0.75 then 'DEL' when x > 1.3 then 'DUP' else 'NORMAL' end as type
from (select *, gene as chrom, ratio_batch_fix as x from exon_calls) t0"""


def exon_calls(v):
    return cn.call_copy_number(v("exon_calls").withColumn("chrom", F.col("gene")), "ratio_batch_fix")


@query("E8_call_copy_number", f"select sample, gene, number, copy_num, type from ({_CALL}) t")
def _(v):
    return exon_calls(v).select("sample", "gene", "number", "copy_num", "type")


_W = "over (partition by sample, gene order by number)"
_E9 = f"""
select *, type in ('DEL', 'DUP') and (coalesce(lag(type) {_W} = type, false) or coalesce(lead(type) {_W} = type, false)) as c1
from ({_CALL}) t1"""
_E10 = f"""
select *, case when br then pt else type end as t2,
  c1 or br or coalesce(lag(br) {_W}, false) or coalesce(lead(br) {_W}, false) as c2
from (select *, lag(type) {_W} as pt, coalesce(type = 'NORMAL' and lag(type) {_W} = lead(type) {_W}
    and lag(type) {_W} in ('DEL', 'DUP') and case when gender = 'M' then abs(x - 0.3) < 0.1 or abs(x - 1.5) < 0.1
    else abs(x - 0.75) < 0.1 or abs(x - 1.3) < 0.1 end, false) as br from ({_E9}) t2) t3"""
# noisy test data: the cv gate is opened by a fixed cv per sample
_E11 = f"""
select *, case when rec then 'DUP' else t2 end as t3, c2 or rec or (t2 = 'DUP' and quiet and
  (coalesce(lead(el) {_W}, false) or (coalesce(lag(el) {_W}, false) and coalesce(lag(lt) {_W} <> 'DUP', true)))) as c3
from (select *, el and (coalesce(lt = 'DUP', false) or coalesce(rt = 'DUP', false)) as rec from (
  select *, last_value(case when not el then t2 end ignore nulls) over (partition by sample, gene order by number
      rows between unbounded preceding and 1 preceding) as lt,
    first_value(case when not el then t2 end ignore nulls) over (partition by sample, gene order by number
      rows between 1 following and unbounded following) as rt
  from (select *, quiet and t2 = 'NORMAL' and abs(1.3 - x) < 0.05 as el from (
    select *, gender <> 'M' and sample <> 'S3' as quiet from ({_E10}) t4) t5) t6) t7) t8"""
_E12 = f"""
select *, case when weak then 'NORMAL' else t3 end as t4, case when weak then 2 else copy_num end as n4 from (
  select *, not c3 and not (chrom = 'chrX' and gender = 'M') and ((t3 = 'DEL' and x > 0.65) or (t3 = 'DUP' and x < 1.4)) as weak
  from ({_E11}) t9) t10"""


def _with_cv(df):
    return df.withColumn("cv", F.when(F.col("sample") == "S3", 0.2).otherwise(0.05))


@query("E9_flag_runs", f"select sample, gene, number, case when c1 then 'Yes' else 'No' end as continuously from ({_E9}) t")
def _(v):
    return cn.flag_runs(exon_calls(v)).select("sample", "gene", "number", "continuously")


@query("E10_bridge_gaps", f"select sample, gene, number, t2 as type, case when c2 then 'Yes' else 'No' end as continuously from ({_E10}) t")
def _(v):
    return cn.bridge_gaps(cn.flag_runs(exon_calls(v))).select("sample", "gene", "number", "type", "continuously")


@query("E11_recall_near_threshold", f"select sample, gene, number, t3 as type, case when c3 then 'Yes' else 'No' end as continuously from ({_E11}) t")
def _(v):
    df = cn.bridge_gaps(cn.flag_runs(_with_cv(exon_calls(v))))
    return cn.recall_near_threshold(df).select("sample", "gene", "number", "type", "continuously")


@query("E12_drop_weak_singletons", f"""
select sample, gene, number, case when w then 'NORMAL' else type end as type, case when w then 2 else copy_num end as copy_num
from (select *, not c1 and not (chrom = 'chrX' and gender = 'M') and ((type = 'DEL' and x > 0.65) or (type = 'DUP' and x < 1.4)) as w
  from ({_E9}) t) u""")
def _(v):
    return cn.drop_weak_singletons(cn.flag_runs(exon_calls(v))).select("sample", "gene", "number", "type", "copy_num")


@query("E13_repair_calls", f"select sample, gene, number, t4 as type, n4 as copy_num, case when c3 then 'Yes' else 'No' end as continuously from ({_E12}) t")
def _(v):
    return cn.repair_calls(_with_cv(exon_calls(v))).select("sample", "gene", "number", "type", "copy_num", "continuously")


_SAMPLES = [f"S{i}" for i in range(8)]
_PROFILE = """
select s.sample, s.chrom, s.pos + 1 as pos, round_even(coalesce(d.n, 0) / cast(m.mean_depth as double), 3) as ratio
from (select chrom, unnest(range(start, stop)) as pos, unnest(['S0', 'S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7']) as sample from catalog where false
  union all select chrom, pos, sample from (select chrom, unnest(range(start, stop)) as pos from catalog) a,
    (select unnest(['S0', 'S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7']) as sample) b) s
left join (select sample, chrom, pos, count(*) as n from per_base group by 1, 2, 3) d
  on d.sample = s.sample and d.chrom = s.chrom and d.pos = s.pos
join (select sample, count(*) / 5000.0::double as mean_depth from reads group by sample) m on m.sample = s.sample"""


def _profile(v):
    means = v("reads").groupBy("sample").agg((F.count(F.lit(1)) / F.lit(5000.0)).alias("mean_depth"))
    return cn.gene_depth_profile(v("reads"), v("catalog"), means, _SAMPLES)


@query("E14_gene_depth_profile", _PROFILE)
def _(v):
    return _profile(v)


@query(
    "E14_median_fix",
    f"""
with p as ({_PROFILE}) select p.sample, p.chrom, p.pos, round_even(ratio / nullif(m, 0), 3) as ratio_fix
from p join (select chrom, pos, median(ratio) as m from p group by 1, 2) t on t.chrom = p.chrom and t.pos = p.pos""",
)
def _(v):
    return cn.median_fix(_profile(v)).select("sample", "chrom", "pos", "ratio_fix")


@query(
    "E15_region_copy_ratio",
    f"""
with p as (select x.sample, x.ratio from ({_PROFILE}) x join regions g on g.chrom = x.chrom and x.pos between g.start and g.stop),
q as (select sample, median(ratio) as m, quantile_cont(ratio, 0.25) as a, quantile_cont(ratio, 0.75) as b from p group by sample)
select q.sample, round_even(m, 3) as median, (select round_even(avg(ratio), 3) from p where p.sample = q.sample and ratio between a and b)
  as kmeans from q""",
)
def _(v):
    return cn.region_copy_ratio(_profile(v), v("regions"))


@query(
    "E16_ratio_to_bins",
    """
select sample, gene, number, case when x < 0.2 then 0 when x < 0.566 then 1 when x < 1.25 then 2 when x < 1.75 then 3
  when x < 2.25 then 4 when x < 2.75 then 5 else 6 end as copies from (select *, ratio_batch_fix as x from exon_calls) t""",
)
def _(v):
    return v("exon_calls").select("sample", "gene", "number", cn.ratio_to_bins("ratio_batch_fix").alias("copies"))
