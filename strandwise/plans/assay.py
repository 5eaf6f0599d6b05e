"""Truth comparison and assay queries (survey section 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import assay as ay
from strandwise.operators.smoothing import local_fit, smoothing_r2
from strandwise.plans.registry import query

_CALLED = "select chrom, pos, ref, alt, var_type from sites where site_id % 7 <> 1"
_CONCORD = f"""
with conf as (select distinct chrom, unnest(range(start, stop)) as b from regions where region_id % 3 <> 0),
tgt as (select distinct chrom, unnest(range(start - 20, stop + 60)) as b from regions),
ok as (select * from conf intersect select * from tgt),
c as (select s.* from ({_CALLED}) s join ok on ok.chrom = s.chrom and ok.b = s.pos - 1),
t as (select s.* from truth s join ok on ok.chrom = s.chrom and ok.b = s.pos - 1)
select case when var_type = 'snp' then 'SNP' else 'INDEL' end as type, count(*) filter (where a and b) as "TP",
  count(*) filter (where a and not b) as "FP", count(*) filter (where b and not a) as "FN"
from (select coalesce(c.var_type, t.var_type) as var_type, c.pos is not null as a, t.pos is not null as b
  from c full join t on c.chrom = t.chrom and c.pos = t.pos and c.ref = t.ref and c.alt = t.alt) x group by 1"""


def concordance(v):
    called = v("sites").where("site_id % 7 <> 1")
    wide = v("regions").withColumn("start", F.col("start") - 20).withColumn("stop", F.col("stop") + 60)
    return ay.concordance(called, v("truth"), v("regions").where("region_id % 3 <> 0"), wide)


query("J1_concordance", _CONCORD)(concordance)


@query(
    "J2_accuracy_stats",
    """
with c as (select case when var_type = 'snp' then 'SNP' else 'INDEL' end as type, count(*) filter (where site_id % 3 <> 0 and site_id % 7 <> 1) as tp,
  count(*) filter (where site_id % 3 = 0 and site_id % 7 <> 1) as fp, count(*) filter (where site_id % 3 <> 0 and site_id % 7 = 1) as fn from sites group by 1),
o as (select sum(tp) as tp, sum(fp) as fp, sum(fn) as fn, sum(tp) filter (where type = 'SNP') as ts, sum(fp) filter (where type = 'SNP') as fs,
  (select sum(stop - start) from regions) as n from c)
select 'S' as sample_id, tp / cast(tp + fn as double) as sensitivity, (n - tp - fn - fp) / cast(n - tp - fn as double) as specificity,
  (tp + n - tp - fn - fp) / cast(n as double) as accuracy, cast(ts as bigint) as tp_snp, cast(tp - ts as bigint) as tp_indel,
  (n - tp - fn - fp - fs) / cast(n - tp - fn - fp as double) as specificity_snp from o""",
)
def _(v):
    s = F.col("site_id")
    called, true = s % 7 != 1, s % 3 != 0
    kind = F.when(F.col("var_type") == "snp", "SNP").otherwise("INDEL")
    counts = v("sites").groupBy(kind.alias("type")).agg(
        F.sum((called & true).cast("long")).alias("TP"), F.sum((called & ~true).cast("long")).alias("FP"),
        F.sum((~called & true).cast("long")).alias("FN"),
    )
    return ay.accuracy_stats(counts, v("regions"), "S").select(
        "sample_id", "sensitivity", "specificity", "accuracy", "tp_snp", "tp_indel", "specificity_snp"
    )


_CHI = """
select row_id, mut, wild, mut_c, wild_c, sum(pow(greatest(0, abs(o - e) - 0.5), 2) / e) as chi from (
  select c.*, x.o, x.e from counts2x2 c, lateral (select unnest([
    {'o': mut, 'e': (mut + wild) * (mut + mut_c) / cast(mut + wild + mut_c + wild_c as double)},
    {'o': wild, 'e': (mut + wild) * (wild + wild_c) / cast(mut + wild + mut_c + wild_c as double)},
    {'o': mut_c, 'e': (mut_c + wild_c) * (mut + mut_c) / cast(mut + wild + mut_c + wild_c as double)},
    {'o': wild_c, 'e': (mut_c + wild_c) * (wild + wild_c) / cast(mut + wild + mut_c + wild_c as double)}]) as s) u,
  lateral (select u.s.o as o, u.s.e as e) x) t group by all"""
# 1 - erf by its all-positive series
_P = f"""
select row_id, mut, wild, 1 - 2 / sqrt(pi()) * sum(case when z > 0 then exp(n * ln(2.0) + (2 * n + 1) * ln(z) - z * z
  - ((n + 1) * ln(2.0) + lgamma(n + 1.5) - 0.5 * ln(pi()))) else 0 end) as p
from (select *, sqrt(chi / 2) as z from ({_CHI}) c) d cross join (select unnest(range(0, 300)) as n) r group by row_id, mut, wild"""


@query("J3_two_by_two_chi_square", f"select row_id, chi from ({_CHI}) t")
def _(v):
    return v("counts2x2").select("row_id", ay.chi_square("mut", "wild", "mut_c", "wild_c").alias("chi"))


@query("J3_two_by_two_p", f"select row_id, round(p, 6) as p from ({_P}) t")
def _(v):
    return v("counts2x2").select("row_id", F.round(ay.two_by_two_p("mut", "wild", "mut_c", "wild_c"), 6).alias("p"))


_GRID = 1_000_000
_BF = f"""
select mut, total, num / (den + 2) as bf from (
  select mut, total, sum(exp(c + 3 * ln(p) + 99 * ln(1 - p) + mut * ln(1 + p) + (total - mut) * ln(1 - p))) / {_GRID} as num,
    sum(exp(c + 3 * ln(p) + 99 * ln(1 - p) + mut * ln(1 - p) + (total - mut) * ln(1 + p))) / {_GRID} as den
  from (select distinct mut, mut + wild as total from counts2x2) k cross join (
    select i / {_GRID}.0::double as p, lgamma(104) - lgamma(4) - lgamma(100) as c from (select unnest(range(1, {_GRID})) as i) a) g
  group by mut, total) t"""


@query("J4_bayes_factor", f"select row_id, round_even(bf, 3) as bf from counts2x2 c join ({_BF}) b on b.mut = c.mut and b.total = c.mut + c.wild")
def _(v):
    rows = v("counts2x2").withColumn("total", F.col("mut") + F.col("wild"))
    return ay.bayes_factor(rows, "mut", "total").select("row_id", "bf")


@query(
    "J5_droplet_genotype",
    f"""
select row_id, case when p < 0.05 then case when theta > 0.52 then 'Homozygous genotype (conclusive)' when theta < 0.48 then 'Wildtype genotype (conclusive)'
    when total >= 1000 then case when bf >= 1 then 'Homozygous genotype (conclusive)' else 'Probably wildtype genotype (θ<50%) or retest (θ>=50%)' end
    else 'Possibly wildtype genotype (θ<50%) or homozygous (θ>50%) genotype' end
  else case when theta > 0.52 then case when total >= 1000 then case when bf >= 1 then 'Homozygous genotype (conclusive)' else 'Retest' end
      else 'Probably homozygous genotype' end
    when theta < 0.48 then 'Wildtype or heterozygous genotype (conclusive)'
    when total >= 1000 then case when bf >= 1 then 'Probably homozygous genotype' else 'Possibly heterozygous genotype' end
    else 'Inconclusive' end end as genotype
from (select q.row_id, p, q.mut + q.wild as total, q.mut / cast(q.mut + q.wild as double) as theta, round_even(bf, 3) as bf
  from ({_P}) q join ({_BF}) b on b.mut = q.mut and b.total = q.mut + q.wild) t""",
)
def _(v):
    return ay.droplet_genotype(v("counts2x2")).select("row_id", "genotype")


_PEAKS = """
select sample, cast(floor((a + z) / 2.0) as bigint) as pos, height from (
  select sample, min(pos) as a, max(pos) as z, min(intensity) as height, lag(min(intensity)) over (partition by sample order by min(pos)) as l,
    lead(min(intensity)) over (partition by sample order by min(pos)) as r from (
    select *, sum(case when intensity = p then 0 else 1 end) over (partition by sample order by pos) as g from (
      select *, lag(intensity) over (partition by sample order by pos) as p from signal) x) y group by sample, g) t
where l < height and r < height and height >= 40"""
_LADDER = _PEAKS


def _ladder(v):
    return ay.call_peaks(v("signal"), 40, 1)


_SIZES = [50, 75, 100, 139, 150, 160, 200, 250]
_FIT = f"""
select sample, regr_slope(size, pos) as slope, regr_intercept(size, pos) as intercept, round_even(regr_r2(size, pos), 4) as r_square_sizing
from (select *, [50, 75, 100, 139, 150, 160, 200, 250][8 - k + 1]::double as size from (
  select sample, pos::double as pos, row_number() over (partition by sample order by pos desc) as k from ({_LADDER}) l) t where k <= 8) u group by sample"""


@query("J6_size_calibration", f"select sample, round(slope, 9) as slope, round(intercept, 6) as intercept, r_square_sizing from ({_FIT}) t")
def _(v):
    out = ay.size_calibration(_ladder(v), _SIZES)
    return out.select("sample", F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"), "r_square_sizing")


_PROBES = [("Ref_1", 20, -4, 4), ("Ref_2", 60, -20, 15), ("T_1", 90, -12, 20), ("T_2", 160, -30, 30), ("T_3", 900, -1, 1)]
_PROBE_ROWS = ", ".join(f"({i}, '{n}', {s}, {a}, {b})" for i, (n, s, a, b) in enumerate(_PROBES))
# sizes of the test peaks from a rule over the signal table
_FOUND = f"""
select g.sample, g.probe, g.psize::double as probe_size, coalesce(size, 0) as size, coalesce(pos, 0) as pos, coalesce(height, 0) as height
from (select sample, probe, psize from (select distinct sample from signal) s cross join (values {_PROBE_ROWS}) as p(i, probe, psize, lo, hi)) g
left join (select * from (select *, row_number() over (partition by sample, probe order by height desc, pos) as rk from (
  select *, row_number() over (partition by sample, pos order by abs(size - psize), i) as rn from (
    select sample, pos::double as pos, intensity as height, (pos % 211)::double as size from signal) k
    cross join (values {_PROBE_ROWS}) as p(i, probe, psize, lo, hi)) n where rn = 1 and size - psize > lo and size - psize < hi) m where rk = 1) b
on b.sample = g.sample and b.probe = g.probe"""


def _assigned(v):
    peaks = v("signal").select("sample", "pos", F.col("intensity").alias("height"), (F.col("pos") % 211).cast("double").alias("size"))
    return ay.assign_probe(peaks, _PROBES)


@query("J7_assign_probe", _FOUND)
def _(v):
    return _assigned(v)




@query("J8_call_peaks", _PEAKS)
def _(v):
    return _ladder(v)


_TOPS = f"select sample, pos, height, row_number() over (partition by sample order by height desc, pos desc) as k from ({_PEAKS}) p"


def _walk(name, source, distance):
    """The sequential rule: from the highest down, a peak stays when none that stays is near."""
    return f"""{name}o as (select *, row_number() over (partition by sample order by height desc, pos desc) as o from {source}),
{name} as (
  select sample, pos, height, o, [pos] as kept from {name}o where o = 1
  union all
  select n.sample, n.pos, n.height, n.o, case when len(list_filter(w.kept, lambda x: abs(x - n.pos) < {distance})) = 0
    then list_append(w.kept, n.pos) else w.kept end from {name} w join {name}o n on n.sample = w.sample and n.o = w.o + 1)"""


_THINNED = f"""
with recursive tops as ({_TOPS}),
{_walk("wa", "tops", 25)},
firsts as (select sample, pos, height, row_number() over (partition by sample order by height desc, pos desc) as r from wa
  where list_contains(kept, pos)),
lim as (select sample, height + 1 as least from firsts where r = 9),
again as (select t.sample, t.pos, t.height from tops t join lim on lim.sample = t.sample and t.height >= least),
{_walk("wb", "again", 25)}
select sample, pos, height from firsts where sample not in (select sample from lim)
union all select sample, pos, height from wb where list_contains(kept, pos)"""


@query("J8_call_peaks_thinned", _THINNED)
def _(v):
    return ay.call_peaks(v("signal"), 40, 25, max_peaks=8)


_SIDE = """
select p.sample, p.pos, p.height, coalesce(max(s.pos) filter (where s.pos < p.pos and s.intensity > p.height), -1) as l,
  coalesce(min(s.pos) filter (where s.pos > p.pos and s.intensity > p.height), 1000000000000) as r
from ({peaks}) p join signal s on s.sample = p.sample group by 1, 2, 3"""
_SHAPE = f"""
with b as ({_SIDE.format(peaks=_PEAKS)}),
m as (select b.sample, b.pos, b.height, min({{'v': s.intensity, 'd': b.pos - s.pos}}) filter (where s.pos <= b.pos) as a, min({{'v': s.intensity, 'd': s.pos - b.pos}}) filter (where s.pos >= b.pos) as z
  from b join signal s on s.sample = b.sample and s.pos > l and s.pos < r group by 1, 2, 3),
e as (select sample, pos, height, height - greatest(a.v, z.v) as prominence, pos - a.d as left_base, pos + z.d as right_base from m),
h as (select *, height - prominence * 0.5::double as level from e),
c as (select h.*, (select max(pos) from signal s where s.sample = h.sample and s.pos < h.pos and s.intensity <= level) as i,
    (select min(pos) from signal s where s.sample = h.sample and s.pos > h.pos and s.intensity <= level) as j from h),
w as (select c.*, case when a.intensity < level then (level - a.intensity) / (a2.intensity - a.intensity) else 0 end + i as left_ip,
    j - case when z.intensity < level then (level - z.intensity) / (z2.intensity - z.intensity) else 0 end as right_ip
  from c join signal a on a.sample = c.sample and a.pos = i join signal a2 on a2.sample = c.sample and a2.pos = i + 1
  join signal z on z.sample = c.sample and z.pos = j join signal z2 on z2.sample = c.sample and z2.pos = j - 1)"""


@query("J8_peak_shape", _SHAPE + """
select sample, pos, height, round(prominence, 6) as prominence, left_base, right_base, round(right_ip - left_ip, 6) as width,
  round(left_ip, 6) as left_ip, round(right_ip, 6) as right_ip from w""")
def _(v):
    shaped = ay.peak_shape(_ladder(v), v("signal"))
    return shaped.select("sample", "pos", "height", "left_base", "right_base", *[F.round(c, 6).alias(c) for c in ("prominence", "width", "left_ip", "right_ip")])


@query("J8_call_peaks_by_shape", _SHAPE + """
select sample, pos, height from w where right_ip - left_ip <= 3 and prominence / height >= 0.58""")
def _(v):
    return ay.call_peaks(v("signal"), 40, 1, max_width=3, min_prominence_share=0.58)


_DQ = """
with r as (select sample, probe, height from heights where probe like 'Ref%'),
x as (select a.sample, a.probe, a.is_ref, h.sample as h, (a.height / ra.height) / (h.height / rh.height) as v
  from heights a join heights h on h.probe = a.probe and h.is_ref and h.sample <> a.sample
  join r ra on ra.sample = a.sample and ra.probe <> a.probe join r rh on rh.sample = h.sample and rh.probe = ra.probe),
m as (select sample, probe, is_ref, h, median(v) as dq from x group by all),
d as (select x.sample, x.probe, x.is_ref, x.h, any_value(m.dq) as dq, median(abs(v - m.dq)) as mad from x join m on m.sample = x.sample and m.probe = x.probe and m.h = x.h group by all),
p as (select sample, probe, is_ref, avg(dq) as dq, avg(mad) as mad, var_pop(dq) as va from d group by all),
q as (select sample, probe, is_ref, dq, round_even(dq - 1.96 * sqrt(pow(1.4826 * mad, 2) + va * va), 4) as low,
  round_even(dq + 1.96 * sqrt(pow(1.4826 * mad, 2) + va * va), 4) as up from p),
iv as (select probe, round_even(avg(dq) - 1.96 * var_pop(dq), 4) as low, round_even(avg(dq) + 1.96 * var_pop(dq), 4) as up from q where is_ref group by probe)"""


@query("J9_dosage_quotient", _DQ + """ select sample, probe, round(dq, 6) as "DQ", low, up from q""")
def dosage(v):
    return ay.dosage_quotient(v("heights"))[0].select("sample", "probe", F.round("DQ", 6).alias("DQ"), "low", "up")


@query("J9_reference_interval", _DQ + " select * from iv")
def _(v):
    return ay.dosage_quotient(v("heights"))[1]


@query(
    "J10_probe_copy_call",
    _DQ + """,
s as (select sample, count(*) filter (where dq < 0.7 or dq > 1.3) as a,
  count(*) filter (where low > 1.3 or up < 0.7 or (low < 0.7 and up > 0.7) or (low < 1.3 and up > 1.3)) as b,
  count(*) filter (where up <> low and greatest(least(up, 1.3) - greatest(low, 0.7), 0) / nullif(up - low, 0) >= 0.6) as c from q where probe like 'Ref%' group by sample),
z as (select sample, concat_ws(';', case when (select bool_or(low < 0.7 or up > 1.3) from iv) and sample <> 'S7' then 'ref_sample_fail' end,
  case when a >= 2 or (b >= 8 and c <= 5) or (a >= 1 and c <= 6) then 'ref_probe_fail' end) as qc from s)
select q.sample, q.probe, case when qc <> '' then '.' when dq >= 1.3 then '>2' when dq > 0.8 then '2' when dq >= 0.65 then '1.5' when dq > 0.35 then '1'
  when dq >= 0.2 then '0.5' else '0' end as copies, case when qc = '' then 'pass' else qc end as qc
from q join z on z.sample = q.sample where q.probe not like 'Ref%'""".replace(" and sample <> 'S7'", ""),
)
def _(v):
    dq, interval = ay.dosage_quotient(v("heights"))
    return ay.probe_copy_call(dq, interval).select("sample", "probe", "copies", "qc")


@query(
    "J11_peak_qc",
    f"""
with f as ({_FOUND}),
l as (select sample, round_even(regr_r2(size, probe_size), 4) as r_square_detect from f where size <> 0 group by sample),
n as (select sample, count(*) filter (where size = 0 and probe like 'Ref%') as a, count(*) filter (where size = 0 and probe not like 'Ref%') as b from f group by sample),
k as (select * from ({_FIT}) t where sample <> 'S1.0')
select s.sample, r_square_sizing, r_square_detect, case when q = '' then 'pass' else q end as "QC" from (
  select n.sample, r_square_sizing, r_square_detect, concat_ws(';', case when r_square_sizing is null then 'standard_detect_fail' end,
    case when r_square_sizing < 0.997 then 'standard_fit_sizing_fail' end,
    case when r_square_sizing is not null and (a > 0 or b > 3) then 'probe_detect_fail' end,
    case when r_square_sizing is not null and r_square_detect < 0.997 then 'probe_fit_sizing_fail' end) as q
  from n left join k on k.sample = n.sample left join l on l.sample = n.sample) s""",
)
def _(v):
    sizing = ay.size_calibration(_ladder(v), _SIZES).where("sample <> 'S1.0'").select("sample", "r_square_sizing")
    return ay.peak_qc(_assigned(v), sizing, v("signal"))


@query("J12_ladder_by_slope")
def _(v):
    return ay.ladder_by_slope(_ladder(v), _SIZES, [0.2] * len(_SIZES), min_found=5)


@query(
    "J13_interpolate_size",
    f"""
with l as (select sample, pos, ((9 - k) * 25)::double as size from (
  select sample, pos, row_number() over (partition by sample order by pos desc) as k from ({_LADDER}) a) b where k <= 8),
n as (select s.sample, s.pos, l.pos as x, l.size as y, row_number() over (partition by s.sample, s.pos order by abs(l.pos - s.pos), l.pos) as k
  from (select s.* from signal s join (select sample, min(pos) as p0 from l group by sample) f on f.sample = s.sample and s.pos >= f.p0) s
  join l on l.sample = s.sample)
select sample, pos, round_even((y2 - y1) / cast(x2 - x1 as double) * (pos - x1) + y1, 1) as size from (
  select sample, pos, max(x) filter (where k = 1) as x1, max(y) filter (where k = 1) as y1, max(x) filter (where k = 2) as x2,
    max(y) filter (where k = 2) as y2 from n where k <= 2 group by 1, 2) t""",
)
def _(v):
    from pyspark.sql import Window

    # the last eight peaks are the eight sizes, as in the calibration
    number = F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("pos")))
    ladder = _ladder(v).withColumn("k", number).where("k <= 8").select("sample", "pos", ((9 - F.col("k")) * 25).cast("double").alias("size"))
    return ay.interpolate_size(v("signal").select("sample", "pos"), ladder)


def _local(rows: str, passes: int) -> str:
    """Robust local regression in SQL over rows (g, x, y) without ties in x, a tenth of the rows each."""
    steps = [
        f"""r as ({rows}),
n as (select *, row_number() over (partition by g order by x) as i, count(*) over (partition by g) as n from r),
m as (select *, cast(greatest(floor(n * 0.1::double + 1e-10), 1) as bigint) as k from n),
s as (select b.g, b.i, b.x as lo, c.x as hi from m b join m c on c.g = b.g and c.i = b.i + b.k - 1),
h as (select a.g, a.i, a.x, a.k, min(greatest(a.x - s.lo, s.hi - a.x)) as h from m a join s on s.g = a.g and s.i between a.i - a.k + 1 and a.i group by 1, 2, 3, 4),
t as (select a.g, a.i, b.i as j, b.x - a.x as u, b.y, h, case when h > 0 then pow(1 - pow(abs(b.x - a.x) / h, 3), 3) else 1.0 end as t
  from h a join m b on b.g = a.g and b.i between a.i - a.k and a.i + a.k and (b.i = a.i or abs(b.x - a.x) < h)),
w0 as (select g, i, 1.0::double as w from m)"""
    ]
    for p in range(passes + 1):
        steps.append(f"""z{p} as (select t.g, t.i, max(h) as h, sum(t * w) as sw, sum(t * w * u) as sx, sum(t * w * u * u) as sxx, sum(t * w * y) as sy, sum(t * w * y * u) as sxy
  from t join w{p} w on w.g = t.g and w.i = t.j group by 1, 2),
f{p} as (select g, i, case when sw > 0 then sy / sw - case when sxx - sx * sx / sw > 1e-12 * h * h * sw then (sxy - sy * sx / sw) / (sxx - sx * sx / sw) else 0 end * sx / sw end as fit from z{p})""")
        if p < passes:
            steps.append(f"""a{p} as (select m.g, m.i, abs(y - fit) as a from m join f{p} f on f.g = m.g and f.i = m.i),
d{p} as (select g, median(a) as mad from a{p} group by g),
w{p + 1} as (select a.g, i, case when mad = 0 then case when a = 0 then 1.0 else 0.0 end when a < 6 * mad then pow(1 - pow(a / (6 * mad), 2), 2) else 0.0 end as w
  from a{p} a join d{p} d on d.g = a.g)""")
    return "with " + ",\n".join(steps) + f",\nlocal as (select m.g, m.x, m.y, f.fit from m join f{passes} f on f.g = m.g and f.i = m.i)"


@query(
    "J13_smoothing_r2",
    _local("select sample as g, pos::double as x, intensity as y from signal", 3) + """
select g as sample, case when var_pop(y) > 0 then round_even(1 - sum(pow(y - fit, 2)) / (var_pop(y) * count(*)), 4) end as r_square
from local where fit is not null group by g""",
)
def _(v):
    return smoothing_r2(v("signal"), ["sample"], "pos", "intensity", fraction=0.1)


@query(
    "J13_local_fit",
    _local("select chrom as g, pos::double as x, dp::double as y from phased", 1) + """
select g as chrom, cast(x as bigint) as pos, round(fit, 6) as fit from local""",
)
def _(v):
    fitted = local_fit(v("phased"), ["chrom"], "pos", "dp", fraction=0.1, passes=1)
    return fitted.select("chrom", "pos", F.round("fit", 6).alias("fit"))
