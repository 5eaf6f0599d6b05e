"""Pharmacogenomic queries (survey section 2.7, star alleles and truth)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.operators import pharmaco as px
from strandwise.operators.coverage import bedgraph
from strandwise.plans.genotype import calls
from strandwise.plans.registry import query


@query(
    "G19_site_lookup",
    """
select s.site_id, case when c.site_id is null then '.' else c.ref end as ref_calling,
  case when c.site_id is null then '.' else c.alt end as alt_calling, case when c.site_id is null then '.' else 'q' end as qd,
  case when c.site_id is null then '0/0' when c.site_id % 2 = 0 then '1/2' else c.gt end as gt, case when c.site_id is null then coalesce(d.depth, 0) else c.ad0 + c.ad1 end as dp,
  case when c.ad0 + c.ad1 > 0 then c.ad1 / cast(c.ad0 + c.ad1 as double) end as ratio
from sites s left join (select * from calls where sample = 'Father' and site_id % 3 <> 0) c on c.site_id = s.site_id
left join base_depth d on d.chrom = s.chrom and d.pos = s.pos - 1""",
)
def _(v):
    mine = calls(v).where("sample = 'Father' and site_id % 3 <> 0").withColumn("qd", F.lit("q"))
    # two records a site: the first of even sites, and the second of odd ones, is 1/2
    again = mine.withColumn("gt", F.lit("1/2"))
    mine = mine.withColumn("ord", (F.col("site_id") + 1) % 2).unionByName(again.withColumn("ord", F.col("site_id") % 2))
    catalog = v("sites").select("site_id", "chrom", "pos")
    depth = bedgraph(v("reads").select("chrom", "start", "stop"))
    return px.site_lookup(catalog, mine, depth).select(
        "site_id", "ref_calling", "alt_calling", "qd", "gt", "dp", "ratio"
    )


_PGX = """
select *, case gt when '0/0' then concat(drug_ref, '/', drug_ref) when '0/1' then concat(ref_calling, '/', alt_calling)
    when '1/1' then concat(alt_calling, '/', alt_calling) else concat(split_part(alt_calling, ',', 1), '/', split_part(alt_calling, ',', 2)) end as genotype,
  case when dp < depth_threshold then 'Fail'
    when gt = '0/0' then concat(drug_ref, '/', drug_ref)
    when corrected = 'no' then case gt when '0/1' then concat(ref_calling, '/', alt_calling)
      when '1/1' then concat(alt_calling, '/', alt_calling) else concat(split_part(alt_calling, ',', 1), '/', split_part(alt_calling, ',', 2)) end
    when gt = '0/1' then case when ratio > het_hom_ratio_threshold then concat(alt_calling, '/', alt_calling)
      when ratio < ref_het_ratio_threshold then concat({low}, '/', {low}) else concat(ref_calling, '/', alt_calling) end
    when gt = '1/1' then case when ratio <= het_hom_ratio_threshold then concat(ref_calling, '/', alt_calling)
      else concat(alt_calling, '/', alt_calling) end
    when 1 - ratio > het_hom_ratio_threshold then concat(split_part(alt_calling, ',', 1), '/', split_part(alt_calling, ',', 1))
    when ratio > het_hom_ratio_threshold then concat(split_part(alt_calling, ',', 2), '/', split_part(alt_calling, ',', 2))
    else concat(split_part(alt_calling, ',', 1), '/', split_part(alt_calling, ',', 2)) end as genotype_corrected
from pgx"""
_RAW = _PGX.format(low="ref_calling")


@query("G20_pgx_genotype", f"select site_id, sample, genotype, genotype_corrected from ({_RAW}) t")
def _(v):
    return px.pgx_genotype(v("pgx")).select("site_id", "sample", "genotype", "genotype_corrected")


# the neighbour of a site is the same person's next site, moved to two bases on
@query(
    "G21_merge_adjacent_pair",
    f"""
with g as (select *, case when gt = '0/0' then drug_ref else ref_calling end as r, case when gt = '0/0' then drug_ref else alt_calling end as a,
  split_part(genotype, '/', 1) as g1, split_part(genotype, '/', 2) as g2, split_part(genotype_corrected, '/', 1) as k1,
  split_part(genotype_corrected, '/', 2) as k2 from ({_RAW}) t),
p as (select x.site_id, x.sample, x.gt as xg, y.gt as yg, x.r, x.a, x.g1, x.g2, x.k1, x.k2, x.genotype_corrected as xk,
  y.r as yr, y.a as ya, y.g1 as y1, y.g2 as y2, y.k1 as m1, y.k2 as m2, y.genotype_corrected as yk, x.qd as xq, y.qd as yq
  from g x join g y on y.sample = x.sample and y.chrom = x.chrom and y.pos = x.pos + 35)
select site_id, sample, ref_calling, alt_calling, concat(ref_calling, '/', alt_calling) as genotype, concat(xq, ',', yq) as qd,
  case when xk = 'Fail' or yk = 'Fail' then 'Fail' when xg = '0/0' and yg = '0/0' then xk
    when xg = '0/0' then concat(left(r, 2), m1, '/', left(a, 2), m2)
    when yg = '0/0' then concat(k1, right(yr, 1), '/', k2, right(yr, 1)) else concat(k1, m1, '/', k2, m2) end as genotype_corrected
from (select *, case when xg = '0/0' and yg = '0/0' then r when xg = '0/0' then concat(left(r, 2), y1)
    when yg = '0/0' then concat(r, right(yr, 1)) else concat(g1, y1) end as ref_calling,
  case when xg = '0/0' and yg = '0/0' then a when xg = '0/0' then concat(left(a, 2), y2)
    when yg = '0/0' then concat(a, right(ya, 1)) else concat(g2, y2) end as alt_calling from p) t""",
)
def _(v):
    site = px.pgx_genotype(v("pgx"))
    near = site.withColumn("pos", F.col("pos") - 33)
    return px.merge_adjacent_pair(site, near, 2, ["sample", "chrom"]).select(
        "site_id", "sample", "ref_calling", "alt_calling", "genotype", "qd", "genotype_corrected"
    )


def _star_text(z: str) -> str:
    return f"""case {z} when 'ref' then concat(rb, '/', rb)
    when 'het' then case kind when 'del' then concat(rb, '/del', rt) when 'ins' then concat('del/ins', alt_t) else concat(ref_calling, '/', alt_calling) end
    else case kind when 'del' then concat('del', rt, '/del', rt) when 'ins' then concat('ins', alt_t, '/ins', alt_t)
      else concat(alt_calling, '/', alt_calling) end end"""


_STAR = f"""
select *, case when dp < depth_threshold then './.' when gt = '1/2' then concat(
      case when corrected = 'yes' and w = 2 then p2 else p1 end, '/', case when corrected = 'yes' and w = 1 then p1 else p2 end)
    when corrected = 'yes' then {_star_text('fixed')} else {_star_text('raw')} end as star_allele,
  case when dp < depth_threshold then gt when gt = '1/2' and w > 0 then '1/1' when raw = fixed then gt
    when fixed = 'hom' then '1/1' when fixed = 'ref' then '0/0' when fixed = 'het' then '0/1' else gt end as gt_corrected
from (select *, concat('r', drug_ref) as rb, substr(ref_calling, 2) as rt, substr(alt_calling, 2) as alt_t,
  case when length(ref_calling) > 1 and length(alt_calling) = 1 then 'del' when length(ref_calling) = 1 and length(alt_calling) > 1 then 'ins' else 'other' end as kind,
  case gt when '0/0' then 'ref' when '0/1' then 'het' when '1/1' then 'hom' else 'two' end as raw,
  case gt when '0/0' then 'ref' when '0/1' then case when ratio > het_hom_ratio_threshold then 'hom'
    when ratio < ref_het_ratio_threshold then 'ref' else 'het' end
    when '1/1' then case when ratio <= het_hom_ratio_threshold then 'het' else 'hom' end else 'two' end as fixed,
  case when gt <> '1/2' then 0 when 1 - ratio > het_hom_ratio_threshold then 1 when ratio > het_hom_ratio_threshold then 2 else 0 end as w,
  case when length(ref_calling) > 1 and (length(a1) = 1 or length(a2) = 1) then concat('del', substr(ref_calling, length(a1) + 1))
    when length(ref_calling) = 1 and (length(a1) > 1 or length(a2) > 1) then concat('ins', substr(a1, 2)) else a1 end as p1,
  case when length(ref_calling) > 1 and (length(a1) = 1 or length(a2) = 1) then concat('del', substr(ref_calling, length(a2) + 1))
    when length(ref_calling) = 1 and (length(a1) > 1 or length(a2) > 1) then concat('ins', substr(a2, 2)) else a2 end as p2
  from (select *, split_part(alt_calling, ',', 1) as a1, split_part(alt_calling, ',', 2) as a2 from ({_PGX.format(low="drug_ref")}) q) s) t"""


@query(
    "G22_star_site_genotype",
    f"select site_id, sample, genotype, genotype_corrected, gt_corrected, star_allele from ({_STAR}) x",
)
def _(v):
    site = v("pgx").withColumn("ref_allele", F.concat(F.lit("r"), "drug_ref"))
    return px.star_site_genotype(site).select(
        "site_id", "sample", "genotype", "genotype_corrected", "gt_corrected", "star_allele"
    )


# star alleles of the test data: a few sites of a customer define one
_MAP = """
select concat('*', cast(cust as varchar), '.', cast(site_id % 7 as varchar)) as star, cust * 7 + site_id % 7 as ordinal, site_id as place, site_id as position,
  case when site_id % 4 = 0 then case ref when 'A' then 'R' when 'G' then 'R' else 'Y' end
    when site_id % 4 = 1 then ref else left(alt, 1) end as allele from sites"""


def _star_map(v):
    code = F.when(F.col("ref").isin("A", "G"), "R").otherwise("Y")
    allele = F.when(F.col("site_id") % 4 == 0, code).when(F.col("site_id") % 4 == 1, F.col("ref")).otherwise(
        F.substring("alt", 1, 1)
    )
    part = F.col("site_id") % 7
    return v("sites").select(
        F.concat(F.lit("*"), "cust", F.lit("."), part).alias("star"), (F.col("cust") * 7 + part).alias("ordinal"), F.col("site_id").alias("place"),
        F.col("site_id").alias("position"), allele.alias("allele"),
    )


def _star_sites(v):
    pair = F.when(F.col("gt") == "0/0", F.concat_ws("/", "ref", "ref")).when(
        F.col("gt") == "0/1", F.concat_ws("/", "ref", "alt")
    ).when(F.col("gt") == "1/1", F.concat_ws("/", "alt", "alt")).otherwise("./.")
    return v("calls").select("sample", F.col("site_id").alias("position"), pair.alias("star_allele"))


_MATCH = f"""
with sm as ({_MAP.strip()}),
st as (select sample, site_id as position, case gt when '0/0' then ref when '0/1' then ref when '1/1' then alt else '.' end as a,
  case gt when '0/0' then ref when '0/1' then alt when '1/1' then alt else '.' end as b from calls),
h as (select st.sample, sm.star, sm.ordinal, case sm.allele when 'R' then a in ('A', 'G') when 'Y' then a in ('C', 'T') else a = sm.allele end as x,
  case sm.allele when 'R' then b in ('A', 'G') when 'Y' then b in ('C', 'T') else b = sm.allele end as y from st join sm on sm.position = st.position),
c as (select sample, star, min(ordinal) as o, count(*) filter (where x or y) as n1, count(*) filter (where x and y) as n2 from h group by 1, 2),
n as (select star, count(*) as need from sm group by 1),
l as (select sample, string_agg(case when n2 = need then concat(c.star, '/', c.star) else c.star end, '/' order by o) as star
  from c join n on n.star = c.star where n1 = need group by 1)"""


@query("G23_star_match", f"{_MATCH.strip()} select sample, star from l")
def _(v):
    return px.star_match(_star_sites(v), _star_map(v))


@query(
    "G23_star_site_matches",
    f"""{_MATCH.strip()} select sample, star, count(*) filter (where x and y) as yy, count(*) filter (where x and not y) as yn,
  count(*) filter (where y and not x) as ny from h group by 1, 2""",
)
def _(v):
    rows = px.star_site_matches(_star_sites(v), _star_map(v))
    return rows.groupBy("sample", "star").agg(
        *[F.sum((F.col("matched") == m).cast("int")).alias(n) for m, n in (("yes/yes", "yy"), ("yes/no", "yn"), ("no/yes", "ny"))]
    )


@query(
    "G24_star_with_copy",
    """
select site_id, case site_id % 4 when 0 then '*5/*5' when 1 then array_to_string(list_sort(list_distinct([concat('*', cast(cust % 7 as varchar)),
  concat('*', cast(cust % 3 as varchar)), '*5'])), '/') else concat('*', cast(cust % 7 as varchar), '/*', cast(cust % 3 as varchar)) end as star_fixed
from sites""",
)
def _(v):
    star = F.concat(F.lit("*"), F.col("cust") % 7, F.lit("/*"), F.col("cust") % 3)
    rows = v("sites").select("site_id", star.alias("star"), (F.col("site_id") % 4).alias("cyp2d6"))
    return rows.select("site_id", px.star_with_copy("star", "cyp2d6").alias("star_fixed"))


@query(
    "G25_star_map_stats",
    f"""
select star, string_agg(cast(position as varchar), '|' order by place) as specific_variant, cast(count(*) as int) as specific_variant_count,
  coalesce(string_agg(cast(position as varchar), '|' order by place) filter (where allele in ('R', 'Y')), '') as degenerate_variant,
  cast(count(*) filter (where allele in ('R', 'Y')) as int) as degenerate_variant_count from ({_MAP}) m group by star""",
)
def _(v):
    return px.star_map_stats(_star_map(v))


@query(
    "G26_indel_classifier",
    """
select site_id, sample, case site_id % 3 when 0 then 'D/D' when 1 then 'I/D' else 'I/I' end as known,
  case site_id % 3 when 0 then 'D/D' when 1 then 'I/D' else 'I/I' end as genotype from calls where gt <> './.'""",
)
def _(v):
    kind = F.col("site_id") % 3
    noise = (F.col("ad0") % 7) / 100
    level = F.when(kind == 0, 0.05).when(kind == 1, 0.45).otherwise(0.9)
    rows = v("calls").where("gt <> './.'").select(
        "site_id", "sample", (level + noise).alias("snp_ratio"), (level / 2 + noise).alias("depth_ratio"),
        (0.9 - level + noise).alias("split_reads_ratio"),
        F.when(kind == 0, "D/D").when(kind == 1, "I/D").otherwise("I/I").alias("known"),
    )
    model, _accuracy = px.indel_classifier_fit(rows, rounds=_STUMP_ROUNDS)
    return px.indel_classifier_predict(model, rows).select("site_id", "sample", "known", "genotype")


_NOISY = """
select site_id % 10 as fold, round(ad1 / cast(ad0 + ad1 as double), 3) as snp_ratio, ((site_id * 37 + ad0 * 11) % 97) / cast(97 as double)
+ case gt when '0/0' then 0.3 when '0/1' then 0.1 else 0.0 end as depth_ratio, ((site_id * 53 + ad1) % 89) / cast(89 as double) as split_reads_ratio,
case when (site_id * 13 + pos) % 11 = 0 then 'I/D' when gt = '0/0' then 'D/D' when gt = '0/1' then 'I/D' else 'I/I' end as known
from calls where gt <> './.'"""
_STUMP_ROUNDS = 3


def _boosted_sql() -> str:
    """The rounds one by one for the model of all rows (m = 0) and the ten without a fold each."""

    def logs(side: str) -> list[str]:
        return [f"ln(greatest({side}{k} / cast({side} as double), 2.220446049250313e-16))" for k in range(3)]

    def gain(side: str, k: int) -> str:
        x = logs(side)
        others = " + ".join(x[j] for j in range(3) if j != k)
        return f"(-2.0 / 3 * ({x[k]} - ({others}) / 2))"

    def vote(side: str, k: int) -> str:
        x = logs(side)
        return f"(2 * ({x[k]} - ({x[0]} + {x[1]} + {x[2]}) / 3))"

    one = "4503599627370496.0::double"
    steps = [
        f"t as ({_NOISY})",
        """g as (select m, fold, snp_ratio as x0, depth_ratio as x1, split_reads_ratio as x2,
  case known when 'D/D' then 0 when 'I/D' then 1 else 2 end as y, count(*) as n from t, range(0, 11) r(m) group by all)""",
        "w0 as (select *, 0.0::double as lw, 0.0::double as v0, 0.0::double as v1, 0.0::double as v2 from g)",
        f"z0 as (select m, ln(sum(n) filter (where fold <> m - 1) / {one}) as shift from g group by m)",
    ]
    squares = [" + ".join(f"pow({s}{k} / {one}, 2)" for k in range(3)) for s in "lr"]
    for i in range(_STUMP_ROUNDS):
        o = i + 1
        steps += [
            f"""q{o} as (select w.*, case when fold = w.m - 1 then 0 else round_even(n * exp(lw - shift), 0)::bigint end as w
  from w{i} w join z{i} z on z.m = w.m)""",
            f"h{o} as ("
            + " union all ".join(
                f"select m, {f} as f, x{f} as v, " + ", ".join(f"coalesce(sum(w) filter (where y = {k}), 0) as c{k}" for k in range(3))
                + f" from q{o} group by m, x{f}"
                for f in range(3)
            )
            + ")",
            f"a{o} as (select m, f, v, lead(v) over (partition by m, f order by v) as nx, "
            + ", ".join(f"sum(c{k}) over (partition by m, f order by v) as l{k}, sum(c{k}) over (partition by m, f) as t{k}" for k in range(3))
            + f" from h{o})",
            f"""d{o} as (select m, f, coalesce(v + (nx - v) / 2, 'infinity'::double) as t, l0, l1, l2, t0 - l0 as r0, t1 - l1 as r1, t2 - l2 as r2,
  l0 + l1 + l2 as l, t0 + t1 + t2 - l0 - l1 - l2 as r from a{o})""",
            f"""b{o} as (select * from (select *, row_number() over (partition by m order by score desc, f, t) as k from (
  select *, round(case when l > 0 then ({squares[0]}) / (l / {one}) else 0 end + case when r > 0 then ({squares[1]}) / (r / {one}) else 0 end, 10) as score
  from d{o}) s) k where k = 1)""",
        ]
        side = "case b.f when 0 then x0 when 1 then x1 else x2 end <= b.t"

        def pick(what) -> str:
            both = [" ".join(f"when {k} then {what(s, k)}" for k in range(3)) for s in "lr"]
            return f"case when {side} then case y {both[0]} end else case y {both[1]} end end"

        votes = ", ".join(f"v{k} + case when {side} then {vote('l', k)} else {vote('r', k)} end as v{k}" for k in range(3))
        moved = " + ".join(f"{s}{k} * exp({gain(s, k)})" for s in "lr" for k in range(3))
        steps += [
            f"w{o} as (select w.m, fold, x0, x1, x2, y, n, lw + {pick(gain)} as lw, {votes} from w{i} w join b{o} b on b.m = w.m)",
            f"z{o} as (select z.m, shift + ln(({moved}) / {one}) as shift from z{i} z join b{o} b on b.m = z.m)",
        ]
    return "with " + ",\n".join(steps)


_STUMP_SQL = _boosted_sql()


def _noisy(v):
    gt, known = F.col("gt"), F.col("site_id")
    share = F.col("ad1") / (F.col("ad0") + F.col("ad1")).cast("double")
    shift = F.when(gt == "0/0", 0.3).when(gt == "0/1", 0.1).otherwise(0.0)
    flipped = (known * 13 + F.col("pos")) % 11 == 0
    return v("calls").where("gt <> './.'").select(
        (known % 10).alias("fold"),
        F.round(share, 3).alias("snp_ratio"),
        (((known * 37 + F.col("ad0") * 11) % 97) / F.lit(97.0) + shift).alias("depth_ratio"),
        (((known * 53 + F.col("ad1")) % 89) / F.lit(89.0)).alias("split_reads_ratio"),
        F.when(flipped, "I/D").when(gt == "0/0", "D/D").when(gt == "0/1", "I/D").otherwise("I/I").alias("known"),
    )


@query(
    "G26_boosted_stumps",
    _STUMP_SQL + "".join(
        f"""{" union all" if i else ""}
select {i + 1}::bigint as round, f::bigint as feature, t as threshold, {", ".join(f"round({s}{k} / {s}, 6) as {n}_{k}" for s, n in (("l", "left"), ("r", "right")) for k in range(3))}
from b{i + 1} where m = 0"""
        for i in range(_STUMP_ROUNDS)
    ),
)
def _(v):
    rows = _noisy(v)
    model, _least = px.indel_classifier_fit(rows, folds=0, rounds=_STUMP_ROUNDS)
    shown = [
        (i + 1, s.feature, s.threshold, *[round(p, 6) for p in [*s.left, *s.right]]) for i, s in enumerate(model.stumps)
    ]
    names = ", ".join(f"{n}_{k} double" for n in ("left", "right") for k in range(3))
    return rows.sparkSession.createDataFrame(shown, f"round bigint, feature bigint, threshold double, {names}")


@query(
    "G26_fold_accuracy",
    _STUMP_SQL + f"""
select fold, sum(n) filter (where y = case when round(v0, 9) >= round(v1, 9) and round(v0, 9) >= round(v2, 9) then 0 when round(v1, 9) >= round(v2, 9) then 1 else 2 end)
  / cast(sum(n) as double) as accuracy from w{_STUMP_ROUNDS} where fold = m - 1 group by fold""",
)
def _(v):
    rows = _noisy(v)
    model, _least = px.indel_classifier_fit(rows, folds=10, rounds=_STUMP_ROUNDS, fold=F.col("fold"))
    return rows.sparkSession.createDataFrame(list(model.accuracy.items()), "fold bigint, accuracy double")


_CALLED = """
select sample, site_id as id, ref, alt, case gt when '0/0' then concat(ref, '/', ref) when '0/1' then concat(ref, '/', alt)
  else concat(alt, '/', alt) end as genotype from calls where gt <> './.'"""
_KNOWN = """
select sample, site_id as id, case when site_id % 6 = 0 then '-' when site_id % 6 < 3 then concat(alt, ref)
  when site_id % 6 = 3 then concat(ref, ref) else concat(alt, alt) end as known from calls where site_id % 5 <> 0"""


def _called(v):
    g = F.when(F.col("gt") == "0/0", F.concat_ws("/", "ref", "ref")).when(
        F.col("gt") == "0/1", F.concat_ws("/", "ref", "alt")
    ).otherwise(F.concat_ws("/", "alt", "alt"))
    return v("calls").where("gt <> './.'").select("sample", F.col("site_id").alias("id"), "ref", "alt", g.alias("genotype"))


def _known(v):
    k = F.col("site_id") % 6
    text = F.when(k == 0, "-").when(k < 3, F.concat("alt", "ref")).when(k == 3, F.concat("ref", "ref")).otherwise(F.concat("alt", "alt"))
    return v("calls").where("site_id % 5 <> 0").select("sample", F.col("site_id").alias("id"), text.alias("known"))


@query(
    "G27_genotype_consistency",
    f"""
select c.sample, c.id, genotype, coalesce(known, '-') as known, case when known is null or known = '-' then '-'
    when known = concat(ref, ref) then 'ref' when known = concat(alt, alt) then 'hom' else 'het' end as known_gt,
  case when known is null then '-' when known = replace(genotype, '/', '') or known = concat(split_part(genotype, '/', 2), split_part(genotype, '/', 1))
    then 'yes' when known = '-' then '-' else 'no' end as consistence
from ({_CALLED}) c left join ({_KNOWN}) k on k.sample = c.sample and k.id = c.id""",
)
def _(v):
    return px.genotype_consistency(_called(v), _known(v)).drop("ref", "alt")


@query(
    "G28_indel_consistency",
    f"""
select sample, id, case replace(genotype, '/', '') when concat(ref, ref) then 'D/D' when concat(ref, alt) then 'I/D' else 'I/I' end as ace,
  case sample when 'Father' then 'I/D' when 'Mother' then 'D/D' else '-' end as known from ({_CALLED}) c""",
)
def _(v):
    known = v("calls").where("sample in ('Father', 'Mother')").select("sample").distinct()
    known = known.withColumn("known", F.when(F.col("sample") == "Father", "I/D").otherwise("D/D"))
    return px.indel_consistency(_called(v), known).select("sample", "id", "ace", "known")


@query(
    "G29_collect_tool_genotypes",
    """
select cust as "sampleID", case when count(*) filter (where site_id % 3 = 0) = 0 then '-' else
  min(concat('*', ref, '/*', alt)) filter (where site_id % 3 = 0) end as "CYP2D6" from sites group by cust""",
)
def _(v):
    path = F.concat(F.lit("/r/"), "cust")
    text = F.when(
        F.col("site_id") % 3 == 0, F.concat(F.lit("#Solution 1: *"), "ref", F.lit("/*"), "alt")
    ).otherwise(F.concat(F.lit("Note\t"), "site_id"))
    lines = v("sites").select(path.alias("path"), text.alias("value"))
    info = v("sites").select(F.col("cust").alias("sampleID"), path.alias("result")).distinct()
    return px.collect_solutions(lines, info)


@query(
    "G29_collect_hla",
    """
select distinct cust as "sampleID", concat('HLA-', ref) as "Gene", alt as "Allele1", concat(ref, alt) as "Allele2" from sites
where site_id % 4 <> 0""",
)
def _(v):
    path = F.concat(F.lit("/h/"), "cust")
    text = F.when(F.col("site_id") % 4 == 0, "Couldn't read result file.").otherwise(
        F.concat_ws("\t", F.concat(F.lit("HLA-"), "ref"), F.col("alt"), F.concat("ref", "alt"), F.lit("x"))
    )
    lines = v("sites").select(path.alias("path"), text.alias("value"))
    info = v("sites").select(F.col("cust").alias("sampleID"), path.alias("result")).distinct()
    return px.collect_hla(lines, info)
