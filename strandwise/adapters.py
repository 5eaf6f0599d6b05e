"""Genomic views over the test tables: one SQL text for Spark and for DuckDB.

Every view is a plain projection, aggregation or window of the given parquet
tables, so the work of each registered query grows with them.  Intervals are
0-based half-open.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    "reads": """
select case l_suppkey % 5 when 3 then 'chrX' when 4 then 'chrY' else concat('chr',
cast(l_suppkey % 5 + 1 as string)) end as chrom, l_partkey*10 + l_linenumber as start,
l_partkey*10 + l_linenumber + cast(l_quantity as bigint) as stop, l_orderkey as qname,
l_linenumber as ord, l_returnflag = 'R' as is_dup, l_linestatus = 'F' as is_clipped, concat('S',
cast(l_orderkey % 8 as string)) as sample from lineitem""",
    "regions": """
select case p_partkey % 5 when 3 then 'chrX' when 4 then 'chrY' else concat('chr',
cast(p_partkey % 5 + 1 as string)) end as chrom, p_partkey*10 as start, cast(p_partkey*10 +
p_size as bigint) as stop, p_brand as gene, p_partkey as region_id, case when p_size % 2 = 0
then '+' else '-' end as strand from part""",
    "catalog": """
select chrom, start, start + 40 as stop, region_id as name from regions where region_id % 25 = 0""",
    "bins": """
select concat('S', cast(s as string)) as sample, case c when 3 then 'chrX' when 4 then 'chrY' else concat('chr',
cast(c + 1 as string)) end as chrom, b * 100 as start, b * 100 + 100 as stop, cast(100 as bigint) as size,
sum(l_quantity) * 20 as base, sum(l_quantity) / 5 as mean_depth, (20 + b % 61) / cast(100 as double) as gc,
case when s % 2 = 0 then 'M' else 'F' end as gender from (select l_suppkey % 20 as s, l_partkey % 5 as c,
cast(floor(l_partkey / 4.0) as bigint) as b, l_quantity from lineitem) t group by s, c, b""",
    "sites": """
select case o_orderkey % 5 when 3 then 'chrX' when 4 then 'chrY' else concat('chr',
cast(o_orderkey % 5 + 1 as string)) end as chrom, o_orderkey * 7 as pos, substring('ACGT',
cast(o_orderkey % 4 as int) + 1, 1) as ref, concat(substring('ACGT', cast((o_orderkey + 1 +
o_orderkey % 3) % 4 as int) + 1, 1), case when o_orderstatus = 'P' then 'A' else '' end) as alt,
case when o_orderpriority = '5-LOW' then 'LowQual' else 'PASS' end as filter, case when
o_orderstatus = 'P' then 'indel' else 'snp' end as var_type, o_orderkey as site_id, o_custkey as
cust from orders""",
    "roster": """
select s.chrom, s.pos, s.ref, s.alt, s.filter, s.var_type, s.site_id, s.cust,
explode(array('Father', 'Mother', 'Proband', 'Embryo1', 'Embryo2', 'Embryo3')) as sample from
sites s""",
    "calls0": """
select chrom, pos, ref, alt, filter, var_type, site_id, sample, explode(array(case (site_id * k
+ cust) % 7 when 0 then '0/0' when 1 then '0/1' when 2 then '1/1' when 3 then '0/0' when 4 then
'0/1' when 5 then '1/1' else './.' end)) as gt, (site_id * 3 + k * 11) % 17 as r from (select *,
case sample when 'Father' then 1 when 'Mother' then 2 when 'Proband' then 3 when 'Embryo1' then
4 when 'Embryo2' then 5 else 6 end as k from roster) t""",
    "calls": """
select chrom, pos, ref, alt, filter, var_type, site_id, sample, gt, case gt when '0/0' then 20 +
r when '0/1' then 5 + r when '1/1' then r % 2 else 0 end as ad0, case gt when '0/0' then r % 2
when '0/1' then 5 + (r * 5) % 13 when '1/1' then 20 + r else 0 end as ad1 from calls0""",
    "sparse_calls": """
select case when site_id % 997 = 0 then 'chrM' else chrom end as chrom, pos, ref, alt, filter, var_type,
site_id, sample, gt, ad0, ad1 from calls""",
    "phased": """
select chrom, pos, ref, alt, site_id, concat('P', cast(floor(pos / 5000.0) as bigint)) as ps,
case when site_id % 3 = 0 then '0|1' when site_id % 3 = 1 then '1|0' else '1|1' end as gt, 5 +
site_id % 30 as dp from sites where site_id % 11 <> 0""",
    "truth": """
select chrom, pos, ref, alt, var_type from sites where site_id % 3 <> 0""",
    "scores": """
select chrom, pos, ref, alt, (site_id % 1000) / cast(1000 as double) as ada, (site_id % 777) /
cast(777 as double) as rf from sites where var_type = 'snp' and site_id % 4 <> 0""",
    "exons": """
select chrom, start, stop, strand, gene, concat(gene, '.', cast(region_id % 3 as string)) as tx,
region_id as exon_no, case when region_id % 3 = 0 and region_id % 2 = 0 then 'Select' else '.'
end as tag from regions""",
    "exon_calls": """
select sample, chrom as gene, start / 100 as number, mean_depth / avg(mean_depth) over
(partition by sample) as ratio_batch_fix, gender from bins""",
    "counts2x2": """
select cast(l_suppkey as bigint) as row_id, cast(sum(case when l_returnflag = 'R' then 1 else 0
end) as bigint) as mut, cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as
wild, cast(sum(case when l_returnflag = 'N' and l_linestatus = 'F' then 1 else 0 end) as bigint)
as mut_c, cast(sum(case when l_returnflag = 'N' and l_linestatus = 'O' then 1 else 0 end) as
bigint) as wild_c from lineitem group by l_suppkey""",
    "signal": """
select concat('S', cast(g as string), '.', cast(cast(floor((n - 1) / 1000.0) as bigint) as string)) as sample,
cast((n - 1) % 1000 + 1 as bigint) as pos, value as intensity from (select cast(floor(user_id / 4.0) as bigint) as g,
value, row_number() over (partition by floor(user_id / 4.0) order by ts, event_id) as n from events) t""",
    "heights": """
select concat('S', cast(l_suppkey % 30 as string)) as sample, concat(case when l_partkey % 13 <
9 then 'Ref_' else 'T_' end, cast(l_partkey % 13 as string)) as probe, sum(l_extendedprice) as
height, l_suppkey % 30 < 6 as is_ref from lineitem group by l_suppkey % 30, l_partkey % 13""",
    "fq": """
select o_orderkey as rec, translate(lpad(cast(o_orderkey * 7919 as string), 12, '0'),
'0123456789', 'ACGTACGTAC') as seq1, translate(lpad(cast((o_orderkey * 104729) % 1000000 as
string), 10, '0'), '0123456789', 'ACGTACGTAC') as seq2 from orders""",
    "barcodes": """
select s_suppkey as ord, reverse(translate(translate(lpad(cast((s_suppkey * 104729) % 1000000 as
string), 10, '0'), '0123456789', 'ACGTACGTAC'), 'ACGT', 'TGCA')) as barcode from supplier""",
    "mates": """
select r.chrom, r.start, r.stop, r.qname, r.ord, m.mate_chrom, m.mate_start from reads r join
(select qname, min(chrom) as mate_chrom, min(start) as mate_start from reads group by qname) m on
r.qname = m.qname""",
    "chrom_len": """
select chrom, max(stop) + 30 as length from regions group by chrom""",
    "sam": """
select cast(l_orderkey as string) as qname, case when l_orderkey % 17 = 0 then 4 else 0 end + case
when l_partkey % 11 = 0 then 8 else 0 end + case when l_suppkey % 19 = 0 then 256 else 0 end + case
when l_returnflag = 'R' then 1024 else 0 end + case when l_linenumber = 7 then 2048 else 0 end as
flag, case l_suppkey % 5 when 3 then 'chrX' when 4 then 'chrY' else concat('chr', cast(l_suppkey % 5
+ 1 as string)) end as rname, l_partkey * 10 + l_linenumber as pos, 60 as mapq, case l_linenumber % 4
when 0 then concat(cast(len as string), 'M') when 1 then concat('3S', cast(len as string), 'M') when
2 then concat(cast(len as string), 'M2D4M') else concat(cast(len as string), 'M1I5M') end as cigar,
'=' as rnext, l_partkey * 10 + 200 as pnext, case when l_linenumber % 2 = 0 then l_partkey % 2500
else -(l_partkey % 2500) end as tlen, substring('ACGTTGCANCGGATCAACGTTGCANCGGATCAACGTTGCANCGGATCAACGTTGCANCGGATCA',
cast(l_orderkey % 4 as int) + 1, cast(len + case l_linenumber % 4 when 0 then 0 when 1 then 3 when 2
then 4 else 6 end as int)) as seq, substring('IIIIIII%III.IIIIIIIIIII%III.IIIIIIIIIII%III.IIIIIIIIIII%III.IIIIIIII',
cast(l_orderkey % 4 as int) + 1, cast(len + case l_linenumber % 4 when 0 then 0 when 1 then 3 when 2
then 4 else 6 end as int)) as qual, case when l_linenumber % 4 = 2 then concat(cast(len as string),
'^AC', case when l_orderkey % 3 = 0 then '1T2' else '4' end) else concat(cast(len as string), case
when l_orderkey % 3 = 0 then 'A0' else '' end) end as md, l_orderkey % 3 = 0 as md_sub, len, case
when l_linenumber % 4 = 1 then 3 else 0 end as clip from (select *, cast(l_quantity as bigint) as
len from lineitem) t""",
    "cover": """
select sample, chrom as chromosome, start, stop, size, cast(floor(base / 50) as bigint) as reads_uni,
cast(floor(base / 300) as bigint) as reads_dup, cast(base as bigint) as base_uni, cast(floor(base /
6) as bigint) as base_dup, least(size, cast(floor(base / 20) as bigint)) as c1, least(size,
cast(floor(base / 40) as bigint)) as c4, least(size, cast(floor(base / 80) as bigint)) as c10,
least(size, cast(floor(base / 160) as bigint)) as c20, concat('G', cast(cast(floor(start / 100.0) as
bigint) % 3 as string)) as gene, cast(floor(start / 100.0) as bigint) % 7 as n_size, gender from
bins where not (chrom = 'chrY' and cast(substring(sample, 2) as int) % 2 = 1)""",
    "fastp": """
select concat('S', cast(o_custkey % 20 as string)) as sample, cast(sum(cast(floor(o_totalprice) as
bigint)) as bigint) as total_reads, cast(sum(cast(floor(o_totalprice) as bigint)) * 100000 as bigint) as raw_bases,
max(o_orderkey % 97) / cast(97 as double) as q20, max(o_orderkey % 89) / cast(97 as double) as q30
from orders where o_custkey % 20 < 18 group by o_custkey % 20""",
    "targets": """
select concat('T_', chrom) as gene, chrom, lo - 1 as start_extend, hi - 200 as end_extend,
cast(floor(lo + (hi - lo) / 3.0) as bigint) as start, cast(floor(lo + (hi - lo) / 2.0) as bigint) as
stop from (select chrom, min(pos) as lo, max(pos) as hi from sites group by chrom) t""",
    "pgx": """
select site_id, sample, chrom, pos, ref as drug_ref, alt as drug_alt, case when gt in ('./.', '0/0')
then '.' when site_id % 7 = 0 then concat(ref, 'CA') else ref end as ref_calling, case when gt in
('./.', '0/0') then '.' when site_id % 13 = 0 then concat(alt, ',', ref, 'TT') when site_id % 5 = 0
then concat(alt, 'GG') else alt end as alt_calling, case when gt in ('./.', '0/0') then '0/0' when
site_id % 13 = 0 then '1/2' else gt end as gt, ad0 + ad1 as dp, case when gt in ('./.', '0/0') then
null else ad1 / cast(ad0 + ad1 as double) end as ratio, cast(8 + site_id % 20 as bigint) as depth_threshold,
cast(85 + site_id % 14 as double) / 100 as het_hom_ratio_threshold, cast(30 + site_id % 25 as double) / 100 as
ref_het_ratio_threshold, case when site_id % 2 = 0 then 'yes' else 'no' end as corrected, concat('q',
cast(site_id % 9 as string)) as qd from calls""",
    "pair_reads": """
select concat('S', cast(l_orderkey % 4 as string)) as sample, l_orderkey as qname, case l_linenumber
when 1 then 64 when 2 then 128 else 2048 end + case when l_returnflag = 'R' and l_linenumber < 3
then 1024 else 0 end as flag, concat('chr', cast(l_orderkey % 3 + 1 as string)) as chrom, l_partkey
* 10 as start, l_partkey * 10 + cast(l_quantity as bigint) as stop, case when l_suppkey % 2 = 0 then
'5S40M' else '45M' end as cigar from lineitem""",
    "breakpoints": """
select concat('chr', cast(p_partkey % 3 + 1 as string)) as chrom, p_partkey * 10 as bp_left,
p_partkey * 10 + 900 as bp_right, concat('del', cast(p_partkey as string)) as cnv_name, cast(0.001 as double) as
thres_normal, cast(0.02 as double) as thres_hom_del, cast(1 as bigint) as thres_support_reads, cast(p_size as
double) / 2 as thres_mean_reads from part where p_partkey % 5 = 0""",
    "snv": """
select distinct chrom, pos % 30000 + 100 as pos, ref, alt from sites where var_type = 'snp'""",
    "dotted": """
select site_id, chrom, pos % 3000 + 100 as start, case site_id % 4 when 0 then '.' when 1 then
concat(ref, 'AT') when 2 then ref else concat(ref, 'C') end as ref, case site_id % 4 when 1 then '.'
when 0 then 'GT' when 2 then substring(alt, 1, 1) else concat(alt, 'TT') end as alt from sites""",
    "anchored": """
select site_id, chrom, pos, case site_id % 5 when 0 then ref when 1 then concat(ref, 'AT') when 2
then ref when 3 then concat(ref, 'C') else concat(ref, 'G') end as ref, case site_id % 5 when 0 then
concat(ref, 'GT') when 1 then ref when 2 then substring(alt, 1, 1) when 3 then concat(ref, 'TTG') else
concat(substring(alt, 1, 1), 'TT') end as alt from sites""",
    "tx_exons": """
select concat('NM_', substring(gene, 7), cast(region_id % 5 as string), '.1') as tx, gene, case when
region_id % 5 in (1, 3) then -region_id else region_id end as exon_no, start, stop, chrom, case when
region_id % 5 in (1, 3) then '-' else '+' end as strand, concat('NC_0000', case region_id % 5 when 3
then '23' when 4 then '24' when 0 then '01' when 1 then '02' else '03' end, '.10') as accession,
cast(4 as bigint) as cds_start, cast(60 as bigint) as cds_stop, region_id from regions where start > 0""",
    "coding": """
select region_id, gene, concat('c.', case region_id % 7 when 0 then concat(n, 'A>G') when 1 then
concat(n, '_', n2, 'del') when 2 then concat('-2', 'C>T') when 3 then concat(n, '+5dup') when 4 then
'*3G>A' when 5 then concat(n, '_', n1, 'insGA') else concat(n, '-3delinsTT') end) as c, tx from
(select *, cast(region_id % 50 + 1 as string) as n, cast(region_id % 50 + 2 as string) as n1,
cast(region_id % 50 + 3 as string) as n2 from tx_exons) t""",
    "ref_chunks": """
select case rec % 5 when 3 then 'chrX' when 4 then 'chrY' else concat('chr', cast(rec % 5 + 1 as
string)) end as chrom, cast(floor(rec / 5.0) as bigint) as chunk, case when rec % 29 = 0 then
concat('NNN', substring(seq1, 4, 9)) else seq1 end as seq from fq""",
}

# DuckDB only: brute-force expansions the oracles start from.
ORACLE_VIEWS: dict[str, str] = {
    "linked": """
select c.chrom, c.pos, c.ref, c.alt, c.var_type, c.site_id, b.ps, b.gt as gt_lfr, b.dp as dp_lfr,
round_even(floor(b.dp / 3.0) / b.dp, 3) as ratio_lfr,
case b.gt when '1|0' then c.alt when '0|1' then c.ref else c.alt end as m1,
case b.gt when '1|0' then c.ref when '0|1' then c.alt else c.alt end as m2, c.f, c.f_dp, c.m, c.m_dp, c.e, c.e_dp
from (select chrom, pos, ref, alt, var_type, site_id,
max(gt) filter (where sample = 'Father') as f, max(ad0 + ad1) filter (where sample = 'Father') as f_dp,
max(gt) filter (where sample = 'Mother') as m, max(ad0 + ad1) filter (where sample = 'Mother') as m_dp,
max(gt) filter (where sample = 'Embryo1') as e, max(ad0 + ad1) filter (where sample = 'Embryo1') as e_dp
from calls where filter <> 'LowQual' and gt <> './.' and ad0 + ad1 > 0
group by chrom, pos, ref, alt, var_type, site_id) c
join phased b on b.chrom = c.chrom and b.pos = c.pos and b.ref = c.ref
where c.f is not null and c.m is not null""",
    "linked_if": """
select *, case when yes then case when fb = m1 then 'M2' else 'M1' end else '.' end as allele,
case when not yes then 'Fail' when least(f_dp, dp_lfr) < 24 then 'LowDepth' else 'Pass' end as if_filter,
case when pos < 20000 then 'upstream' when pos > 60000 then 'downstream' else 'internal' end as location,
case when not yes or e is null then '.' when e in ('0/0', '1/1') and eb = fb then '.' when
(case when e in ('0/0', '1/1') then eb when fb = ref then alt else ref end) = m1 then 'M1' else 'M2' end as raw_hap
from (select *, gt_lfr <> '1|1' and f in ('0/0', '1/1') as yes, case f when '0/0' then ref else alt end as fb,
case e when '0/0' then ref else alt end as eb from linked) t""",
    "ok_call": """
select *, ad0 + ad1 as dp, round_even(ad1 / cast(ad0 + ad1 as double), 3) as ratio from calls where
filter <> 'LowQual' and gt <> './.' and ad0 + ad1 > 0""",
    "fixed_call": """
select *, case when gt = './.' then null when sample in ('Father', 'Mother', 'Proband') then case gt
when '0/1' then case when ratio < 0.05 then '0/0' when ratio > 0.95 then '1/1' else gt end when
'1/1' then case when ratio <= 0.95 then '0/1' else gt end else case when ratio >= 0.05 then '0/1'
else gt end end else case when ratio > 0 and ratio < 1 then '0/1' else gt end end as gtc from
ok_call""",
    "fam": """
select chrom, pos, ref, alt, var_type, site_id,
max(dp) filter (where sample = 'Father') as f_dp, max(gtc) filter (where sample = 'Father') as f,
max(dp) filter (where sample = 'Mother') as m_dp, max(gtc) filter (where sample = 'Mother') as m,
max(dp) filter (where sample = 'Proband') as p_dp, max(gtc) filter (where sample = 'Proband') as p,
max(dp) filter (where sample = 'Embryo1') as e1_dp, max(gtc) filter (where sample = 'Embryo1') as e1,
max(dp) filter (where sample = 'Embryo2') as e2_dp, max(gtc) filter (where sample = 'Embryo2') as e2,
max(dp) filter (where sample = 'Embryo3') as e3_dp, max(gtc) filter (where sample = 'Embryo3') as e3
from fixed_call group by chrom, pos, ref, alt, var_type, site_id
having count(*) filter (where sample in ('Father', 'Mother', 'Proband')) = 3""",
    "rule": """
select * from (values ('0/0', '0/1', '0/0', 'R', 'R', 'R', 'A'), ('0/0', '0/1', '0/1', 'R', 'R', 'A', 'R'),
('0/1', '0/0', '0/0', 'R', 'A', 'R', 'R'), ('0/1', '0/0', '0/1', 'A', 'R', 'R', 'R'),
('0/1', '1/1', '0/1', 'R', 'A', 'A', 'A'), ('0/1', '1/1', '1/1', 'A', 'R', 'A', 'A'),
('1/1', '0/1', '0/1', 'A', 'A', 'R', 'A'), ('1/1', '0/1', '1/1', 'A', 'A', 'A', 'R'))
as t(f, m, p, f1, f2, m1, m2)""",
    "core": """
select fam.*, case when f1 is null then 'no' else 'yes' end as if_,
case f1 when 'R' then ref when 'A' then alt else '.' end as h_f1,
case f2 when 'R' then ref when 'A' then alt else '.' end as h_f2,
case m1 when 'R' then ref when 'A' then alt else '.' end as h_m1,
case m2 when 'R' then ref when 'A' then alt else '.' end as h_m2,
case when f1 is null then '.' when f1 <> f2 then case when f1 = m1 then 'F2' else 'F1' end
else case when m1 = f1 then 'M2' else 'M1' end end as allele
from fam left join rule on fam.f = rule.f and fam.m = rule.m and fam.p = rule.p""",
    "hap": """
select c.*, t.gene, case when if_ = 'no' then 'Fail' when least(f_dp, m_dp, p_dp) < 24 then
'LowDepth' else 'Pass' end as if_filter, case when c.pos < t.start then 'upstream' when c.pos >
t.stop then 'downstream' else 'internal' end as location, case allele when 'F1' then h_f1 when 'F2'
then h_f2 when 'M1' then h_m1 when 'M2' then h_m2 end as own
from core c join targets t on c.chrom = t.chrom and c.pos > t.start_extend and c.pos <= t.end_extend""",
    "emb": """
select gene, chrom, pos, site_id, location, if_filter, var_type, sample, case when if_ = 'no' or g is null then '.'
when g in ('0/0', '1/1') and (case g when '0/0' then ref else alt end) <> own then '.' when d < 14
then concat(allele, '-LowDepth') else allele end as hap from (
select *, 'Embryo1' as sample, e1 as g, e1_dp as d from hap union all
select *, 'Embryo2', e2, e2_dp from hap union all select *, 'Embryo3', e3, e3_dp from hap) t""",
    "counted": """
select gene, sample, count(*) filter (where hap = 'F1' and location = 'upstream') as "F1-U",
count(*) filter (where hap = 'F1' and location = 'internal') as "F1-I",
count(*) filter (where hap = 'F1' and location = 'downstream') as "F1-D",
count(*) filter (where hap = 'F2' and location = 'upstream') as "F2-U",
count(*) filter (where hap = 'F2' and location = 'internal') as "F2-I",
count(*) filter (where hap = 'F2' and location = 'downstream') as "F2-D",
count(*) filter (where hap = 'M1' and location = 'upstream') as "M1-U",
count(*) filter (where hap = 'M1' and location = 'internal') as "M1-I",
count(*) filter (where hap = 'M1' and location = 'downstream') as "M1-D",
count(*) filter (where hap = 'M2' and location = 'upstream') as "M2-U",
count(*) filter (where hap = 'M2' and location = 'internal') as "M2-I",
count(*) filter (where hap = 'M2' and location = 'downstream') as "M2-D"
from (select gene, sample, location, hap from emb where if_filter = 'Pass' and var_type <> 'indel'
union all select gene, 'IF', location, allele from hap where if_filter = 'Pass' and var_type <>
'indel') t group by gene, sample""",
    "per_base": """
select chrom, unnest(range(start, stop)) as pos, is_dup, sample from reads""",
    "base_depth": """
select chrom, pos, count(*) as depth from per_base group by chrom, pos""",
    "target_base": """
select distinct chrom, unnest(range(start, stop)) as pos from regions""",
    "depth_event": """
select chrom, pos, sum(d) as d from (select chrom, start as pos, 1 as d from reads union all select
chrom, stop, -1 from reads) t group by chrom, pos having sum(d) <> 0""",
    "depth_run": """
select chrom, pos as start, lead(pos) over (partition by chrom order by pos) as stop, cast(sum(d)
over (partition by chrom order by pos) as bigint) as depth from depth_event""",
    "island_flag": """
select *, case when start > coalesce(max(stop) over (partition by chrom order by start, stop rows
between unbounded preceding and 1 preceding), -1) then 1 else 0 end as f from regions""",
    "island": """
select chrom, min(start) as start, max(stop) as stop from (select *, sum(f) over (partition by chrom
order by start, stop rows unbounded preceding) as g from island_flag) t group by chrom, g""",
    "ref_text": """
select chrom, string_agg(seq, '' order by chunk) as txt, min(chunk) * 12 as origin from ref_chunks
group by chrom""",
}

# The one construct the two dialects spell differently.
_UNNEST = ("explode(array(", "unnest(list_value(")


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    known = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text):
            if word in known and word not in order and _mentions(text, word):
                visit(known[word])
                if word not in order:
                    order.append(word)

    visit(body)
    if not order:
        return body
    own, head = body.lstrip(), "with "
    if own.startswith("with recursive "):
        own, head = "with " + own.removeprefix("with recursive "), "with recursive "
    rest = ", " + own[5:] if own[:5].lower() == "with " else own
    return head + ",\n".join(f"{n} as ({known[n]})" for n in order) + "\n" + rest


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b(?:from|join)\s+\(*\s*{name}\b|,\s*{name}\b(?=\s+\w+\s+(?:where|,))", text, re.I) is not None


def for_duckdb(body: str) -> str:
    text = with_views(body, ORACLE_VIEWS)
    # the closing brackets match: explode(array(x)) -> unnest(list_value(x))
    return text.replace(*_UNNEST)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter view ``name`` as a Spark DataFrame."""
    text = with_views(f"select * from {name}")
    used = [t for t in TABLES if re.search(rf"\bfrom {t}\b", text)]
    for t in used:
        text = re.sub(rf"\bfrom {t}\b", f"from {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})
