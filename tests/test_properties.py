"""Properties, planted truth and small literal cases."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwise.functions.quantiles import exact_quantiles
from strandwise.functions.sequence_text import reverse_complement
from strandwise.operators import assay, copynumber, genotype, intervals, phasing, ploidy
from strandwise.operators.coverage import base_depth
from strandwise.sources.alignments import parse_sam, read_blocks

SPANS = "chrom string, start long, stop long"


def _spans(rng, n, top=400, longest=60):
    out = []
    for _ in range(n):
        a = rng.randrange(top)
        out.append(("c1", a, a + 1 + rng.randrange(longest)))
    return out


def _bases(rows):
    return {b for _, s, e in rows for b in range(s, e)}


def _rows(df):
    return [tuple(r) for r in df.select("chrom", "start", "stop").collect()]


def test_merge_is_idempotent_and_blocks_do_not_matter(spark):
    rng = random.Random(1)
    df = spark.createDataFrame(_spans(rng, 60), SPANS)
    once = intervals.merge_intervals(df, block=7)
    assert sorted(_rows(once)) == sorted(_rows(intervals.merge_intervals(df)))
    assert sorted(_rows(intervals.merge_intervals(once))) == sorted(_rows(once))


def test_intersection_and_difference_partition_a(spark):
    rng = random.Random(2)
    a, b = _spans(rng, 25), _spans(rng, 25)
    da, db = spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS)
    both = _bases(_rows(intervals.intersect_intervals(da, db)))
    only = _bases(_rows(intervals.subtract_intervals(da, db)))
    assert both == _bases(a) & _bases(b)
    assert only == _bases(a) - _bases(b)


@pytest.mark.parametrize("hot", [None, 2])
@pytest.mark.parametrize("bin_size", [1, 16])
def test_overlap_join_mixed_lengths(spark, hot, bin_size):
    """Long and short intervals on both sides, and one locus holding a third of the rows."""
    rng = random.Random(3)
    a = _spans(rng, 20) + [("c1", 0, 5000)] + [("c1", 50, 51 + i % 3) for i in range(12)]
    b = _spans(rng, 20) + [("c1", 10, 4000), ("c1", 2, 3)]
    da, db = spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS)
    got = intervals.overlap_join(da, db, bin_size=bin_size, hot_rows=hot)
    want = sorted((x[1], x[2], y[1], y[2]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])
    assert sorted((r.start, r.stop, r.b_start, r.b_stop) for r in got.collect()) == want
    semi = intervals.overlap_join(da, db, "semi", bin_size=bin_size)
    anti = intervals.overlap_join(da, db, "anti")
    hit = [x for x in a if any(x[1] < y[2] and y[1] < x[2] for y in b)]
    assert sorted(_rows(semi)) == sorted(hit)
    assert sorted(_rows(semi) + _rows(anti)) == sorted(a)


def test_depth_adds_up(spark):
    rng = random.Random(4)
    reads = _spans(rng, 80)
    df = spark.createDataFrame(reads, SPANS)
    runs = base_depth(df, block=13).collect()
    assert sum((r.stop - r.start) * r.depth for r in runs) == sum(e - s for _, s, e in reads)
    inside = [r for r in sorted(runs, key=lambda r: r.start)]
    assert all(x.depth != y.depth for x, y in zip(inside, inside[1:]))


def test_windows_cover_the_region(spark):
    df = spark.createDataFrame([("c1", 5, 5 + n) for n in range(1, 60)], SPANS)
    out = intervals.sliding_windows(df, 10, 4, 6).collect()
    for n in range(6, 60):
        mine = [(r.win_start, r.win_stop) for r in out if r.stop == 5 + n]
        assert min(a for a, _ in mine) == 5 and max(z for _, z in mine) == 5 + n
        assert set(range(5, 5 + n)) == {b for a, z in mine for b in range(a, z)}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    data = {"a": rng.normal(size=301), "b": np.repeat([1.0, 2.0], 50), "c": np.array([7.0])}
    rows = [(k, float(x)) for k, xs in data.items() for x in xs]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: (r.lo, r.mid) for r in exact_quantiles(df, ["k"], "x", {"lo": 0.05, "mid": 0.5}).collect()}
    for k, xs in data.items():
        assert np.allclose(got[k], [np.quantile(xs, 0.05), np.median(xs)])


def test_reverse_complement_involution(spark):
    df = spark.createDataFrame([("ACGTNA",), ("",), ("GGGC",)], "s string")
    assert all(r.s == r.t for r in df.select("s", reverse_complement(reverse_complement("s")).alias("t")).collect())


def _core_by_rule(father, mother, child):
    """Parental haplotypes by trying both phases of every parent."""
    hits = set()
    for f in {(father[0], father[1]), (father[1], father[0])}:
        for m in {(mother[0], mother[1]), (mother[1], mother[0])}:
            if sorted((f[0], m[0])) == sorted(child):
                hits.add(f + m)
    return hits


def test_core_haplotype_all_genotypes(spark):
    gts = ["0/0", "0/1", "1/1"]
    rows = [(f, m, p, "A", ["G"]) for f in gts for m in gts for p in gts]
    df = spark.createDataFrame(
        rows, "Father_GT_correct string, Mother_GT_correct string, Proband_GT_correct string, ref string, alt array<string>"
    )
    for r in genotype.core_haplotype(df).collect():
        f, m, p = (tuple(int(x) for x in g.split("/")) for g in r[:3])
        one_het = (f[0] != f[1]) != (m[0] != m[1])
        hits = _core_by_rule(f, m, p)
        if one_het and len(hits) == 1:
            bases = tuple("AG"[i] for i in hits.pop())
            assert (r.F1, r.F2, r.M1, r.M2, r.IF) == (*bases, "yes")
        else:
            assert (r.F1, r.IF) == (".", "no")


def test_variant_slot(spark):
    df = spark.createDataFrame(
        [("1|0", 0), ("0|1", 1), ("1|1", 0), ("1|2", 1), ("2|1", 0), ("0/1", None)], "gt string, want int"
    )
    got = df.select("want", phasing.variant_slot(F.col("gt"), F.array(F.lit("C"), F.lit("T")), F.lit("T")).alias("s"))
    assert all(r.want == r.s for r in got.collect())


def _loop_repair(rows, cv, gender, chrom, conf):
    """The repair rules, row by row."""
    t, num, x = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
    n, flag = len(t), [False] * len(t)
    for i in range(n - 1):
        if t[i] != "NORMAL" and t[i] == t[i + 1]:
            flag[i] = flag[i + 1] = True
    limits = (conf.del_male_x, conf.dup_male_x) if gender == "M" else (conf.del_, conf.dup)
    for i in range(n - 2):
        near = any(abs(x[i + 1] - y) < conf.nearby_distance for y in limits)
        if t[i] != "NORMAL" and t[i] == t[i + 2] and t[i + 1] == "NORMAL" and near:
            t[i + 1] = t[i]
            flag[i] = flag[i + 1] = flag[i + 2] = True
    if cv < conf.nice_cv and gender != "M":
        for i in [k for k in range(n) if t[k] == "DUP"]:
            for step in (-1, 1):
                j = i + step
                while 0 <= j < n and t[j] == "NORMAL" and abs(conf.dup - x[j]) < conf.nearby_recall_distance:
                    t[j] = "DUP"
                    flag[i] = flag[j] = True
                    j += step
    for i in range(n):
        if flag[i] or (chrom == "chrX" and gender == "M"):
            continue
        if (t[i] == "DEL" and x[i] > conf.del_single) or (t[i] == "DUP" and x[i] < conf.dup_single):
            t[i], num[i] = "NORMAL", 2
    return [(a, b, "Yes" if f else "No") for a, b, f in zip(t, num, flag)]


def test_repair_calls_against_loop(spark):
    conf = copynumber.CopyConf()
    rng = np.random.default_rng(5)
    rows, meta = [], {}
    for g in range(150):
        gender, cv = rng.choice(["M", "F"]), float(rng.choice([0.05, 0.2]))
        chrom = rng.choice(["chrX", "chr1"])
        meta[f"g{g}"] = (cv, gender, chrom)
        for i in range(12):
            x = float(rng.choice([0.1, 0.5, 0.7, 0.74, 0.77, 1.0, 1.26, 1.28, 1.31, 1.35, 1.5, 1.6]))
            rows.append((f"g{g}", str(chrom), str(gender), cv, i, x))
    df = spark.createDataFrame(
        pd.DataFrame(rows, columns=["gene", "chrom", "gender", "cv", "number", "ratio_batch_fix"])
    ).withColumn("sample", F.lit("S"))
    called = copynumber.call_copy_number(df, "ratio_batch_fix")
    before, after = called.toPandas(), copynumber.repair_calls(called).toPandas()
    for g, (cv, gender, chrom) in meta.items():
        b = before[before.gene == g].sort_values("number")
        a = after[after.gene == g].sort_values("number")
        want = _loop_repair(list(zip(b.type, b.copy_num, b.ratio_batch_fix)), cv, gender, chrom, conf)
        assert list(zip(a.type, a.copy_num, a.continuously)) == want


def test_segment_finds_planted_steps(spark):
    rng = np.random.default_rng(7)
    level = np.zeros(300)
    level[100:140] = 0.9
    level[220:300] = -0.8
    x = level + rng.normal(0, 0.15, 300)
    df = spark.createDataFrame([("S", "c1", i * 100, float(v)) for i, v in enumerate(x)], "sample string, chrom string, start long, log2ratio double")
    flat = spark.createDataFrame([("T", "c1", i * 100, float(v)) for i, v in enumerate(rng.normal(0, 0.15, 200))], "sample string, chrom string, start long, log2ratio double")
    out = copynumber.segment(df.unionByName(flat)).toPandas()
    mine = out[out["sample"] == "S"].sort_values("start")
    assert abs(mine["start"].to_numpy() / 100 - np.array([0, 100, 140, 220])).max() <= 2
    assert np.allclose(mine["seg_mean"], [0, 0.9, 0, -0.8], atol=0.08)
    assert len(out[out["sample"] == "T"]) == 1


def test_two_peaks_planted(spark):
    rng = np.random.default_rng(9)
    x = np.round(np.concatenate([rng.normal(0.34, 0.04, 3000), rng.normal(0.66, 0.04, 3000)]).clip(0.01, 0.99), 3)
    df = spark.createDataFrame([("S", "chr1", float(v)) for v in x], "sample string, chrom string, ratio double")
    r = ploidy.peak_quality(ploidy.fit_two_peaks(df), df).first()
    assert abs(r.m1 - 0.34) < 0.01 and abs(r.m2 - 0.66) < 0.01 and abs(r.v1 - 0.0016) < 4e-4
    assert abs(r.ratio_separate - 0.32) < 0.02 and r.ratio_r2_score > 0.9


def test_peaks_and_distance(spark):
    trace = [0, 5, 9, 5, 0, 7, 7, 7, 0, 3, 20, 3, 12, 0, 0, 0, 0, 11, 0]
    df = spark.createDataFrame([("S", i, float(v)) for i, v in enumerate(trace)], "sample string, pos long, intensity double")
    assert sorted(r.pos for r in assay.call_peaks(df, 4, 1).collect()) == [2, 6, 10, 12, 17]
    assert sorted(r.pos for r in assay.call_peaks(df, 4, 5).collect()) == [2, 10, 17]
    # heights 20, 12, 11, 9, 7: the third is 11, so the second search starts at 12
    assert sorted(r.pos for r in assay.call_peaks(df, 4, 1, max_peaks=2).collect()) == [10, 12]


def test_ladder_walk(spark):
    sizes = [50, 75, 100, 150, 200]
    true = [2 * s + 10 for s in sizes]
    rows = [("S", p, 100.0) for p in true] + [("S", 240, 90.0)]
    df = spark.createDataFrame(rows, "sample string, pos long, height double")
    got = assay.ladder_by_slope(df, sizes, [0.9] * 5, min_found=5).collect()
    assert {r.size: r.pos for r in got} == dict(zip(map(float, sizes), true))


def test_sam_blocks(spark):
    line = "r1\t0\tchr1\t11\t60\t2S5M3D4M2I6M\t=\t40\t50\t" + "A" * 19 + "\t" + "I" * 19 + "\tMD:Z:5^ACG10"
    reads = parse_sam(spark.createDataFrame([("@HD",), (line,)], "value string"))
    plain = [(r.start, r.stop) for r in read_blocks(reads).orderBy("start").collect()]
    assert plain == [(10, 15), (18, 22), (22, 28)]
    assert (15, 18) in [(r.start, r.stop) for r in read_blocks(reads, count_deletions=True).collect()]


def test_files_round_trip(spark, tmp_path):
    from pyspark.sql import types as T

    from strandwise.sources import tables, vcf

    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
    (tmp_path / "x.vcf").write_text(head + "chr1\t7\t.\tA\tG,T\t9\tPASS\tQD=1;DB\tGT:AD:DP:PS\t0|1:3,4,0:7:p1\t./.\n")
    rows = vcf.read_vcf(spark, str(tmp_path / "x.vcf")).orderBy("sample").collect()
    assert (rows[0].gt, rows[0].ad, rows[0].ps, rows[0].alt) == ("0|1", [3, 4, 0], "p1", ["G", "T"])
    assert (rows[1].gt, rows[1].ad) == ("./.", None)
    (tmp_path / "t.tsv").write_text("a\tb\n1\t.\n2\tx\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = tables.read_table(spark, str(tmp_path / "t.tsv"), schema)
    assert sorted(map(tuple, df.collect())) == [(1, None), (2, "x")]
    for name, mark in (("p1", "A"), ("p2", "C")):
        (tmp_path / f"{name}.fq").write_text("".join(f"@r{i}\n{mark * (i + 1)}\n+\n{'I' * (i + 1)}\n" for i in range(3)))
    pairs = tables.read_fastq_pairs(spark, str(tmp_path / "p1.fq"), str(tmp_path / "p2.fq")).orderBy("rec").collect()
    assert [(r.name, r.seq1, r.seq2) for r in pairs] == [(f"@r{i}", "A" * (i + 1), "C" * (i + 1)) for i in range(3)]
    (tmp_path / "S1.stat").write_text("Head\n  Depth:\t12.5\nOther:\t1\n")
    kv = tables.read_report_kv(spark, str(tmp_path / "S1.stat"), ["Depth:"]).collect()
    assert [tuple(r) for r in kv] == [("S1", "12.5")]
    tables.write_table(df, str(tmp_path / "out"), by=["b"])
    tables.write_ndjson(df, str(tmp_path / "nd"))
    assert spark.read.json(str(tmp_path / "nd")).count() == 2
    sites = spark.createDataFrame([("chr1", 7, None, "A", "G", None, "PASS", "QD=1")], "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string")
    vcf.write_vcf_info(sites, ["#CHROM"], "S", F.lit("9"), str(tmp_path / "v"))
    text = sorted(r.value for r in spark.read.text(str(tmp_path / "v")).collect())
    assert text == ['##INFO=<ID=S,Number=.,Type=String,Description="S">', "#CHROM", "chr1\t7\t.\tA\tG\t.\tPASS\tQD=1;S=9"]


def test_rows_without_a_key_stay_in_left_and_anti_joins(spark):
    a = spark.createDataFrame([("c", 0, 9, 1), (None, 0, 9, 2), ("c", None, 5, 3), ("d", 3, 4, 4)], "chrom string, start long, stop long, k int")
    b = spark.createDataFrame([("c", 5, 20), (None, 0, 9)], "chrom string, start long, stop long")
    assert sorted(r.k for r in intervals.overlap_join(a, b, "left").collect()) == [1, 2, 3, 4]
    assert sorted(r.k for r in intervals.overlap_join(a, b, "anti").collect()) == [2, 3, 4]


def test_segments_split_until_none_is_open(spark):
    levels = [0, 7, 2, 11, 4, 15, 5, 19]
    rows = [("S", "c", i * 10, levels[i // 30] + (i * 7919 % 101) / 5000) for i in range(30 * len(levels))]
    got = copynumber.segment(spark.createDataFrame(rows, "sample string, chrom string, start long, x double"), "x").collect()
    assert sorted(r.start for r in got) == [i * 300 for i in range(len(levels))]


def test_quantiles_of_small_groups_take_one_sort(spark, monkeypatch):
    from strandwise.functions import quantiles as qt

    monkeypatch.setattr(qt, "SMALL", 50)
    rng = np.random.default_rng(3)
    groups = {"one": [2.5], "few": [-0.0, 0.0, 4.0, 4.0], "edge": rng.normal(size=50).tolist(), "many": rng.normal(size=400).round(1).tolist()}
    rows = [(g, v) for g, xs in groups.items() for v in xs] + [(None, 1.0), ("none", None), ("few", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = qt.exact_quantiles(df, ["g"], "v", {"m": 0.5, "up": 0.9})
    got = {r["g"]: (r["m"], r["up"]) for r in out.collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert np.allclose(got[g], np.quantile(xs, [0.5, 0.9]))
    sketched = []
    monkeypatch.setattr(qt, "_bucketed", lambda df, *rest, way=qt._bucketed: sketched.extend(r["g"] for r in df.collect()) or way(df, *rest))
    qt.exact_quantiles(df, ["g"], "v", {"m": 0.5})
    assert set(sketched) == {"many"}
