"""Plans whose cost may not jump with the data: no broadcast of exploded rows, no frame to the end of a group."""

import __spark_entry__ as contract
import pytest
from pyspark.sql import functions as F
from strandwise.functions.running import sweep
from strandwise.operators import assay as ay
from strandwise.operators import cohort as ch
from strandwise.operators import copynumber as cn
from strandwise.operators import coverage as cv
from strandwise.operators import intervals as iv
from strandwise.operators import pharmaco as px
from strandwise.operators import samples as sm
from strandwise.operators.smoothing import nearest_radius
from strandwise.sources.alignments import base_depth_of_calls


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(df, folder):
    df.write.parquet(str(folder))  # files have a size, on which Spark's estimate rests
    return df.sparkSession.read.parquet(str(folder))


def test_region_depth_broadcasts_no_regions(spark, tmp_path):
    reads = spark.createDataFrame([("S0", "chr1", 5, 25, False), ("S1", "chr1", 12, 14, False)], "sample string, chrom string, start long, stop long, is_dup boolean")
    regions = spark.createDataFrame([(1, "chr1", 10, 20), (2, "chr1", 10, 20), (3, "chr2", 0, 4)], "region_id long, chrom string, start long, stop long")
    reads, regions = _stored(reads, tmp_path / "reads"), _stored(regions, tmp_path / "regions")
    out = cv.region_depth(reads, regions, sample="sample", samples=["S0", "S1"])
    got = {(r["sample"], r["region_id"]): (r["base"], r["mean_depth"], r["coverage"]) for r in out.collect()}
    assert got == {
        ("S0", 1): (10, 1.0, 1.0), ("S0", 2): (10, 1.0, 1.0), ("S0", 3): (0, 0.0, 0.0),
        ("S1", 1): (2, 0.2, 0.2), ("S1", 2): (2, 0.2, 0.2), ("S1", 3): (0, 0.0, 0.0),
    }
    # one file of regions is under the broadcast limit, its regions times samples times ends need not be
    joins = [line for line in _plan(cv.region_depth(reads, regions, sample="sample", samples=["S0", "S1"])).split("\n") if "Join [" in line]
    assert "SortMergeJoin" in joins[0] and "SortMergeJoin" in joins[1]


def test_recall_looks_right_without_a_frame_to_the_end(spark):
    # a DUP every 50 exons, exons under the limit in between up to 30 to its left; the middle of the series has none
    kinds = ["DUP" if i % 50 == 0 else "NEAR" if i % 50 >= 20 else "NORMAL" for i in range(400)]
    rows = [("S1", "G", i, 1.5 if k == "DUP" else 1.29 if k == "NEAR" else 1.0, "F", 0.05, "DUP" if k == "DUP" else "NORMAL", "No") for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "sample string, gene string, number long, ratio_batch_fix double, gender string, cv double, type string, continuously string")
    out = cn.recall_near_threshold(df)
    got = {r["number"]: r["type"] for r in out.collect()}
    # the run 20 .. 49 ends at the next DUP, that of 370 .. 399 at the end of the gene
    assert got == {i: "DUP" if k == "DUP" or (k == "NEAR" and i < 350) else "NORMAL" for i, k in enumerate(kinds)}
    assert "unboundedfollowing" not in _plan(out).lower()


def test_radius_has_no_frame_to_the_end(spark):
    values = spark.createDataFrame([("A", float(x * x), 1 + x % 3) for x in range(60)], "k string, x double, n long")
    found = nearest_radius(values, ["k"], 0.3)
    xs = [float(x * x) for x in range(60) for _ in range(1 + x % 3)]
    near = int(0.3 * len(xs) + 1e-10)
    want = {x: sorted(abs(x - y) for y in xs)[near - 1] for x in xs}
    assert {r["x"]: r["radius"] for r in found.collect()} == want
    assert "unboundedfollowing" not in _plan(found).lower()


def test_segment_means_round_alike_in_any_order(spark):
    got = contract.queries()["E6_segment"](spark, "/root/testdata/sf0.01").where("sample = 'S9' and chrom = 'chr2' and start = 0").first()
    # the marks are thousandths; their mean is 0.0486875
    assert (got["num_mark"], got["seg_mean"]) == (32, 0.048688)


def test_barcode_texts_are_not_broadcast(spark, tmp_path):
    sheet = spark.createDataFrame([(1, "b1", "AAAA"), (2, "b2", "ACCA")], "ord long, barcode string, seq string")
    pairs = spark.createDataFrame([(1, "TTTT"), (2, "TGGT"), (3, "TTGT"), (4, "TNGG"), (5, "CCCC")], "rec long, seq2 string")
    out = sm.demultiplex(pairs, _stored(sheet, tmp_path / "sheet"), 2, length=4, read_length=0)
    assert {r["rec"]: r["barcode"] for r in out.collect()} == {1: "b1", 2: "b1", 3: "b1", 4: "b2"}
    assert "BroadcastHashJoin" not in _plan(out)


def test_counts_per_end_are_not_broadcast(spark, tmp_path):
    a = spark.createDataFrame([("chr1", 0, 10), ("chr1", 10, 20), ("chr2", 0, 10), (None, 0, 10)], "chrom string, start long, stop long")
    b = spark.createDataFrame([("chr1", 5, 12), ("chr1", 9, 10)], "chrom string, start long, stop long")
    a, b = _stored(a, tmp_path / "a"), _stored(b, tmp_path / "b")
    out = iv.count_overlaps(a, b)
    assert sorted((r["chrom"] or "", r["start"], r["n_overlaps"]) for r in out.collect()) == [("", 0, 0), ("chr1", 0, 2), ("chr1", 10, 1), ("chr2", 0, 0)]
    joins = [line for line in _plan(iv.count_overlaps(a, b)).split("\n") if "Join [" in line]
    assert "SortMergeJoin" in joins[0] and "SortMergeJoin" in joins[1]


def test_bayes_factors_are_integrated_by_many_tasks(spark):
    rows = spark.createDataFrame([(1, 3, 10), (2, 3, 10), (3, 700, 1000), (4, None, 5)], "row_id long, mut long, total long")
    out = ay.bayes_factor(rows, "mut", "total", grid=1000)
    got = {r["row_id"]: r["bf"] for r in out.collect()}
    assert got[1] == got[2] < 1 < got[3] and got[4] is None
    # the pairs weigh next to nothing, so a shuffle by size would leave them to one task
    assert "REPARTITION_BY_NUM" in _plan(out)


@pytest.fixture
def never_small(spark):
    """Tables are as large for the planner as they are at size: none is broadcast unasked."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_known_genotypes_do_not_shuffle_calls_by_sample(spark, never_small):
    calls = spark.createDataFrame([("Father", 1, "A", "AT", "A/AT"), ("Embryo1", 2, "A", "AT", "AT/AT")], "sample string, id long, ref string, alt string, genotype string")
    known = spark.createDataFrame([("Father", "I/D"), ("Mother", "D/D")], "sample string, known string")
    out = px.indel_consistency(calls, known)
    assert sorted((r["id"], r["ace"], r["known"]) for r in out.collect()) == [(1, "I/D", "I/D"), (2, "I/I", "-")]
    assert "hashpartitioning(sample" not in _plan(out)


def test_cohort_state_is_not_shuffled_by_batch(spark, tmp_path, never_small, monkeypatch):
    plans, ranked = [], ch.ranked  # the values of the wanted ranges are written down before they are ranked
    monkeypatch.setattr(ch, "ranked", lambda values, keys: plans.append(_plan(values)) or ranked(values, keys))
    rows = [(f"S{s}", "F" if s % 2 else "M", "chr1", b, b + 100, s * 0.25 + b) for s in range(5) for b in (0, 100)]
    bins = spark.createDataFrame(rows, "sample string, gender string, chrom string, start long, stop long, ratio_gc_fix double")
    for name, some in (("early", "sample < 'S2'"), ("late", "sample >= 'S2'")):
        ch.add_batch(bins.where(some), str(tmp_path), name)
    out = ch.correct_by_cohort(bins, str(tmp_path), sex_matched=True, min_same_sex=3)
    got = {(r["sample"], r["start"]): r["ratio_control"] for r in out.collect()}
    assert got == {(f"S{s}", b): 0.5 + b for s in range(5) for b in (0, 100)}
    assert len(plans) == 2 and all("SortMergeJoin [chrom" in p and "SortMergeJoin [batch" not in p for p in plans)


def test_bins_are_not_shuffled_by_sample_or_sex(spark, never_small):
    rows = [(f"S{s}", "F" if s % 2 else "M", "chr1", b, b + 100, 100, 10 + s, 1.0 + s * b) for s in range(4) for b in (0, 100)]
    bins = spark.createDataFrame(rows, "sample string, gender string, chrom string, start long, stop long, size long, base long, mean_depth double")
    scaled = cn.normalize_depth(bins)
    assert {r["ratio"] for r in scaled.where("sample = 'S1'").collect()} == {1 / 0.11, 101 / 0.11}
    out = cn.batch_correct(scaled.withColumnRenamed("ratio", "ratio_gc_fix"), sex_matched=True, min_same_sex=2)
    assert out.count() == 8
    joins = [line for line in _plan(out).split("\n") if "SortMergeJoin" in line]
    assert joins and not [line for line in joins if "SortMergeJoin [sample" in line or "SortMergeJoin [gender" in line]


def test_bases_meet_their_position_before_they_are_shuffled(spark):
    rows = [("r1", 0, "chr1", 11, "2M1I2M", "ACGTN", "IIIII"), ("r2", 0, "chr1", 12, "3M", "acg", "I%I"), ("r3", 1024, "chr1", 11, "1M", "A", "I"), ("r4", 0, "chr2", 1, "2M", "*", "*")]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, cigar string, seq string, qual string")
    out = base_depth_of_calls(reads)
    # r1 has A C, an inserted G, T and an N; the second base of r2 is of low quality
    assert {(r["chrom"], r["pos"]): r["depth"] for r in out.collect()} == {("chr1", 10): 1, ("chr1", 11): 2, ("chr1", 12): 1, ("chr1", 13): 1}
    plan = _plan(contract.queries()["C1_base_depth_per_base"](spark, "/root/testdata/sf0.001"))
    assert "rangepartitioning(rname" in plan


def test_targets_are_not_broadcast_to_one_task(spark, tmp_path):
    targets = spark.createDataFrame([(1, "chr1", 0, 100000), (2, "chr2", 0, 10)], "name long, chrom string, start long, stop long")
    calls = spark.createDataFrame([("chr1", 10, 30, "a"), ("chr1", 90000, 95000, "b"), ("chr2", 10, 20, "c")], "chrom string, start long, stop long, ps string")
    targets, calls = _stored(targets, tmp_path / "targets"), _stored(calls, tmp_path / "calls")
    out = iv.best_overlap(targets, calls, key=["name"], order=["start", "stop", "ps"])
    assert {r["name"]: r["ps"] for r in out.collect()} == {1: "b", 2: None}
    assert "BroadcastHashJoin [chrom" not in _plan(iv.best_overlap(targets, calls, key=["name"], order=["start", "stop", "ps"]))


def test_capture_metrics_cut_reads_once_and_join_them_once(spark, monkeypatch):
    reads = spark.createDataFrame(
        [("chr1", 0, 10, False, 10), ("chr1", 5, 15, True, 10), ("chr1", 18, 20, False, 10), ("chr1", 20, 25, None, 10), ("chr2", 0, 10, False, 10)],
        "chrom string, start long, stop long, is_dup boolean, length long")
    targets = spark.createDataFrame([("chr1", 8, 12), ("chr1", 10, 14), ("chr1", 24, 30)], "chrom string, start long, stop long")
    got = cv.capture_metrics(reads, targets, cutoffs=(1, 2)).first()
    assert (got["target_size"], got["target_bases"], got["target_bases_rmdup"]) == (12, 9, 2)
    assert (got["mapped_reads"], got["mapped_reads_rmdup"], got["target_reads"], got["target_reads_rmdup"]) == (5, 3, 3, 1)
    assert (got["coverage_1x"], got["coverage_2x"], got["coverage_1x_rmdup"]) == (700 / 12, 200 / 12, 200 / 12)
    events = sweep({"depth": reads, "unique": reads}, weights={"unique": F.when(~F.col("is_dup"), 1).otherwise(0)})
    assert sum("explode(" in line for line in events._jdf.queryExecution().analyzed().toString().split("\n")) == 2  # rows and blocks
    monkeypatch.setattr(iv, "count_overlaps_of", None)  # it joined the reads with the counts at either end
    monkeypatch.setattr(cv, "count_overlaps_of", None)
    assert cv.capture_metrics(reads, targets).first()["target_reads"] == 3
