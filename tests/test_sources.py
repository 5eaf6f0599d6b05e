"""Readers and writers over real files."""

import json

import pytest
from pyspark.sql import functions as F

from strandwise.sources import tables, vcf
from strandwise.sources.alignments import read_sam

HEAD = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"


def test_each_file_has_its_own_samples(spark, tmp_path):
    for name, people, gt in (("a.vcf", ["A"], ["0/1"]), ("b.vcf", ["B", "C"], ["1/1", "0/0"])):
        text = "##x\n" + HEAD + "\t".join(people) + "\nchr1\t5\t.\tA\tG\t.\tPASS\tSVTYPE=DEL\tGT\t" + "\t".join(gt) + "\n"
        (tmp_path / name).write_text(text)
    paths = [f"{tmp_path}/a.vcf", f"{tmp_path}/b.vcf"]
    rows = vcf.read_vcf(spark, paths).select("sample", "gt").collect()
    assert sorted(map(tuple, rows)) == [("A", "0/1"), ("B", "1/1"), ("C", "0/0")]
    assert sorted(r.sample for r in vcf.read_sv_sites(spark, paths).collect()) == ["A", "B", "C"]


def test_written_vcf_is_one(spark, tmp_path):
    sites = spark.createDataFrame([("chr10", 3), ("chr2", 9), ("chr2", 4), ("chrX", 1)], "chrom string, pos long")
    for c in ("id", "ref", "alt", "qual", "filter", "info"):
        sites = sites.withColumn(c, F.lit(None).cast("string"))
    vcf.write_vcf_info(sites, ["##v", "#CHROM\tPOS"], "S", F.lit("x"), f"{tmp_path}/out")
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*")):
        text = part.read_text().splitlines()
        if text:
            assert text[:3] == ["##v", '##INFO=<ID=S,Number=.,Type=String,Description="S">', "#CHROM\tPOS"]
            lines += text[3:]
    assert [tuple(x.split("\t")[:2]) for x in lines] == [("chr2", "4"), ("chr2", "9"), ("chr10", "3"), ("chrX", "1")]


def test_lanes_pair_by_name_whatever_their_size(spark, tmp_path):
    for mate in "12":
        folder = tmp_path / f"R{mate}"
        folder.mkdir()
        for lane, n in (("a", 2), ("b", 40 if mate == "1" else 3)):
            records = 3 if lane == "b" else 2
            text = "".join(f"@{lane}{i}\n{'ACGT' * n}\n+\n{'I' * 4 * n}\n" for i in range(records))
            (folder / f"{lane}.fq").write_text(text)
    got = tables.read_fastq_pairs(spark, f"{tmp_path}/R1", f"{tmp_path}/R2").collect()
    assert [r.name for r in sorted(got, key=lambda r: r.rec)] == ["@a0", "@a1", "@b0", "@b1", "@b2"]
    assert all(len(r.seq1) == (8 if r.name[1] == "a" else 160) and len(r.seq2) == (8 if r.name[1] == "a" else 12) for r in got)


def test_reports(spark, tmp_path):
    doc = {"summary": {"before_filtering": {"total_bases": 70, "q20_rate": 0.5}, "after_filtering": {"total_reads": 7}}}
    (tmp_path / "S1.fastp.json").write_text(json.dumps(doc, indent=1))
    row = tables.read_fastp_json(spark, f"{tmp_path}/*.fastp.json").first()
    assert (row.sample, row.total_reads, row.raw_bases, row.before_filtering.q20_rate) == ("S1", 7, 70, 0.5)
    (tmp_path / "S2.stat").write_text("Raw:\t0\n  Raw:\t12\nOther:\t1\n")
    row = tables.read_report_kv(spark, f"{tmp_path}/*.stat", ["Raw:", "Parity:"]).first()
    assert row.asDict() == {"sampleID": "S2", "Raw:": "12", "Parity:": None}


def test_bed_gff_and_sam(spark, tmp_path):
    (tmp_path / "x.bed").write_text("# c\nchr1\t1\t5\nchrY\t2\t9\n")
    assert [tuple(r) for r in tables.read_bed(spark, f"{tmp_path}/x.bed", one_based=True, windows=True).collect()] == [("chr1", 0, 5)]
    (tmp_path / "x.gff").write_text("#h\nc\ts\texon\t1\t9\t.\t+\t.\tID=e1;gene=G;transcript_id=T\nc\ts\tgene\t1\t9\t.\t+\t.\tID=g\n")
    row = tables.read_gff_exons(spark, f"{tmp_path}/x.gff").first()
    assert (row.start, row.stop, row.gene, row.id, row.tx) == (1, 9, "G", "e1", "T")
    sam = "@HD\tx\nq\t0\tchr1\t5\t60\t4M\t=\t9\t0\tACGT\tIIII\tMD:Z:4\nq\t256\tchr1\t5\t60\t4M\t=\t9\t0\tACGT\tIIII\n"
    (tmp_path / "x.sam").write_text(sam)
    assert [(r.flag, r.md) for r in read_sam(spark, f"{tmp_path}/x.sam").collect()] == [(0, "4")]
    assert read_sam(spark, f"{tmp_path}/x.sam", primary_only=False).count() == 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_go_round(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1, None), ("b", None, "x y")], "k string, n long, t string")
    tables.write_table(df, f"{tmp_path}/{fmt}", fmt=fmt)
    back = tables.read_table(spark, f"{tmp_path}/csv", df.schema) if fmt == "csv" else spark.read.parquet(f"{tmp_path}/parquet")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
