"""Readers and writers for tables and reports.  ``.`` is missing and becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandwise.functions.columns import q

BED = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("stop", T.LongType()),
    ]
)
TARGET_GENE = T.StructType(
    [T.StructField("gene", T.StringType()), T.StructField("chrom", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("start_extend", "end_extend", "start", "stop")]
)


def parse_table(lines: DataFrame, schema: T.StructType, sep: str = "\t", header: str | None = None) -> DataFrame:
    """Typed columns of separated text lines ``value``; ``header`` is the line to skip."""
    rows = lines if header is None else lines.where(F.col("value") != header)
    cells = F.split("value", sep)
    return rows.select(
        *[
            F.nullif(F.get(cells, F.lit(i)), F.lit(".")).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        ]
    )


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True) -> DataFrame:
    """Tab-separated file with an explicit schema; columns are matched by position."""
    return spark.read.csv(path, sep="\t", header=header, schema=schema, nullValue=".", enforceSchema=True)


def to_half_open(df: DataFrame, drop_sex_and_mt: bool = False) -> DataFrame:
    """1-based closed → 0-based half-open; optionally without Y and M contigs."""
    out = df.withColumn("start", F.col("start") - 1)
    return out.where(~F.col("chrom").rlike("Y|M")) if drop_sex_and_mt else out


def read_bed(spark: SparkSession, path: str | list[str], one_based: bool = False, windows: bool = False) -> DataFrame:
    """Intervals; ``windows`` leaves Y and M contigs out."""
    df = spark.read.csv(path, sep="\t", schema=BED, comment="#")
    df = df.where(~F.col("chrom").rlike("Y|M")) if windows else df
    return to_half_open(df) if one_based else df


_FASTP = (
    "summary struct<"
    "before_filtering:struct<total_reads:bigint,total_bases:bigint,q20_rate:double,q30_rate:double>,"
    "after_filtering:struct<total_reads:bigint,total_bases:bigint,q20_rate:double,q30_rate:double>>"
)


def file_name(path, suffix: str = "") -> Column:
    """Last part of a path without ``suffix``."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.when(base.endswith(suffix), F.substr(base, F.lit(1), F.length(base) - len(suffix))).otherwise(base)


def parse_fastp_json(docs: DataFrame) -> DataFrame:
    """Whole JSON documents (path, value) → sample and the two summaries."""
    parsed = F.from_json("value", _FASTP)
    return docs.select(file_name("path", ".fastp.json").alias("sample"), parsed.alias("j")).select(
        "sample",
        "j.summary.before_filtering",
        "j.summary.after_filtering",
        F.col("j.summary.after_filtering.total_reads").alias("total_reads"),
        F.col("j.summary.before_filtering.total_bases").alias("raw_bases"),
    )


def read_fastp_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trimming reports, one document per file, sample from the file name."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_fastp_json(docs)


def parse_report_kv(lines: DataFrame, labels: Sequence[str], suffix: str = ".stat") -> DataFrame:
    """``label TAB value`` lines (path, line_no, value) → one row per file.

    The first line of each file is skipped and leading blanks are stripped.
    """
    cells = F.split(F.ltrim("value"), "\t")
    rows = lines.where("line_no > 0").select(
        file_name("path", suffix).alias("sampleID"), cells[0].alias("label"), F.get(cells, F.lit(1)).alias("v")
    )
    return rows.groupBy("sampleID").agg(
        *[F.max(F.when(F.col("label") == name, F.col("v"))).alias(name) for name in labels]
    )


def read_report_kv(spark: SparkSession, path: str | list[str], labels: Sequence[str], suffix: str = ".stat") -> DataFrame:
    """Reports are small, so each file is one record; its lines are numbered in it."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = docs.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))
    return parse_report_kv(lines, labels, suffix)


GFF = T.StructType(
    [T.StructField(n, T.LongType() if n in ("start", "stop") else T.StringType())
     for n in ("chrom", "source", "type", "start", "stop", "score", "strand", "phase", "attributes")]
)


def gff_exons(rows: DataFrame) -> DataFrame:
    """Exon rows with gene, ID, tag and transcript_id taken out of the attributes."""

    def attr(pattern: str) -> Column:
        return F.nullif(F.regexp_extract("attributes", pattern, 1), F.lit(""))

    return rows.where("type = 'exon'").select(
        "chrom",
        "start",
        "stop",
        "strand",
        attr("gene=(.*?);").alias("gene"),
        attr("ID=(.*?);").alias("id"),
        attr("tag=(.*?);").alias("tag"),
        attr("transcript_id=(.*?)$").alias("tx"),
    )


def read_gff_exons(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return gff_exons(spark.read.csv(path, sep="\t", schema=GFF, comment="#"))


def parse_fastq(lines: DataFrame, suffix: str) -> DataFrame:
    """Numbered lines (line_no, value) → one record per four lines, keyed by position."""
    part = F.col("line_no") % 4
    return (
        lines.groupBy(F.floor(F.col("line_no") / 4).alias("rec"))
        .agg(
            F.max(F.when(part == 0, F.col("value"))).alias("name"),
            F.max(F.when(part == 1, F.col("value"))).alias(f"seq{suffix}"),
            F.max(F.when(part == 3, F.col("value"))).alias(f"qual{suffix}"),
        )
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines numbered through the files in the order of their names.

    The lines of a split have consecutive ids; a counting pass gives each split its
    first id and the number of lines before it, one row a split.
    """
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin")]
    lines = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("id"), "value")
    before = Window.orderBy("file", "begin").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "begin").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    splits = splits.select("file", "begin", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(splits, ["file", "begin"]).select(
        (F.col("before") + F.col("id") - F.col("first")).alias("line_no"), "value"
    )


def pair_fastq(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pairs by record position, not by name."""
    return parse_fastq(first, "1").join(parse_fastq(second, "2").drop("name"), "rec")


def read_fastq_pairs(spark: SparkSession, path1: str, path2: str) -> DataFrame:
    """Pairs of two files or folders; files of a folder follow each other by name."""
    return pair_fastq(numbered_lines(spark, path1), numbered_lines(spark, path2))


def union_by_glob(
    spark: SparkSession, paths: list[str], schema: T.StructType, keys: dict[str, str], header: bool = True
) -> DataFrame:
    """One multi-path scan of like files; ``keys`` = column → regex over the file path."""
    df = spark.read.csv(paths, sep="\t", header=header, schema=schema, nullValue=".", enforceSchema=True)
    return df.select("*", *[F.regexp_extract("_metadata.file_path", p, 1).alias(k) for k, p in keys.items()])


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with differing columns, aligned by name, missing as null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "csv", mode: str = "error") -> None:
    """One directory per key; rows of a key may come from several tasks."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(sep="\t", header=True, nullValue=".", emptyValue="")
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def report_text(df: DataFrame) -> DataFrame:
    """Rows as tab-separated text with '.' for null."""
    return df.select(
        F.concat_ws("\t", *[F.coalesce(q(c).cast("string"), F.lit(".")) for c in df.columns]).alias("value")
    )
