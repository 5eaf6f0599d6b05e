"""Alignment records as text or Parquet, and what their CIGAR strings cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# SAM column order, and the flags a pile-up leaves out.
SAM_COLUMNS = (
    ("qname", "string"), ("flag", "int"), ("rname", "string"), ("pos", "long"), ("mapq", "int"),
    ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "long"),
    ("seq", "string"), ("qual", "string"),
)
NOT_PRIMARY = 256 | 2048
NOT_PILED = 4 | 256 | 512 | 1024


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignment columns of text lines ``value``; header lines skipped, tags kept as array."""
    cols = F.split("value", "\t")
    return lines.where(~F.col("value").startswith("@")).select(
        *[cols[i].cast(kind).alias(name) for i, (name, kind) in enumerate(SAM_COLUMNS)],
        F.slice(cols, F.lit(12), F.greatest(F.size(cols) - 11, F.lit(0))).alias("tags"),
        F.nullif(F.regexp_extract("value", r"\tMD:Z:(\S+)", 1), F.lit("")).alias("md"),
    )


def read_sam(spark: SparkSession, path: str, *, primary_only: bool = True) -> DataFrame:
    """Alignments from text SAM or, for a ``.parquet`` path, a table of the same columns."""
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path)
    else:
        rows = parse_sam(spark.read.text(path))
    return primary(rows) if primary_only else rows


def primary(reads: DataFrame) -> DataFrame:
    """Without secondary and supplementary alignments."""
    return reads.where(F.col("flag").bitwiseAND(F.lit(NOT_PRIMARY)) == 0)


def _steps(cigar: Column) -> Column:
    """CIGAR → array of aligned pieces (op, reference offset, read offset, length)."""
    ops = F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(2))
    sizes = F.transform(
        F.regexp_extract_all(cigar, F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(1)), lambda x: x.cast("long")
    )
    start = F.struct(
        F.lit(0).cast("long").alias("ref"),
        F.lit(0).cast("long").alias("read"),
        F.array().cast("array<struct<op:string,ref:bigint,read:bigint,n:bigint>>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        op, n = x["op"], x["n"]
        on_ref = op.isin("M", "D", "N", "=", "X")
        on_read = op.isin("M", "I", "S", "=", "X")
        piece = F.struct(op.alias("op"), acc["ref"].alias("ref"), acc["read"].alias("read"), n.alias("n"))
        return F.struct(
            (acc["ref"] + F.when(on_ref, n).otherwise(0)).alias("ref"),
            (acc["read"] + F.when(on_read, n).otherwise(0)).alias("read"),
            F.concat(acc["out"], F.array(piece)).alias("out"),
        )

    pairs = F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("op"), n.alias("n")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def read_blocks(reads: DataFrame, *, skip_flags: int = NOT_PILED, count_deletions: bool = False) -> DataFrame:
    """Half-open reference blocks under each read: aligned pieces, deletions on request."""
    wanted = ["M", "=", "X"] + (["D"] if count_deletions else [])
    base = F.col("pos") - 1
    return (
        reads.where(F.col("flag").bitwiseAND(F.lit(skip_flags)) == 0)
        .withColumn("_s", F.explode(F.filter(_steps(F.col("cigar")), lambda s: s["op"].isin(*wanted))))
        .select(
            F.col("rname").alias("chrom"),
            (base + F.col("_s.ref")).alias("start"),
            (base + F.col("_s.ref") + F.col("_s.n")).alias("stop"),
            base.alias("read_start"),
            *[c for c in reads.columns if c not in ("rname", "pos", "start", "stop", "seq", "qual")],
        )
    )


def base_calls(reads: DataFrame, *, skip_flags: int = NOT_PILED, min_quality: int = 15) -> DataFrame:
    """One row per aligned A/C/G/T base of sufficient quality (chrom, pos 0-based, base).

    For base-quality filters and base composition only; depth uses blocks. Sequence and
    quality are ASCII, so a base is a byte: taking one as a character counts all those before it.
    """
    steps = F.filter(_steps(F.col("cigar")), lambda s: s["op"].isin("M", "=", "X"))
    spots = (
        reads.where(F.col("flag").bitwiseAND(F.lit(skip_flags)) == 0)
        .withColumn("_s", F.explode(steps))
        .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_s.n") - 1)))
    )
    at = (F.col("_s.read") + F.col("_i") + 1).cast("int")
    base, quality = (F.substring(F.col(c).cast("binary"), at, F.lit(1)) for c in ("seq", "qual"))
    good = base.isin(*[F.lit(b.encode()) for b in "ACGTacgt"]) & (quality >= F.lit(bytes([33 + min_quality])))
    return spots.where(good).select(
        F.col("rname").alias("chrom"),
        (F.col("pos") - 1 + F.col("_s.ref") + F.col("_i")).alias("pos"),
        F.upper(base.cast("string")).alias("base"),
        (F.ascii(quality.cast("string")) - 33).alias("base_quality"),
        "qname",
        "flag",
    )


def base_depth_of_calls(reads: DataFrame, *, skip_flags: int = NOT_PILED, min_quality: int = 15) -> DataFrame:
    """Good bases per position (chrom, pos, depth); positions without any are left out.

    Reads are ranged by position first, so that a task meets all bases of most of its
    positions and about one row per position is shuffled; a pile-up is cut by read name.
    """
    near = reads.select("rname", "pos", "flag", "cigar", "seq", "qual", "qname").repartitionByRange("rname", "pos", "qname")
    calls = base_calls(near, skip_flags=skip_flags, min_quality=min_quality)
    return calls.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("depth"))
