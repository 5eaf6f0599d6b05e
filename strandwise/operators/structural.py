"""Deletions from read pairs, split reads and structural variant calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.columns import ratio
from strandwise.operators.coverage import DUPLICATE, MATE_UNMAPPED, QC_FAIL, SECONDARY, SUPPLEMENTARY, UNMAPPED
from strandwise.operators.coverage import region_depth
from strandwise.operators.intervals import overlap_join

_REJECT = DUPLICATE | QC_FAIL | UNMAPPED | SECONDARY | SUPPLEMENTARY | MATE_UNMAPPED
_KEY = ("sample", "qname", "cnv_name")
#: Fixed value: least share of the deletion's size in the distance of a pair's ends.
MIN_RATE = 0.9


def _has(bits: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(bits)) != 0


def _beside(reads: DataFrame, bps: DataFrame, low: Column, high: Column) -> DataFrame:
    spans = bps.select(
        "chrom", low.alias("start"), high.alias("stop"), "bp_left", "bp_right", "cnv_name"
    )
    return overlap_join(reads, spans).drop("b_start", "b_stop")


def _evidence(reads: DataFrame, bps: DataFrame, extend: int, min_rate: float = MIN_RATE) -> DataFrame:
    """``(sample, qname, cnv_name, kind)`` of the pairs with a read beside a breakpoint.

    ``pair``: the ends lie outside the deletion, about its size apart.  ``left`` and
    ``right``: the mate of a read on that side is clipped towards the breakpoint.
    The catalogue narrows the reads first, their names then narrow the mates, so
    the reads meet their mates in one join whatever the evidence.
    """
    good = reads.where(~_has(_REJECT)).select("sample", "qname", "flag", "chrom", "start", "stop", "cigar")
    sides = F.array(
        F.struct(F.lit("left").alias("side"), (F.col("bp_left") - extend).alias("start"), F.col("bp_left").alias("stop")),
        F.struct(F.lit("right").alias("side"), (F.col("bp_right") - 1).alias("start"), (F.col("bp_right") + extend).alias("stop")),
    )
    spans = bps.select("chrom", "bp_left", "bp_right", "cnv_name", F.explode(sides).alias("s"))
    near = overlap_join(good, spans.select("chrom", "bp_left", "bp_right", "cnv_name", "s.*"))
    near = near.withColumn("_first", _has(64))
    template = ["sample", "qname", "chrom"]
    mates = good.join(near.select(*template).distinct(), template, "left_semi").select(
        *template, F.col("start").alias("m_start"), F.col("stop").alias("m_stop"),
        F.col("cigar").alias("m_cigar"), _has(64).alias("_m_first"),
    )
    size, clipped = F.col("bp_right") - F.col("bp_left"), F.col("m_cigar").contains("S")
    start, stop, m_start, m_stop = (F.col(c) for c in ("start", "stop", "m_start", "m_stop"))
    left, right = F.col("side") == "left", F.col("side") == "right"
    apart = F.when(left & (stop <= F.col("bp_left")) & (m_start + 1 >= F.col("bp_right")), m_start + 1 - stop).when(
        right & (start + 1 >= F.col("bp_right")) & (m_stop <= F.col("bp_left")), start + 1 - m_stop
    )
    kinds = F.array(
        F.when(size / apart >= min_rate, "pair"),
        F.when(left & (m_stop > stop) & (m_stop <= F.col("bp_left")) & clipped, "left"),
        F.when(right & (m_start < start) & (m_start + 1 >= F.col("bp_right")) & clipped, "right"),
    )
    pairs = near.join(mates, template).where(F.col("_first") != F.col("_m_first"))
    return pairs.select(*_KEY, F.explode(F.array_compact(kinds)).alias("kind")).distinct()


def _supported(reads: DataFrame, bps: DataFrame, extend: int) -> DataFrame:
    """Evidence that counts: of the clipped mates those with a clipped secondary or
    supplementary alignment of the template over the opposite breakpoint."""
    extra = reads.where(_has(SECONDARY | SUPPLEMENTARY) & F.col("cigar").rlike("[SH]")).select(
        "sample", "qname", "chrom", "start", "stop"
    )
    over_left = _beside(extra, bps, F.col("bp_left") - 1, F.col("bp_left")).select(*_KEY, F.lit("right").alias("kind"))
    over_right = _beside(extra, bps, F.col("bp_right") - 1, F.col("bp_right")).select(*_KEY, F.lit("left").alias("kind"))
    over = over_left.unionByName(over_right).distinct().withColumn("_over", F.lit(True))
    found = _evidence(reads, bps, extend).join(over, [*_KEY, "kind"], "left")
    return found.where((F.col("kind") == "pair") | F.col("_over")).drop("_over")


def deletion_pairs(reads: DataFrame, bps: DataFrame, extend: int = 350, min_rate: float = MIN_RATE) -> DataFrame:
    """Templates whose two ends lie outside a deletion of about the gap's size.

    ``reads`` (sample, qname, flag, chrom, start, stop, cigar); ``bps`` (chrom,
    bp_left, bp_right, cnv_name).  Rows (sample, qname, cnv_name), distinct.
    """
    return _evidence(reads, bps, extend, min_rate).where("kind = 'pair'").select(*_KEY).distinct()


def deletion_splits(reads: DataFrame, bps: DataFrame, extend: int = 350) -> DataFrame:
    """Templates with a clipped mate on one side and a clipped secondary or
    supplementary alignment over the opposite breakpoint."""
    return _supported(reads, bps, extend).where("kind <> 'pair'").select(*_KEY).distinct()


def breakpoint_call(
    reads: DataFrame, bps: DataFrame, samples: list[str], extend: int = 350
) -> DataFrame:
    """Copy number of every catalogue deletion in every sample of the sheet.

    Ratio = supporting templates over the mean depth of both flanks.
    """
    support = (
        _supported(reads, bps, extend)
        .select(*_KEY)
        .distinct()
        .groupBy("sample", "cnv_name")
        .agg(F.count(F.lit(1)).alias("support_reads_count"))
    )
    flanks = bps.select(
        "chrom",
        "cnv_name",
        F.explode(
            F.array(
                F.struct((F.col("bp_left") - extend).alias("start"), (F.col("bp_left") - 1).alias("stop")),
                F.struct(F.col("bp_right").alias("start"), (F.col("bp_right") + extend).alias("stop")),
            )
        ).alias("f"),
    ).select("chrom", "cnv_name", "f.start", "f.stop")
    piled = reads.where(~_has(UNMAPPED | SECONDARY | QC_FAIL)).withColumn("is_dup", _has(DUPLICATE))
    depth = region_depth(piled, flanks, sample="sample", samples=samples)
    mean = depth.groupBy("sample", "cnv_name").agg((F.sum("mean_depth") * 0.5).alias("mean_reads_count"))
    df = (
        mean.join(support, ["sample", "cnv_name"], "left")
        .withColumn("support_reads_count", F.coalesce("support_reads_count", F.lit(0)).cast("long"))
        .join(bps.drop("chrom", "bp_left", "bp_right"), "cnv_name")
    )
    n, m = F.col("support_reads_count"), F.col("mean_reads_count")
    share = ratio(n, m)
    enough = n >= F.col("thres_support_reads")
    call = (
        F.when(share.isNull() | (m < F.col("thres_mean_reads")), "unknown")
        .when((share < F.col("thres_normal")) & ~enough, "2")
        .when((share >= F.col("thres_hom_del")) & enough, "0")
        .when((share >= F.col("thres_normal")) & enough, "1")
        .otherwise("unknown")
    )
    return df.select(
        "sample", "cnv_name", "mean_reads_count", "support_reads_count", share.alias("ratio"), call.alias("copy_num")
    )


def parse_sv_info(sites: DataFrame) -> DataFrame:
    """Deletion calls off the mitochondrion with pair and split support (missing = 0).

    ``sites`` (chrom, pos, info map, sample).
    """
    info = F.col("info")
    rows = sites.where((info["SVTYPE"] == "DEL") & ~F.col("chrom").contains("chrM"))
    return rows.select(
        "sample",
        "chrom",
        F.col("pos").cast("long").alias("start"),
        F.try_element_at(info, F.lit("END")).cast("long").alias("stop"),
        F.try_element_at(info, F.lit("SVTYPE")).alias("svtype"),
        F.coalesce(F.try_element_at(info, F.lit("PE")).cast("long"), F.lit(0)).alias("pe_support_count"),
        F.coalesce(F.try_element_at(info, F.lit("SR")).cast("long"), F.lit(0)).alias("sr_support_count"),
    )


def filter_sv(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """Hits that reach their catalogue entry's support and overlap limits."""
    limits = catalog.select("cnv_name", "pe_threshold", "sr_threshold", "overlap_rate")
    return hits.join(limits, "cnv_name").where(
        (F.col("pe_support_count") >= F.col("pe_threshold"))
        & (F.col("sr_support_count") >= F.col("sr_threshold"))
        & (F.col("overlap_rate_aim") >= F.col("overlap_rate"))
        & (F.col("overlap_rate_self") >= F.col("overlap_rate"))
    ).select(*hits.columns)
