"""Variant files as text: long calls in, INFO fields out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.operators.intervals import contig_order

_LONG = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "var_type")


def parse_vcf(lines: DataFrame, samples: Sequence[str] | Column) -> DataFrame:
    """Text lines ``value`` → one row per site x sample.

    Columns: chrom, pos, id, ref, alt array, qual, filter array (null for '.'),
    info map, var_type, sample, gt, ad array (null when uncalled), dp, ps and the
    remaining FORMAT fields as a map.  ``samples`` are the header's sample names,
    or a column of ``lines`` that holds them.
    """
    names = samples if isinstance(samples, Column) else F.array(*[F.lit(s) for s in samples])
    cols = F.split("value", "\t")
    alt = F.split(cols[4], ",")
    snp = (F.length(cols[3]) == 1) & F.forall(alt, lambda a: (F.length(a) == 1) & (a != "*"))
    rows = lines.where(~F.col("value").startswith("#")).select(
        cols[0].alias("chrom"),
        cols[1].cast("long").alias("pos"),
        F.nullif(cols[2], F.lit(".")).alias("id"),
        cols[3].alias("ref"),
        alt.alias("alt"),
        F.nullif(cols[5], F.lit(".")).try_cast("double").alias("qual"),
        F.when(cols[6] != ".", F.split(cols[6], ";")).alias("filter"),
        F.str_to_map(cols[7], F.lit(";"), F.lit("=")).alias("info"),
        F.when(snp, "snp").otherwise("indel").alias("var_type"),
        F.split(F.get(cols, F.lit(8)), ":").alias("_format"),
        F.slice(cols, F.lit(10), F.size(names)).alias("_cells"),
        names.alias("_names"),
    )
    long = rows.select(*_LONG, "_format", "_names", F.posexplode("_cells").alias("_i", "_cell"))
    cells = F.split("_cell", ":")
    # trailing fields may be left out of a cell
    fields = F.map_from_arrays(F.slice("_format", F.lit(1), F.least(F.size("_format"), F.size(cells))), F.slice(cells, F.lit(1), F.least(F.size("_format"), F.size(cells))))
    long = long.select(*_LONG, F.get("_names", F.col("_i")).alias("sample"), fields.alias("format"))

    def field(name: str) -> Column:
        return F.nullif(F.try_element_at("format", F.lit(name)), F.lit("."))

    ad = F.transform(F.split(field("AD"), ","), lambda x: x.try_cast("long"))
    return long.select(
        *_LONG,
        "sample",
        F.coalesce(F.try_element_at("format", F.lit("GT")), F.lit("./.")).alias("gt"),
        F.when(F.forall(ad, lambda x: x.isNotNull()), ad).alias("ad"),
        field("DP").try_cast("long").alias("dp"),
        field("PS").alias("ps"),
        "format",
    )


def read_vcf(spark: SparkSession, path: str | list[str], samples: Sequence[str] | None = None) -> DataFrame:
    """Long calls of one or many files; each file's genotypes go to the names in its own header."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    if samples is not None:
        return parse_vcf(lines, samples)
    cells = F.split("value", "\t")
    heads = lines.where(F.col("value").startswith("#CHROM")).groupBy("_file").agg(
        F.min(F.slice(cells, F.lit(10), F.greatest(F.size(cells) - 9, F.lit(0)))).alias("_samples")
    )
    return parse_vcf(lines.join(heads, "_file"), F.col("_samples"))


def read_sv_sites(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Structural variant records with the sample taken from the header."""
    return read_vcf(spark, path).select("chrom", "pos", "info", "sample")


def add_info(sites: DataFrame, name: str, value: Column) -> DataFrame:
    """Record lines with ``name=value`` appended to the INFO text."""
    added = F.concat(F.lit(f"{name}="), value)
    info = F.when(F.col("info").isNull() | (F.col("info") == "."), added).otherwise(F.concat_ws(";", "info", added))
    return sites.withColumn("info", info)


def vcf_lines(sites: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(chrom, pos, id, ref, alt, qual, filter, info text …) → text lines."""
    cells = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", *extra]
    return sites.select(
        F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in cells]).alias("value")
    )


def headed(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """Text lines with the header lines first in every part file, so that each part is a file of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                begun = True
                yield pa.record_batch([pa.array(header, batch.schema.types[0])], schema=batch.schema)
            yield batch

    return lines.select("value").mapInArrow(run, "value string")


def info_header(header: Sequence[str], name: str) -> list[str]:
    """The header with a line for the new field, before the column names."""
    line = f'##INFO=<ID={name},Number=.,Type=String,Description="{name}">'
    at = next((i for i, h in enumerate(header) if h.startswith("#CHROM")), len(header))
    return list(header) if line in header else [*header[:at], line, *header[at:]]


def write_vcf_info(
    sites: DataFrame, header: Sequence[str], name: str, value: Column, path: str, mode: str = "error"
) -> None:
    """Records with the added field in contig and position order; every part begins with the header."""
    order = [F.coalesce(contig_order("chrom"), F.lit(99)), F.col("chrom"), F.col("pos")]
    rows = add_info(sites, name, value).repartitionByRange(*order).sortWithinPartitions(*order)
    headed(vcf_lines(rows), info_header(header, name)).write.mode(mode).text(path)
