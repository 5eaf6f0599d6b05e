"""The position layout: same rows as the plain scan, from few folders."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from strandwise.operators.intervals import restrict_regions
from strandwise.sources.layout import fetch_regions, scan_regions, write_by_position

SPAN = 1000


def calls(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "1").when(F.col("id") % 3 == 1, "02").otherwise("X").alias("chrom"),
        (F.col("id") * 7 % 20011 + 1).alias("pos"), F.col("id").alias("_id"),
    )


def test_same_rows_as_the_scan(spark, tmp_path):
    df = calls(spark, 6000).unionByName(spark.createDataFrame([(None, 5, -1), ("1", None, -2), ("1", 5, -3), ("1", 5, -3)], "chrom string, pos long, _id long"))
    path = str(tmp_path / "t")
    write_by_position(df, path, SPAN)
    regions = spark.createDataFrame(
        [("1", 0, 5), ("1", 999, 1000), ("02", 1999, 2003), ("02", 2001, 4100), ("X", 7, 7), ("X", 9, 8), (None, 1, 9), ("2", 0, 9000), ("X", 19000, 90000)],
        "chrom string, start long, stop long",
    )
    want = sorted(map(tuple, restrict_regions(df, regions).collect()))
    for most in (100, 3, 1):
        got = fetch_regions(spark, path, df.schema, regions, SPAN, most)
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == want
    assert fetch_regions(spark, path, df.schema, regions.where("start < 0"), SPAN).count() == 0
    assert spark.read.parquet(path).count() == df.count()


def test_other_folders_are_not_read(spark, tmp_path):
    """Files outside the regions' spans are spoilt: reading one would fail. Work stays as the table grows."""
    regions = spark.createDataFrame([("02", 2500, 3100)], "chrom string, start long, stop long")
    for n in (3000, 30000):
        df, path = calls(spark, n), tmp_path / f"t{n}"
        want = sorted(map(tuple, restrict_regions(df, regions).collect()))
        write_by_position(df, str(path), SPAN)
        kept = 0
        for file in path.rglob("*.parquet"):
            if file.parent.name in ("_span=2", "_span=3") and file.parent.parent.name == "_contig=02":
                kept += 1
            else:
                file.write_bytes(b"spoilt")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        got = fetch_regions(spark, str(path), df.schema, regions, SPAN)
        assert want and sorted(map(tuple, got.collect())) == want
        assert 0 < kept <= 8
    plan = scan_regions(spark, str(path), df.schema, regions, SPAN)._jdf.queryExecution().toString()
    assert "GreaterThan(pos,2500)" in plan and "PartitionFilters: [" in plan


def test_empty_table(spark, tmp_path):
    df = calls(spark, 0)
    write_by_position(df, str(tmp_path / "t"), SPAN)
    regions = spark.createDataFrame([("1", 0, 5)], "chrom string, start long, stop long")
    assert fetch_regions(spark, str(tmp_path / "t"), df.schema, regions, SPAN).collect() == []
