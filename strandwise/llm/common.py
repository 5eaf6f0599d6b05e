"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Scratch folders named so far by this process.
FOLDERS: list[str] = []


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def keyed(docs: DataFrame) -> DataFrame:
    """``_key``, 128 bits of hashes of the whole row, and ``_in``, the row; equal rows share a key."""
    cols = docs.columns
    key = F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols, F.lit(2)).alias("b"))
    return docs.select(key.alias("_key"), F.struct(*cols).alias("_in"))


def once(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of ``docs`` beside the rows of ``plan`` with their ``_key``: ``_in`` and the plan's columns.

    ``plan`` has ``_key`` and ``_n``, the number of rows of ``docs`` with that key; equal rows
    stand there one time for the join. The rows are shuffled once, unsorted, and never written.
    """
    single, equal = written(plan.where("_n = 1")), written(plan.where("_n > 1"))
    rows = keyed(docs).join(single.hint("shuffle_hash"), "_key")
    first = keyed(docs).join(equal.select("_key").distinct(), "_key").dropDuplicates(["_key"])
    return rows.unionByName(first.join(equal, "_key")).drop("_key", "_n")


def scratch(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    FOLDERS.append(f"{root.rstrip('/')}/strandwise-{uuid.uuid4().hex}")
    return FOLDERS[-1]


def discard(folders: list[str]) -> None:
    """Delete scratch folders that nothing will read again."""
    from strandwise.llm.store import opened

    for folder in folders:
        fs, path = opened(folder)
        if fs.get_file_info(path).type.name == "Directory":
            fs.delete_dir(path)


#: Spark then drops a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that go to a Python worker, and come back, at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, folder: str | None = None, batch: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs no recomputation.

    The shuffle files behind it go at once, as nothing reads them again. ``batch`` rows with
    whole texts at once keep the memory of executors and their Python workers low.
    """
    spark = df.sparkSession
    path, before, rows = folder or scratch(spark), spark.conf.get(CLEANUP, "false"), spark.conf.get(BATCH)
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH, rows if batch is None else str(batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
        spark.conf.set(BATCH, rows)
    return spark.read.schema(df.schema).parquet(path)
