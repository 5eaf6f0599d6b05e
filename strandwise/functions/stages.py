"""Cutting a plan that would otherwise be planned again for every use, and folders for files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only on a local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return folder


def new_folder(spark: SparkSession) -> str:
    """A name below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/strandwise-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there.

    For small intermediate tables that several later steps read, and for loops.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
