"""Base text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandwise.functions.columns import col


def complement(seq: str | Column) -> Column:
    return F.translate(col(seq), "ACGTacgt", "TGCAtgca")


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(complement(seq))
