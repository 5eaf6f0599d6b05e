"""Small column expressions used in several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> Column:
    """Column whose name holds brackets, dots or comparison signs."""
    return F.col(f"`{name}`")


def round_even(x: Column, digits: int) -> Column:
    """Round half to even the way numpy does: scale, rint, scale back."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """num / den as double, null on a zero denominator, rounded half to even."""
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return r if digits is None else round_even(r, digits)


def one_of(value: Column, *options: str) -> Column:
    return value.isin(*options)
