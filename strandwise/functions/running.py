"""Running aggregates over long ordered series, without one task per key.

A plain window ``partition by chrom order by pos`` puts a whole contig, which
may be a third of the data, into one task.  Here the series is cut into blocks
of a fixed coordinate width.  Each block is summarised (one row per block), the
summaries are scanned per key (at most contig length / width rows), and the
carry is joined back, so that the row-level window runs per (key, block).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    block: int = BLOCK,
    *,
    sums: Mapping[str, Column] | None = None,
    prior_max: Mapping[str, Column] | None = None,
    fills: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    keep_block: bool = False,
    keep_unknown: bool = False,
) -> DataFrame:
    """Add running columns to ``df``, whose rows are unique per (keys, order).

    sums: running total up to and including the row.  prior_max: maximum over the
    rows before it.  fills: last non-null value up to and including the row.
    leads / lags: the value on the next / previous row.  ``keep_block`` leaves the
    block number in, so that a second call over the same order shuffles nothing.
    Rows without a key or an order stand in no series and are dropped; ``keep_unknown``
    keeps them, with null in the new columns.
    """
    keys = list(keys)
    sums, prior_max, fills = dict(sums or {}), dict(prior_max or {}), dict(fills or {})
    leads, lags = dict(leads or {}), dict(lags or {})
    pos = F.col(order)
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, order]])
    # Stated here and joined from the left: both uses of the rows then have the same
    # filters, so the shuffle below them is planned once and reused.
    rows = df if "_block" in df.columns else df.where(known).withColumn(
        "_block", F.floor(pos / F.lit(block))
    )

    totals = []
    for name, expr in sums.items():
        totals.append(F.sum(expr).alias(f"_in_{name}"))
    for name, expr in prior_max.items():
        totals.append(F.max(expr).alias(f"_in_{name}"))
    for name, expr in fills.items():
        totals.append(F.max_by(expr, F.when(expr.isNotNull(), pos)).alias(f"_in_{name}"))
    for name, expr in leads.items():
        totals.append(F.min_by(expr, pos).alias(f"_in_{name}"))
    for name, expr in lags.items():
        totals.append(F.max_by(expr, pos).alias(f"_in_{name}"))
    blocks = rows.groupBy(*keys, "_block").agg(*totals)

    over = Window.partitionBy(*keys).orderBy("_block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carries = []
    for name in sums:
        carries.append(F.sum(f"_in_{name}").over(before))
    for name in prior_max:
        carries.append(F.max(f"_in_{name}").over(before))
    for name in fills:
        carries.append(F.last(f"_in_{name}", ignorenulls=True).over(before))
    for name in leads:
        carries.append(F.lead(f"_in_{name}").over(over))
    for name in lags:
        carries.append(F.lag(f"_in_{name}").over(over))
    names = [*sums, *prior_max, *fills, *leads, *lags]
    carry = blocks.select(
        *keys, "_block", *[c.alias(f"_carry_{n}") for n, c in zip(names, carries)]
    )

    inner = Window.partitionBy(*keys, "_block").orderBy(order)
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    earlier = inner.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, expr in sums.items():
        out[name] = F.coalesce(F.col(f"_carry_{name}"), F.lit(0)) + F.sum(expr).over(so_far)
    for name, expr in prior_max.items():
        out[name] = F.greatest(F.col(f"_carry_{name}"), F.max(expr).over(earlier))
    for name, expr in fills.items():
        out[name] = F.coalesce(
            F.last(expr, ignorenulls=True).over(so_far), F.col(f"_carry_{name}")
        )
    for name, expr in leads.items():
        out[name] = F.coalesce(F.lead(expr).over(inner), F.col(f"_carry_{name}"))
    for name, expr in lags.items():
        out[name] = F.coalesce(F.lag(expr).over(inner), F.col(f"_carry_{name}"))
    joined = rows.join(carry, [*keys, "_block"], "left")
    kept = [c for c in rows.columns if keep_block or c != "_block"]
    found = joined.select(*kept, *[c.alias(n) for n, c in out.items()])
    if keep_unknown:
        found = found.unionByName(df.where(~known), allowMissingColumns=True)
    return found


def sweep(
    layers: Mapping[str, DataFrame],
    keys: Sequence[str] = ("chrom",),
    *,
    weights: Mapping[str, Column] | None = None,
    marks: DataFrame | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Piecewise-constant cover of several interval sets over the same axis.

    Returns runs ``(keys, start, stop, <layer>…)`` with one cover column per
    layer (the number of intervals, or the summed weight).  ``marks`` holds extra
    positions ``(keys, pos)`` at which a run must begin.  Each interval becomes
    two events that are summed per position on the map side, so a pile-up at one
    locus shrinks to one row before it is shuffled; layers of one DataFrame share them.
    """
    keys, weights = list(keys), dict(weights or {})
    names = list(layers)
    sources: list[tuple[DataFrame, list[str]]] = []
    for name, df in layers.items():
        same = [mine for other, mine in sources if other is df]
        if same:
            same[0].append(name)
        else:
            sources.append((df, [name]))
    events = None
    for df, mine in sources:
        w = {n: weights.get(n, F.lit(1).cast("long")) for n in mine}

        def end(side: str, change: dict[str, Column]) -> Column:
            return F.struct(F.col(side).cast("long").alias("pos"), *[c.alias(n) for n, c in change.items()])

        here = df.where(F.col("start") < F.col("stop")).select(
            *keys, F.explode(F.array(end("start", w), end("stop", {n: -c for n, c in w.items()}))).alias("e")
        )
        part = here.select(
            *keys, "e.pos", *[(F.col(f"e.{n}") if n in mine else F.lit(0)).alias(n) for n in names]
        )
        events = part if events is None else events.unionByName(part)
    if marks is not None:
        events = events.unionByName(
            marks.select(*keys, F.col("pos").cast("long"), *[F.lit(0).alias(n) for n in names])
        )
    events = events.groupBy(*keys, "pos").agg(*[F.sum(n).alias(n) for n in names])
    if marks is None:
        events = events.where(reduce(or_, [F.col(n) != 0 for n in names]))
    runs = running(
        events.withColumnsRenamed({n: f"_d_{n}" for n in names}),
        keys,
        "pos",
        block,
        sums={n: F.col(f"_d_{n}") for n in names},
        leads={"stop": F.col("pos")},
    )
    return runs.select(*keys, F.col("pos").alias("start"), "stop", *names)
