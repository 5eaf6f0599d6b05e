"""Peaks of long traces: prominence, width and thinning, without one task per trace.

A trace is cut into blocks of ``FAN`` positions, blocks into blocks of ``FAN`` blocks and so
on. A search for the nearest row that is high (or low) enough looks at its own block first,
climbs to wider blocks until one holds such a row, and goes down again to the row; each step
is one equi-join with arrays of at most ``FAN`` summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.running import running
from strandwise.functions.stages import cut

#: Positions in a block, and blocks in a wider block.
FAN = 256
#: Positions whose peaks one task thins at once.
SPAN = 1 << 16


def levels(signal: DataFrame, keys: Sequence[str], fan: int = FAN) -> list[DataFrame]:
    """``(keys, grp, nodes)`` from rows up to whole traces; a node is (at, low, first, last, top).

    ``at`` is a position, or a block's number; ``low`` stands at ``first`` to ``last``, ``top`` is the highest value.
    """
    keys = list(keys)
    x = F.col("intensity").cast("double")
    nodes = signal.where(F.col("pos").isNotNull() & x.isNotNull()).select(
        *keys, F.col("pos").alias("at"), x.alias("low"), F.col("pos").alias("first"), F.col("pos").alias("last"), x.alias("top"))
    ends = nodes.agg(F.min("at").alias("a"), F.max("at").alias("z")).first()
    out = []
    if ends.a is None:
        return out
    low, high = ends.a, ends.z
    while True:
        low, high = low // fan, high // fan
        node = F.struct("at", "low", "first", "last", "top")
        grouped = cut(nodes.groupBy(*keys, F.floor(F.col("at") / fan).alias("grp")).agg(F.array_sort(F.collect_list(node)).alias("nodes")))
        out.append(grouped)
        if low == high:
            return out
        least = F.array_min(F.transform("nodes", lambda n: n["low"]))
        at_least = F.filter("nodes", lambda n: n["low"] == F.col("_least"))
        nodes = grouped.withColumn("_least", least).withColumn("_lows", at_least).select(
            *keys, F.col("grp").alias("at"), F.col("_least").alias("low"), F.get("_lows", F.lit(0))["first"].alias("first"),
            F.element_at("_lows", -1)["last"].alias("last"), F.array_max(F.transform("nodes", lambda n: n["top"])).alias("top"))


def nearest(
    wanted: DataFrame, tree: list[DataFrame], keys: Sequence[str], hit: Callable[[Column], Column], fan: int = FAN
) -> DataFrame:
    """``wanted`` (keys, pos, side -1 or 1, further columns) with ``found`` and ``least``.

    ``found`` is the position of the nearest row on that side whose node is a ``hit`` (null: none),
    ``least`` the smallest value strictly between and its distance, nearest first (null: no row between).
    """
    keys = list(keys)
    side, names = F.col("side"), wanted.columns
    least_type = "struct<value:double,far:bigint>"
    state = [*names, "_at", "_least"]

    def look(rows: DataFrame, level: int, grp: Column, inside: bool) -> DataFrame:
        """One level: with ``inside`` all of the block, else what lies beyond ``_at`` in it."""
        block = tree[level].select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("grp").alias("_grp"), F.col("nodes").alias("_nodes"))
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        joined = rows.withColumn("_in", grp).join(block, [*same, F.col("_in") == F.col("_grp")], "left")
        beyond = F.col("_nodes") if inside else F.filter("_nodes", lambda n: (n["at"] - F.col("_at")) * side > 0)
        joined = joined.withColumn("_beyond", F.coalesce(beyond, F.array().cast(tree[level].schema["nodes"].dataType)))
        hits = F.filter("_beyond", hit)
        joined = joined.withColumn("_hit", F.when(side < 0, F.get(hits, F.size(hits) - 1)).otherwise(F.get(hits, F.lit(0)))["at"])
        between = F.filter("_beyond", lambda n: F.col("_hit").isNull() | ((n["at"] - F.col("_hit")) * side < 0))
        near = F.transform(between, lambda n: F.struct(
            n["low"].alias("value"), F.abs(F.when(side < 0, n["last"]).otherwise(n["first"]) - F.col("pos")).cast("long").alias("far")))
        return joined.withColumn("_least", F.least(F.col("_least"), F.array_min(near).cast(least_type)))

    up = wanted.withColumn("_at", F.col("pos")).withColumn("_least", F.lit(None).cast(least_type))
    waiting: list[DataFrame] = []
    done: list[DataFrame] = []
    for level in range(len(tree)):
        seen = cut(look(up, level, F.floor(F.col("_at") / fan), inside=False).select(*state, "_hit"))
        waiting.append(seen.where("_hit is not null").select(*names, F.col("_hit").alias("_at"), "_least"))
        up = seen.where("_hit is null").select(*names, F.floor(F.col("_at") / fan).alias("_at"), "_least")
    done.append(up.withColumn("_at", F.lit(None).cast("long")))
    down = None
    for level in range(len(tree) - 1, -1, -1):
        here = waiting[level] if down is None else waiting[level].unionByName(down)
        if level:
            down = cut(look(here, level - 1, F.col("_at"), inside=True).select(*names, F.col("_hit").alias("_at"), "_least"))
        else:
            done.append(here)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*names, F.col("_at").alias("found"), F.col("_least").alias("least"))


def peak_shape(peaks: DataFrame, signal: DataFrame, keys: Sequence[str] = ("sample",), rel_height: float = 0.5, fan: int = FAN) -> DataFrame:
    """``peaks`` (keys, pos, height) with ``prominence``, ``left_base``, ``right_base``, ``width``, ``left_ip``, ``right_ip``.

    On each side the lowest value before the next higher one (or the trace's end) is the
    base, the nearest of equal ones; the prominence is the height over the higher base. The
    width is taken at ``height - prominence * rel_height``, in positions, on straight lines
    between rows. Rows without a position or value stand in no trace; a peak must be a row
    of its trace or lie on a flat top of it.
    """
    if not 0 < rel_height <= 1:
        raise ValueError("rel_height must be over 0 and at most 1")
    keys = list(keys)
    tree = levels(signal, keys, fan)
    if not tree:
        empty = {c: F.lit(None).cast("long" if c.endswith("base") else "double") for c in ("prominence", "left_base", "right_base", "width", "left_ip", "right_ip")}
        return peaks.withColumns(empty).limit(0)
    own = [*keys, "pos", "height"]
    sides = peaks.select(*own, F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"))
    bases = nearest(sides, tree, keys, lambda n: n["top"] > F.col("height"), fan)
    base = F.least(F.struct(F.col("height").cast("double").alias("value"), F.lit(0).cast("long").alias("far")), F.col("least"))
    bases = bases.withColumn("_base", base)

    def at(name: int, value: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(value)))

    deep = cut(bases.groupBy(*own).agg(
        (F.col("height") - F.greatest(at(-1, "_base.value"), at(1, "_base.value"))).alias("prominence"),
        (F.col("pos") - at(-1, "_base.far")).alias("left_base"), (F.col("pos") + at(1, "_base.far")).alias("right_base")))
    sides = deep.select(
        *own, F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"),
        (F.col("height") - F.col("prominence") * rel_height).alias("_level"))
    crossing = nearest(sides, tree, keys, lambda n: n["low"] <= F.col("_level"), fan).drop("least")
    x = F.col("intensity").cast("double")
    rows = running(
        signal.where(x.isNotNull()).select(*keys, F.col("pos"), x.alias("_x")), keys, "pos", block=100_000,
        lags={"_before": F.struct("pos", "_x")}, leads={"_after": F.struct("pos", "_x")})
    rows = rows.select(*keys, F.col("pos").alias("found"), "_x", "_before", "_after")
    inner = F.when(F.col("side") < 0, F.col("_after")).otherwise(F.col("_before"))
    gap = (F.col("_level") - F.col("_x")) / (inner["_x"] - F.col("_x")) * (inner["pos"] - F.col("found"))
    crossing = crossing.join(rows, [*keys, "found"]).withColumn(
        "_ip", F.col("found") + F.when(F.col("_x") < F.col("_level"), gap).otherwise(F.lit(0.0)))
    wide = crossing.groupBy(*own).agg(at(-1, "_ip").alias("left_ip"), at(1, "_ip").alias("right_ip"))
    same = deep.join(wide, own).withColumn("width", F.col("right_ip") - F.col("left_ip"))
    return peaks.join(same, own).select(*peaks.columns, "prominence", "left_base", "right_base", "width", "left_ip", "right_ip")


def thin(peaks: DataFrame, keys: Sequence[str], distance: int, span: int = SPAN) -> DataFrame:
    """Drop peaks closer than ``distance`` to a higher kept one (equal: the later wins).

    Each round cuts traces into blocks of ``span`` positions; a block's task sees the peaks
    within ``distance`` of its ends too. A peak is dropped beside a kept one and kept when
    no higher one near it is undecided; only what waits for another block goes on, and the
    next round cuts elsewhere. A long chain of close peaks so spreads over many tasks. Of
    two rows of one trace at one position the one that comes first in order stays.
    """
    keys = list(keys)
    rows = cut(peaks.withColumn("_kept", F.lit(None).cast("boolean")).withColumn("_id", F.monotonically_increasing_id()))
    span, turn = max(span, 4 * distance), 0
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["pos", "_id"])
        pos, height, own = pdf["pos"].to_numpy(), pdf["height"].to_numpy(), (pdf["_b"] == pdf["_own"]).to_numpy()
        kept = np.array([k is True or k == 1 for k in pdf["_kept"]])
        open_ = pdf["_kept"].isna().to_numpy()
        low, high = np.searchsorted(pos, pos - distance, "right"), np.searchsorted(pos, pos + distance, "left")
        for i in np.lexsort((np.arange(len(pos)), height))[::-1]:
            if open_[i] and own[i]:
                near = slice(low[i], high[i])
                if kept[near].any():
                    open_[i] = False
                elif not (open_[near] & ((height[near] > height[i]) | ((height[near] == height[i]) & (np.arange(low[i], high[i]) > i)))).any():
                    kept[i], open_[i] = True, False
        out = pdf.assign(_kept=pd.array(np.where(open_, None, kept), dtype="boolean"))
        return out[own].drop(columns=["_b", "_own"])

    while True:
        shift = (turn % 2) * (span // 2)
        block = lambda p: F.floor((p + shift) / span)
        blocks = F.array_distinct(F.array(block(F.col("pos")), block(F.col("pos") - distance), block(F.col("pos") + distance)))
        spread = rows.where("_kept is null or _kept").withColumn("_own", block(F.col("pos"))).withColumn("_b", F.explode(blocks))
        rows = cut(spread.groupBy(*keys, "_b").applyInPandas(decide, fields))
        if rows.where("_kept is null").limit(1).count() == 0:
            return rows.where("_kept").select(*peaks.columns)
        turn += 1
