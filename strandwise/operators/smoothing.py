"""Robust local regression over any number of distinct values, and how well it explains them.

A fit at x weighs the nearest ``fraction`` of all rows by the tricube of their distance over the
distance of the farthest of them.  Both steps avoid windows over a whole series:

*Radius.*  In order of x, the k nearest rows are ranks l .. l + k - 1, where l is the first rank
whose midpoint with rank l + k is not below x.  So midpoints come from merging the ranks with
themselves shifted by k, and the midpoint of an x from merging both in order of value.

*Line.*  The tricube is a polynomial of degree 9 on each side of x, so a node of a tree over the
sorted values serves every x that has it wholly on one side and within reach, by twelve moments
about the node's own centre.  Blocks of values descend the tree together; only leaves that an x or
a window's end cuts are read value by value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions.columns import round_even
from strandwise.functions.quantiles import exact_quantiles
from strandwise.functions.ranks import parted, ranked
from strandwise.functions.running import running
from strandwise.functions.stages import cut

LEAF, FAN, DEGREE = 256, 16, 11
#: Blocks of values that one task takes through a level; few bytes, so that Spark would give a task many times as many.
BLOCKS_A_TASK, MOST_TASKS = 16, 2000
_FACTORIALS = np.array([float(factorial(i)) for i in range(DEGREE + 1)])
_PARTS = ("s0", "s1", "s2", "t0", "t1")


def nearest_radius(values: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Distance of the k-th nearest row for every distinct x, itself counted; k = int(fraction * rows), at least 1.

    ``values`` has one row per (keys, x) and its number of rows ``n``; equal values may be any share
    of a key.  Adds ``d`` (rank among the distinct values) and ``radius``.
    """
    keys = list(keys)
    k = F.greatest(F.least(F.floor(F.col("rows") * fraction + 1e-10), F.col("rows")), F.lit(1)).cast("long")
    ranks = cut(ranked(values, keys).withColumn("k", k))

    def shifted(name: str, by: Column) -> DataFrame:
        p = F.col("c") - by
        inside = (p + F.col("n") > 0) & (p <= F.col("rows") - F.col("k"))
        return ranks.where(inside).select(*keys, F.greatest(p, F.lit(0)).alias("p"), F.col("x").alias(name))

    none = F.lit(0).cast("long")
    last = ranks.where("d = 0").select(*keys, (F.col("rows") - F.col("k")).alias("p"), F.lit(float("inf")).alias("_hi"))
    events = shifted("_lo", none)
    for part in (shifted("_hi", F.col("k")), last, shifted("_in", F.col("k") - 1)):
        events = events.unionByName(part, allowMissingColumns=True)
    events = events.groupBy(*keys, "p").agg(*[F.max(c).alias(c) for c in ("_lo", "_hi", "_in")])
    pieces = running(events, keys, "p", fills={"lo": F.col("_lo"), "hi": F.col("_hi"), "far": F.col("_in")})

    merged = pieces.select(
        *keys, ((F.col("lo") + F.col("hi")) / 2).alias("x"), "p", F.struct("lo", "far").alias("_e"), F.lit(None).cast("long").alias("d")
    ).unionByName(ranks.select(*keys, "x", "d"), allowMissingColumns=True)
    merged = parted(merged.groupBy(*keys, "x").agg(F.max("d").alias("d"), F.min_by("_e", "p").alias("_e")), keys, "x")
    # backwards: a frame to the end would be gone through again for every row
    later = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carry = merged.groupBy(*keys, "_part").agg(F.min_by("_e", F.when(F.col("_e").isNotNull(), F.col("x"))).alias("_e")).select(
        *keys, "_part", F.last("_e", ignorenulls=True).over(later).alias("_next")
    )
    ahead = Window.partitionBy(*keys, "_part").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    found = merged.join(carry, [*keys, "_part"]).withColumn(
        "_e", F.coalesce(F.last("_e", ignorenulls=True).over(ahead), F.col("_next"))
    )
    return found.where(F.col("d").isNotNull()).select(
        *keys, "x", "d", F.greatest(F.col("x") - F.col("_e.lo"), F.col("_e.far") - F.col("x")).alias("radius")
    )


def _leaf_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of every leaf about the middle of its range, in units of half the range."""
    for pdf in batches:
        rows = []
        for x, w, wy in zip(pdf["xs"], pdf["ws"], pdf["wys"]):
            mid, half = (x[0] + x[-1]) / 2, (x[-1] - x[0]) / 2
            powers = np.vander((x - mid) / (half or 1.0), DEGREE + 1, increasing=True)
            rows.append((x[0], x[-1], powers.T @ w, powers.T @ wy))
        yield pd.concat([pdf, pd.DataFrame(rows, columns=["lo", "hi", "mw", "my"], index=pdf.index)], axis=1)


def _shift(m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of a + b * u from those of u, for arrays of a and b."""
    # over factorials a shift is a convolution
    pa = np.vander(a, DEGREE + 1, increasing=True) / _FACTORIALS
    pb = np.vander(b, DEGREE + 1, increasing=True) * (m / _FACTORIALS)
    out = np.zeros_like(pa)
    for q in range(DEGREE + 1):
        out[:, q:] += pa[:, : DEGREE + 1 - q] * pb[:, q : q + 1]
    return out * _FACTORIALS


def _joined(keys: list[str]):
    """Function of the at most FAN children of a node -> the node."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["lo"].min(), pdf["hi"].max()
        mid, half = (lo + hi) / 2, (hi - lo) / 2 or 1.0
        a = ((pdf["lo"] + pdf["hi"]) / 2 - mid).to_numpy() / half
        b = (pdf["hi"] - pdf["lo"]).to_numpy() / 2
        b = np.where(b > 0, b, 1.0) / half
        sums = [sum(_shift(m, a[i : i + 1], b[i : i + 1])[0] for i, m in enumerate(pdf[c])) for c in ("mw", "my")]
        row = [*[pdf[c].iloc[0] for c in keys], int(pdf["node"].iloc[0]) // FAN, lo, hi, *sums]
        return pd.DataFrame([row], columns=[*keys, "node", "lo", "hi", "mw", "my"])

    return join


def _served(x: np.ndarray, r: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """Which x have the range wholly on one side and within their radius."""
    return ((lo >= x) | (hi <= x)) & (lo >= x - r) & (hi <= x + r)


def _by_moments(x, r, side, mid, half, mw, my) -> np.ndarray:
    """The five weighted sums of a node for every x, in units of its radius; ``side`` is 1 where the node is above x, else -1."""
    a, b = side * (mid - x) / r, side * half / r
    w, y = _shift(mw, a, b), _shift(my, a, b)

    def weighed(m: np.ndarray, p: int) -> np.ndarray:
        return m[:, p] - 3 * m[:, p + 3] + 3 * m[:, p + 6] - m[:, p + 9]

    return np.stack([weighed(w, 0), side * weighed(w, 1), weighed(w, 2), weighed(y, 0), side * weighed(y, 1)], axis=1)


def _by_values(x, r, xs, ws, wys) -> np.ndarray:
    u = (xs[None, :] - x[:, None]) / r[:, None]
    t = np.maximum(1 - np.abs(u) * u * u, 0.0)  # products: a power of an array is slow
    t = t * t * t
    tu = t * u
    return np.stack([t @ ws, tu @ ws, (tu * u) @ ws, t @ wys, tu @ wys], axis=1)


def _by_far(x, r, side: float, nodes: list[tuple]) -> np.ndarray:
    """The sums of ``nodes`` (``lo, hi, mw, my``) that are all on one side of every x and within reach of it.

    Where the block and the nodes are small beside the radii, the moments are first added up about the block's middle.
    """
    lo, hi = (np.array([n[i] for n in nodes]) for i in (0, 1))
    mid, half = (lo + hi) / 2, np.where(hi > lo, (hi - lo) / 2, 1.0)
    centre, least = (x[0] + x[-1]) / 2, r.min()
    unit = max(np.abs(lo - centre).max(), np.abs(hi - centre).max())
    if len(nodes) > 1 and unit > 0 and unit <= 1.25 * least and x[-1] - x[0] <= 0.5 * least:
        # of a single value only the first moment is not zero, so that its unit plays no part
        mw, my = (_shift(np.stack([n[i] for n in nodes]), (mid - centre) / unit, half / unit).sum(axis=0) for i in (2, 3))
        return _by_moments(x, r, side, centre, unit, mw, my)
    return sum(_by_moments(x, r, side, m, h, n[2], n[3]) for m, h, n in zip(mid, half, nodes))


def _sums(keys: list[str], leaf: bool):
    """Function of (block of x, node) pairs -> sums per x, those of a batch added up."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blocks = {}  # x, radius, sums, which x have any, far nodes by side
            for row in pdf.to_dict("records"):
                name = (*(row[c] for c in keys), row["block"])
                if name not in blocks:
                    x = np.asarray(row["tx"])
                    blocks[name] = x, np.asarray(row["tr"]), np.zeros((len(x), 5)), np.zeros(len(x), bool), {1.0: [], -1.0: []}
                x, r, sums, hit, far = blocks[name]
                lo, hi, up_lo, up_hi = row["lo"], row["hi"], row["up_lo"], row["up_hi"]
                open_ = (r > 0) & (lo < x + r) & (hi > x - r)
                if not np.isnan(up_lo):
                    open_ &= ~_served(x, r, up_lo, up_hi)
                whole = open_ & _served(x, r, lo, hi)
                mw, my = np.asarray(row["mw"]), np.asarray(row["my"])
                if whole.all() and (lo >= x[-1] or hi <= x[0]):
                    far[1.0 if lo >= x[-1] else -1.0].append((lo, hi, mw, my))
                elif whole.any():
                    sums[whole] += _by_moments(
                        x[whole], r[whole], np.where(lo >= x[whole], 1.0, -1.0), (lo + hi) / 2, (hi - lo) / 2 or 1.0, mw, my)
                part = open_ & ~whole
                if leaf and part.any():
                    sums[part] += _by_values(x[part], r[part], *(np.asarray(row[c]) for c in ("xs", "ws", "wys")))
                hit |= open_ if leaf else whole
            names, places, values = [], [], []
            for name, (x, r, sums, hit, far) in blocks.items():
                for side, nodes in far.items():
                    if nodes:
                        sums += _by_far(x, r, side, nodes)
                at = np.flatnonzero(hit)
                names += [name[:-1]] * len(at)
                places.append(name[-1] * LEAF + at)
                values.append(sums[at])
            if names:
                frame = pd.DataFrame(names, columns=keys)
                frame["d"] = np.concatenate(places)
                frame[list(_PARTS)] = np.concatenate(values)
                yield frame

    return add


def _cut_by(keys: list[str]):
    """Function of (block of x, node) pairs -> those in which some x needs the node's children."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = zip(pdf["tx"], pdf["tr"], pdf["lo"], pdf["hi"])
            yield pdf[[bool(((r > 0) & (lo < x + r) & (hi > x - r) & ~_served(x, r, lo, hi)).any()) for x, r, lo, hi in rows]]

    return keep


def _arrays(df: DataFrame, keys: list[str], name: str, **columns: str) -> DataFrame:
    """One row per leaf of LEAF values, its columns as arrays in order."""
    rows = F.array_sort(F.collect_list(F.struct("d", *columns)))
    packed = df.groupBy(*keys, F.floor(F.col("d") / LEAF).cast("long").alias(name)).agg(rows.alias("_r"))
    return packed.select(*keys, name, *[F.col(f"_r.{c}").alias(a) for c, a in columns.items()])


def _lines(points: DataFrame, sums: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """Fit at every point; ``sums`` has w and wy per (keys, x, d)."""
    kinds = {n: t for n, t in points.dtypes}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    moments = "lo double, hi double, mw array<double>, my array<double>"
    packed = _arrays(sums, keys, "node", x="xs", w="ws", wy="wys")
    leaves = cut(packed.mapInPandas(
        _leaf_moments, f"{head}, node long, xs array<double>, ws array<double>, wys array<double>, {moments}"
    ))
    levels = [leaves]
    tasks = min(MOST_TASKS, leaves.count() // BLOCKS_A_TASK + 1)
    for _ in range(depth):
        below = levels[-1].select(*keys, "node", "lo", "hi", "mw", "my", F.floor(F.col("node") / FAN).alias("_up"))
        up = below.repartition(tasks, *keys, "_up").groupBy(*keys, "_up").applyInPandas(
            _joined(keys), f"{head}, node long, {moments}"
        )
        levels.append(cut(up))
    blocks = _arrays(points, keys, "block", x="tx", radius="tr")
    no_range = F.lit(float("nan"))
    pairs = blocks.join(levels[-1], keys).withColumn("up_lo", no_range).withColumn("up_hi", no_range).repartition(tasks, *keys, "block", "node")
    out = None
    for level in range(depth, -1, -1):
        part = pairs.mapInPandas(_sums(keys, level == 0), f"{head}, d long, " + ", ".join(f"{c} double" for c in _PARTS))
        out = part if out is None else out.unionByName(part)
        if level:
            going = pairs.select(*keys, "block", "tx", "tr", "node", "lo", "hi")
            going = going.mapInPandas(_cut_by(keys), going.schema).select(
                *keys, "block", "tx", "tr", F.col("node").alias("_up"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi")
            )
            children = levels[level - 1].withColumn("_up", F.floor(F.col("node") / FAN)).repartition(tasks, *keys, "_up")
            pairs = going.repartition(tasks, *keys, "_up").join(children.hint("merge"), [*keys, "_up"]).drop("_up")
    total = out.groupBy(*keys, "d").agg(*[F.sum(c).alias(c) for c in _PARTS])
    s0, s1, s2, t0, t1 = (F.col(c) for c in _PARTS)
    spread = s2 - s1 * s1 / s0
    slope = F.when(spread > 1e-12 * s0, (t1 - t0 * s1 / s0) / spread).otherwise(0.0)
    line = F.when(s0 > 0, t0 / s0 - slope * s1 / s0)
    own = F.when(F.col("w") > 0, F.col("wy") / F.col("w"))
    return points.join(sums.select(*keys, "d", "w", "wy"), [*keys, "d"]).join(total, [*keys, "d"], "left").select(
        *keys, "x", F.when(F.col("radius") > 0, line).otherwise(own).alias("fit")
    )


def local_fit(
    df: DataFrame, keys: Sequence[str], x: str, y: str, *, fraction: float = 2 / 3, passes: int = 3, name: str = "fit"
) -> DataFrame:
    """Add the robust local regression of ``y`` on ``x`` within each key as column ``name``.

    ``passes`` robust rounds weigh a row by the bisquare of its residual over six median absolute
    residuals; without residuals only exact rows count.  Rows that share x share the fit; where all
    of the k nearest share it, the fit is their mean.  Rows whose key, x or y is null, and whose x or
    y is not finite, take no part and get null.  Column names are free but for those of a leading ``_fit``.
    """
    keys = list(keys)
    places = [f"_fit{i}" for i in range(len(keys))]
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    for c in keys:
        known = known & F.col(c).isNotNull()
    finite = (F.abs(F.col(x).cast("double")) < float("inf")) & (F.abs(F.col(y).cast("double")) < float("inf"))
    rows = cut(df.where(known & finite).select(
        *[F.col(c).alias(p) for c, p in zip(keys, places)],
        (F.col(x).cast("double") + 0.0).alias("x"), F.col(y).cast("double").alias("y"),
    ))
    points = cut(nearest_radius(rows.groupBy(*places, "x").agg(F.count(F.lit(1)).alias("n")), places, fraction))
    most = points.agg(F.max("d")).first()[0]
    if most is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    depth, nodes = 0, most // LEAF + 1
    while nodes > FAN:
        depth, nodes = depth + 1, -(-nodes // FAN)
    weighted = rows.withColumn("w", F.lit(1.0))
    for step in range(passes + 1):
        sums = weighted.groupBy(*places, "x").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy"))
        sums = cut(points.select(*places, "x", "d").join(sums, [*places, "x"]))
        fits = cut(_lines(points, sums, places, depth))
        if step == passes:
            break
        away = rows.join(fits, [*places, "x"]).withColumn("a", F.abs(F.col("y") - F.col("fit")))
        mad = exact_quantiles(away.where(F.col("a").isNotNull()), places, "a", {"mad": 0.5})
        u = F.col("a") / (6 * F.col("mad"))
        bisquare = F.when(F.col("mad") == 0, (F.col("a") == 0).cast("double")).when(u < 1, F.pow(1 - u * u, 2))
        weighted = away.join(mad, places).select(*places, "x", "y", F.coalesce(bisquare, F.lit(0.0)).alias("w"))
    fits = fits.select(*places, F.col("x").alias("_fit_x"), F.col("fit").alias("_fit_y"))
    own = df.withColumn("_fit_x", F.when(known & finite, F.col(x).cast("double") + 0.0))
    for c, p in zip(keys, places):
        own = own.withColumn(p, F.col(c))
    return own.join(fits, [*places, "_fit_x"], "left").select(*[F.col(f"`{c}`") for c in df.columns], F.col("_fit_y").alias(name))


def smoothing_r2(df: DataFrame, keys: Sequence[str], x: str, y: str, **options) -> DataFrame:
    """``r_square`` per key, four digits: the share of the variance of y that its local regression explains.

    Null where y does not vary.
    """
    keys = list(keys)
    fitted = local_fit(df, keys, x, y, name="_fitted", **options).where(F.col("_fitted").isNotNull())
    left = F.sum(F.pow(F.col(y) - F.col("_fitted"), 2))
    spread = F.var_pop(y) * F.count(F.lit(1))
    return fitted.groupBy(*keys).agg(F.when(spread > 0, round_even(1 - left / spread, 4)).alias("r_square"))
