"""The arc of a series whose mean differs most from the rest, and how likely chance makes one.

With ``B`` the running sum of a segment's deviations from its mean, the arc of rows
``j1 + 1`` to ``j2`` of ``n`` has the statistic ``(B[j2] - B[j1])^2 n / (k (n - k))``,
``k = j2 - j1``. The largest over all arcs is found without looking at all of them: rows
stand in blocks that know the range of ``B``; a pair of blocks bounds its arcs by ranges and
distance, pairs of wide blocks are opened only while their bound beats the best arc known,
and only pairs of blocks that are still open at the end are compared row by row. An arc that
ends a segment says the same as the rest before it, so ``j2`` stays below ``n``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.stages import cut

#: Rows in a block, and narrower blocks in a wider one.
ROWS, FAN = 128, 8
#: Segments of so many rows at most are tested by permutation; longer ones by the tail of the maximum over Gaussian noise.
PERMUTED = 256
#: Permutations of a segment, when none of the stops comes before.
PERMUTATIONS = 1000


def plain_arc(b: np.ndarray, width: int) -> tuple[float, int, int]:
    """(statistic, j1, j2) of the best arc of at least ``width`` rows with as many outside; ``b`` has a zero first. (-1, 0, 0): none."""
    n = len(b) - 1
    if n < 2 * width:
        return -1.0, 0, 0
    b = b[:-1]
    z = (b[None, :] - b[:, None]) ** 2 * _weights(n, width)
    at = int(np.argmax(z))
    return float(z.flat[at]), *divmod(at, n)


_kept: dict[tuple[int, int], np.ndarray] = {}


def _weights(n: int, width: int) -> np.ndarray:
    """n / (k (n - k)) for each pair of ends, 0 where the arc is too short or too long."""
    if (n, width) not in _kept:
        if len(_kept) > 64:
            _kept.clear()
        k = (np.arange(n)[None, :] - np.arange(n)[:, None]).astype(float)
        fit = (k >= width) & (n - k >= width)
        _kept[n, width] = np.where(fit, n / np.where(fit, k * (n - k), 1.0), 0.0)
    return _kept[n, width]


def permutation_p(x: np.ndarray, best: float, width: int, alpha: float, rounds: int = PERMUTATIONS) -> float:
    """Share of permutations of ``x`` with an arc as good as ``best``; stops once more than ``alpha`` of all rounds had one."""
    rng, deviations = np.random.default_rng(len(x)), x - x.mean()
    hits, b = 0, np.zeros(len(x) + 1)
    for done in range(1, rounds + 1):
        b[1:] = np.cumsum(rng.permutation(deviations))
        hits += plain_arc(b, width)[0] >= best * (1 - 1e-9)
        if hits > alpha * rounds:
            return (hits + 1) / (done + 1)
    return (hits + 1) / (rounds + 1)


def _phi(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.array([math.erf(v / math.sqrt(2)) for v in np.ravel(x)]).reshape(np.shape(x)))


def _overshoot(x: np.ndarray) -> np.ndarray:
    """Siegmund's correction for a maximum over steps in place of a continuous path."""
    half = np.maximum(x, 1e-9) / 2
    density = np.exp(-half * half / 2) / math.sqrt(2 * math.pi)
    return (_phi(half) - 0.5) / half / (half * _phi(half) + density)


def arc_tail(b: float, n: int, width: int, points: int = 100) -> float:
    """Chance that the best arc of ``n`` rows of noise reaches ``b`` standard deviations (arcs of width to n - width)."""
    return _tail(b, n, width, points, arcs=True)


def change_tail(b: float, n: int, width: int, points: int = 100) -> float:
    """The same for the best single change point."""
    return _tail(b, n, width, points, arcs=False)


def _tail(b: float, n: int, width: int, points: int, arcs: bool) -> float:
    if not b > 0 or n < 2 * width:
        return 1.0
    if b > 38:  # nothing of a double is left
        return 0.0
    edges = np.linspace(0.5, 1 - width / n, points + 1)
    t = (edges[1:] + edges[:-1]) / 2
    spread = t * (1 - t)
    correction = _overshoot(b / np.sqrt(n * spread))
    density = math.exp(-b * b / 2) / math.sqrt(2 * math.pi)
    if arcs:
        p = b**3 * density / 2 * float((correction**2 / spread**2).sum() * (edges[1] - edges[0]))
    else:
        p = 2 * b * density * float((correction / spread).sum() * (edges[1] - edges[0])) + 2 * density / b
    return min(1.0, p)


def open_pairs(low: np.ndarray, high: np.ndarray, at_low: np.ndarray, at_high: np.ndarray, n: int, width: int, rows: int, fan: int = FAN) -> np.ndarray:
    """Pairs of blocks (p, q), p <= q, that may hold the best arc; block p has the places p * rows on."""
    tree = [(low, high, at_low, at_high)]
    while len(tree[-1][0]) > fan:
        a, z, i, j = tree[-1]
        starts = np.arange(0, len(a), fan)
        own = np.arange(len(a)) // fan
        order_low, order_high = np.lexsort((i, a, own)), np.lexsort((j, -z, own))
        # the first of each block in these orders
        pick_low, pick_high = order_low[starts], order_high[starts]
        tree.append((a[pick_low], z[pick_high], i[pick_low], j[pick_high]))
    size, best = rows * fan ** (len(tree) - 1), 0.0
    p, q = np.triu_indices(len(tree[-1][0]))
    for level in range(len(tree) - 1, -1, -1):
        a, z, i, j = tree[level]
        # ends at the ranges' own places are an arc that exists
        for k, d in ((j[q] - i[p], z[q] - a[p]), (i[q] - j[p], z[p] - a[q])):
            fit = (k >= width) & (n - k >= width)
            if fit.any():
                best = max(best, float((d[fit] ** 2 * n / (k[fit] * (n - k[fit]))).max()))
        shortest = np.maximum(width, np.where(p == q, 1, (q - p - 1) * size + 1))
        longest = np.minimum(n - width, np.minimum(n, (q + 1) * size - 1) - p * size)
        fit = shortest <= longest
        least = np.minimum(shortest * (n - shortest), longest * (n - longest)).astype(float)
        far = np.maximum(z[q] - a[p], z[p] - a[q])
        keep = fit & (far * far * n >= best * (1 - 1e-12) * np.where(fit, least, 1.0))
        p, q = p[keep], q[keep]
        if level:
            count = len(tree[level - 1][0])
            grid = np.arange(fan)
            x = (p[:, None, None] * fan + grid[None, :, None] + 0 * grid[None, None, :]).ravel()
            y = (q[:, None, None] * fan + 0 * grid[None, :, None] + grid[None, None, :]).ravel()
            use = (x <= y) & (y < count)
            p, q, size = x[use], y[use], size // fan
    return np.column_stack([p, q])


def long_arcs(placed: DataFrame, seg: Sequence[str], width: int, rows: int = ROWS) -> DataFrame:
    """``(seg, stat, j1, j2)`` of each segment's best arc; ``placed`` has (seg, j from 0 to n, b, n), a zero at j = 0."""
    seg = list(seg)
    node = F.struct("j", "b")
    blocks = cut(placed.where("j < n").groupBy(*seg, F.floor(F.col("j") / rows).alias("blk")).agg(
        F.array_sort(F.collect_list(node)).alias("at"), F.min(F.struct("b", "j")).alias("lo"), F.max(F.struct("b", F.negative("j").alias("k"))).alias("hi"),
        F.max("n").alias("n")))
    small = blocks.select(
        *seg, "blk", F.col("lo.b").alias("low"), F.col("lo.j").alias("at_low"), F.col("hi.b").alias("high"), (-F.col("hi.k")).alias("at_high"), "n")
    fields = ", ".join(f"`{c}` {t}" for c, t in placed.select(*seg).dtypes)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blk")
        found = open_pairs(
            pdf["low"].to_numpy(), pdf["high"].to_numpy(), pdf["at_low"].to_numpy(), pdf["at_high"].to_numpy(), int(pdf["n"].iloc[0]), width, rows)
        out = pd.DataFrame(found, columns=["p", "q"])
        for c in seg:
            out[c] = pdf[c].iloc[0]
        return out[[*seg, "p", "q"]]

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            best = []
            for n, pj, pb, qj, qb in zip(pdf["n"], pdf["pj"], pdf["pb"], pdf["qj"], pdf["qb"]):
                k = (qj[None, :] - pj[:, None]).astype(float)
                fit = (k >= width) & (n - k >= width)
                z = np.where(fit, (qb[None, :] - pb[:, None]) ** 2 * n / np.where(fit, k * (n - k), 1.0), -1.0)
                i, j = divmod(int(np.argmax(z)), len(qj))
                best.append((z[i, j], pj[i], qj[j]))
            found = pd.DataFrame(best, columns=["stat", "j1", "j2"], index=pdf.index).astype({"j1": "int64", "j2": "int64"})
            yield pd.concat([pdf[seg], found], axis=1)

    # a segment's group holds one row for each of its blocks
    pairs = small.groupBy(*seg).applyInPandas(search, f"{fields}, p long, q long")
    side = lambda name: blocks.select(*seg, F.col("blk").alias(name), F.col("at.j").alias(f"{name}j"), F.col("at.b").alias(f"{name}b"), *(["n"] if name == "p" else []))
    both = cut(pairs).join(side("p"), [*seg, "p"]).join(side("q"), [*seg, "q"]).drop("p", "q")
    found = both.mapInPandas(compare, f"{fields}, stat double, j1 long, j2 long").where("stat >= 0")
    return found.groupBy(*seg).agg(F.max(F.struct("stat", F.negative("j1").alias("a"), F.negative("j2").alias("z"))).alias("m")).select(
        *seg, F.col("m.stat").alias("stat"), (-F.col("m.a")).alias("j1"), (-F.col("m.z")).alias("j2"))


def best_arcs(
    rows: DataFrame, seg: Sequence[str], value: str, order: str, width: int, alpha: float, permuted: int = PERMUTED, block: int = ROWS
) -> DataFrame:
    """``(seg, n, stat, j1, j2, p)``: the best arc of each segment and the chance of one as good.

    ``rows`` has (seg, order, value) and ``b``, the running sum of deviations up to the row,
    ``j`` its place from 1, ``n`` and ``tss``, the segment's rows and sum of squared
    deviations. Segments too short for an arc get no row.
    """
    seg = list(seg)
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.select(*seg).dtypes)
    schema = f"{fields}, n long, stat double, j1 long, j2 long, p double"

    def short(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("j")
        x = pdf[value].to_numpy(float)
        stat, j1, j2 = plain_arc(np.concatenate(([0.0], np.cumsum(x - x.mean()))), width)
        p = permutation_p(x, stat, width, alpha) if stat > 0 else 1.0
        return pd.DataFrame([[*(pdf[c].iloc[0] for c in seg), len(x), stat, j1, j2, p]], columns=[*seg, "n", "stat", "j1", "j2", "p"])

    few = rows.where((F.col("n") <= permuted) & (F.col("n") >= 2 * width)).groupBy(*seg).applyInPandas(short, schema)
    many = cut(rows.where((F.col("n") > permuted) & (F.col("n") >= 2 * width)).select(*seg, "j", "b", "n", "tss"))
    zero = many.where("j = 1").select(*seg, F.lit(0).cast("long").alias("j"), F.lit(0.0).alias("b"), "n", "tss")
    found = long_arcs(many.unionByName(zero).drop("tss"), seg, width, block)
    facts = many.where("j = 1").select(*seg, "n", "tss")

    @F.pandas_udf("double")
    def tail(b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([arc_tail(float(x), int(m), width) for x, m in zip(b, n)])

    long_ = found.join(facts, seg).withColumn("p", tail(student("stat", "tss", "n"), F.col("n")))
    return few.unionByName(long_.select(*seg, "n", "stat", "j1", "j2", "p"))


def student(stat: str, tss: str, n: str) -> Column:
    """The statistic over what is left of the variance; a perfect step is as far as a double goes."""
    left = (F.col(tss) - F.col(stat)) / (F.col(n) - 2)
    return F.when(F.col(stat) <= 0, 0.0).when(left <= F.col(tss) * 1e-15, 1e9).otherwise(F.sqrt(F.col(stat) / left))
