"""Boosted stumps with real-valued class votes, for any number of classes.

Each round takes the split of one feature that leaves the purest weighted classes on
both sides; a row then gains weight the less its side's class shares favour its own
class.  Spark adds up weighted classes per feature value; only the stumps, a few numbers
each, pass through the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from strandwise.functions.stages import cut

_EPS = 2.0**-52  # a share of zero counts as this in a logarithm
_ONE = 2.0**52  # weights are whole parts of this, so that their sums do not depend on the order
_BLOCKS = 255
_FOLD_IN = 5  # rounds between two writes of the row weights
_STUMP = "struct<f:int,t:double,left:array<double>,right:array<double>>"


@dataclass
class Stump:
    """Split ``feature <= threshold`` and the weighted class shares on both sides."""

    feature: int
    threshold: float
    left: list[float]
    right: list[float]


@dataclass
class BoostedStumps:
    """``stumps`` of the model of all rows; ``accuracy`` of each fold by the model of the other folds."""

    classes: list[str]
    features: list[str]
    stumps: list[Stump]
    accuracy: dict[int, float] = field(default_factory=dict)

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with the class of most votes, the first by name on a tie; null where a feature is null or NaN."""
        x = F.array(*[F.col(c).cast("double") for c in self.features])
        votes = _literal([_votes(self.stumps)], f"array<array<{_STUMP}>>")[0]
        best = _first_best(votes, x, len(self.classes))
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(output, F.when(_whole(x), F.get(names, best)))


def _literal(value, kind: str) -> Column:
    """A constant that Spark folds into one reference, so that rounds share their compiled code."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {kind}")["v"]


def _whole(x: Column) -> Column:
    return ~F.exists(x, lambda v: v.isNull() | F.isnan(v))


def _logs(shares: Sequence[float]) -> list[float]:
    return [math.log(max(p, _EPS)) for p in shares]


def _votes(stumps: Sequence[Stump]) -> list[dict]:
    def side(shares):
        logs = _logs(shares)
        mean = sum(logs) / len(logs)
        return [(len(logs) - 1) * (x - mean) for x in logs]

    return [{"f": s.feature, "t": s.threshold, "left": side(s.left), "right": side(s.right)} for s in stumps]


def _gains(stumps: Sequence[Stump], rate: float) -> list[dict]:
    """Logarithm of the factor on a row's weight, by side and class of the row."""

    def side(shares):
        logs, k = _logs(shares), len(shares)
        return [-rate * (k - 1) / k * (x - (sum(logs) - x) / (k - 1)) for x in logs]

    return [{"f": s.feature, "t": s.threshold, "left": side(s.left), "right": side(s.right)} for s in stumps]


def _summed(stumps: Column, x: Column, k: Column | int) -> Column:
    return F.aggregate(
        stumps,
        F.lit(0.0),
        lambda acc, s: acc + F.get(F.when(F.get(x, s["f"]) <= s["t"], s["left"]).otherwise(s["right"]), F.lit(k) if isinstance(k, int) else k),
    )


def _first_best(stumps: Column, x: Column, classes: int) -> Column:
    scores = F.transform(F.array(*[_summed(stumps, x, k) for k in range(classes)]), lambda s: F.round(s, 9))
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def _splits(rows: DataFrame, w: Column, classes: int) -> dict[int, Row]:
    """Best split of each model: m → feature, threshold, class weights on the left and in all."""
    ks = range(classes)
    long = rows.select("y", F.posexplode(w).alias("m", "w"), "at").select("y", "m", "w", F.inline("at"))
    hist = long.groupBy("m", "f", "block", "v").agg(
        *[F.sum(F.when(F.col("y") == k, F.col("w")).otherwise(0)).alias(f"c{k}") for k in ks]
    )
    over = Window.partitionBy("m", "f").orderBy("block")
    before, all_blocks = over.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("m", "f")
    blocks = hist.groupBy("m", "f", "block").agg(F.min("v").alias("v0"), *[F.sum(f"c{k}").alias(f"c{k}") for k in ks])
    carry = blocks.select(
        "m",
        "f",
        "block",
        F.lead("v0").over(over).alias("after"),
        *[F.coalesce(F.sum(f"c{k}").over(before), F.lit(0)).alias(f"b{k}") for k in ks],
        *[F.sum(f"c{k}").over(all_blocks).alias(f"t{k}") for k in ks],
    )
    inner = Window.partitionBy("m", "f", "block").orderBy("v")
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    left = hist.join(carry, ["m", "f", "block"]).select(
        "m",
        "f",
        "v",
        F.coalesce(F.lead("v").over(inner), F.col("after")).alias("next"),
        F.array(*[F.col(f"b{k}") + F.sum(f"c{k}").over(so_far) for k in ks]).alias("left"),
        F.array(*[f"t{k}" for k in ks]).alias("total"),
    )
    middle = F.col("v") + (F.col("next") - F.col("v")) / 2
    # without a next value all rows are on the left: the split that splits nothing
    at = F.when(F.col("next").isNull(), float("inf")).when(middle < F.col("next"), middle).otherwise(F.col("v"))

    def purity(parts: Column) -> Column:
        whole = F.aggregate(parts, F.lit(0.0), lambda acc, c: acc + c)
        return F.coalesce(F.aggregate(parts, F.lit(0.0), lambda acc, c: acc + c * c) / F.nullif(whole, F.lit(0.0)), F.lit(0.0))

    on_left = F.transform("left", lambda c: c / _ONE)
    on_right = F.zip_with("total", "left", lambda t, c: (t - c) / _ONE)
    scored = left.select("m", "f", at.alias("t"), "left", "total", F.round(purity(on_left) + purity(on_right), 10).alias("score"))
    best = scored.groupBy("m").agg(
        F.max_by(F.struct("f", "t", "left", "total"), F.struct("score", -F.col("f"), -F.col("t"))).alias("best")
    )
    return {r["m"]: r["best"] for r in best.collect()}


def boosted_stumps(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = 50,
    rate: float = 1.0,
    folds: int = 0,
    fold: Column | None = None,
) -> BoostedStumps:
    """Fit ``rounds`` stumps, and with ``folds`` one model per fold from the rows outside it.

    Rows without a label or with a null or NaN feature teach nothing.  Equal rows are
    counted first, as they keep equal weights.  ``fold``: 0 to folds - 1; by default a hash
    of features and label, so that copies never stand on both sides.  All models share
    each pass over the rows, so thresholds lie between values of all rows, those of the
    fold left out among them; its labels are not looked at.  On equal purity (10 digits) the first feature and the lowest
    threshold win.  A model ends early when a stump makes no error, or when no split is
    left.  ``accuracy`` leaves out folds without rows.  No labelled row: ValueError.
    """
    features = list(features)
    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = train.select(x.alias("x"), F.col(label).cast("string").alias("l"), (fold if fold is not None else F.lit(None)).cast("int").alias("fold"))
    rows = rows.where(F.col("l").isNotNull() & _whole(F.col("x")))
    if folds and fold is None:
        rows = rows.withColumn("fold", F.pmod(F.xxhash64("x", "l"), F.lit(folds)).cast("int"))
    rows = cut(rows.groupBy("x", "l", "fold").agg(F.count(F.lit(1)).alias("n")))
    classes = [r["l"] for r in rows.groupBy("l").agg(F.count("*")).orderBy("l").collect()]
    if not classes:
        raise ValueError("no labelled rows")
    k, models = len(classes), folds + 1
    probs = [(i + 1) / (_BLOCKS + 1) for i in range(_BLOCKS)]
    marks = rows.agg(
        *[F.array_distinct(F.percentile_approx(F.get("x", F.lit(i)), probs, 2000)).alias(f"f{i}") for i in range(len(features))]
    ).first()
    at = []
    for i in range(len(features)):
        v, here = F.get("x", F.lit(i)), _literal(list(marks[i]), "array<double>")
        at.append(F.struct(F.lit(i).alias("f"), F.size(F.filter(here, lambda s, v=v: s < v)).alias("block"), v.alias("v")))
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("l")) - 1
    zeros = F.array(*[F.lit(0.0)] * models)
    rows = cut(rows.select("x", "n", "fold", y.cast("int").alias("y"), F.array(*at).alias("at"), zeros.alias("logs")))

    def in_model(m: Column) -> Column:
        return F.coalesce(F.col("fold") != m - 1, F.lit(True))

    sizes = rows.agg(*[F.sum(F.when(in_model(F.lit(m)), F.col("n")).otherwise(0)).alias(f"n{m}") for m in range(models)]).first()
    shift = [math.log(max(n, 1) / _ONE) for n in sizes]
    stumps: list[list[Stump]] = [[] for _ in range(models)]
    fresh: list[list[Stump]] = [[] for _ in range(models)]
    done = [n == 0 for n in sizes]
    numbers = F.sequence(F.lit(0), F.lit(models - 1))
    for step in range(rounds if k > 1 else 1):
        if all(done):
            break
        gains = _literal([_gains(s, rate) if k > 1 else [] for s in fresh], f"array<array<{_STUMP}>>")
        shifts = _literal(shift, "array<double>")
        logs = F.transform(numbers, lambda m: F.get("logs", m) + _summed(F.get(gains, m), F.col("x"), F.col("y")))
        if step and step % _FOLD_IN == 0:
            rows = cut(rows.withColumn("logs", logs))
            fresh, logs = [[] for _ in range(models)], F.col("logs")
        moved = F.transform(
            numbers,
            lambda m: F.when(in_model(m), F.rint(F.col("n") * F.exp(F.get(logs, m) - F.get(shifts, m))).cast("long")).otherwise(F.lit(0)),
        )
        for m, best in _splits(rows, moved, k).items():
            total = sum(best["total"])
            if done[m]:
                continue
            if total == 0:
                done[m] = True
                continue
            sides = [list(best["left"]), [t - c for t, c in zip(best["total"], best["left"])]]
            shares = [[c / max(sum(s), 1) for c in s] if sum(s) else [c / total for c in best["total"]] for s in sides]
            stump = Stump(best["f"], best["t"], *shares)
            stumps[m].append(stump)
            fresh[m].append(stump)
            done[m] = math.isinf(best["t"]) or sum(sum(s) - max(s) for s in sides) == 0
            if k > 1:
                gain = _gains([stump], rate)[0]
                shift[m] += math.log(sum(c * math.exp(g) for s, n in zip(sides, ("left", "right")) for c, g in zip(s, gain[n])) / _ONE)
    model = BoostedStumps(classes, features, stumps[0])
    if folds:
        votes = _literal([_votes(s) for s in stumps], f"array<array<{_STUMP}>>")
        guess = _first_best(F.get(votes, F.col("fold") + 1), F.col("x"), k)
        right = F.sum(F.when(guess == F.col("y"), F.col("n")).otherwise(0)) / F.sum("n")
        scored = rows.where(F.col("fold").between(0, folds - 1)).groupBy("fold").agg(right.alias("a")).collect()
        model.accuracy = {r["fold"]: r["a"] for r in sorted(scored)}
    return model
