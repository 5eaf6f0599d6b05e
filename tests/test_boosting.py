"""Boosted stumps against plain loops; unknown values, ties, copies, one and two classes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandwise.operators.boosting import boosted_stumps

EPS = 2.0**-52


def logs(counts):
    whole = sum(counts)
    return [math.log(max(c / whole, EPS)) for c in counts]


def plain_fit(rows, classes, rounds, held=()):
    """rows: (features, label), those numbered in ``held`` without weight; the stumps as (feature, threshold, left counts, right counts)."""
    k, stumps = len(classes), []
    w = [0.0 if i in held else 1 / (len(rows) - len(held)) for i in range(len(rows))]
    for _ in range(rounds):
        best = None
        for f in range(len(rows[0][0])):
            values = sorted({x[f] for x, _ in rows})
            for at, v in enumerate(values):
                t = (v + values[at + 1]) / 2 if at + 1 < len(values) else math.inf
                sides = [[0.0] * k, [0.0] * k]
                for (x, label), weight in zip(rows, w):
                    sides[x[f] > t][classes.index(label)] += weight
                score = round(sum(sum(c * c for c in s) / sum(s) for s in sides if sum(s)), 10)
                if best is None or score > best[0]:
                    best = (score, f, t, *sides)
        _, f, t, left, right = best
        stumps.append((f, t, left, right))
        for i, (x, label) in enumerate(rows):
            p, y = logs(right if x[f] > t else left), classes.index(label)
            w[i] *= math.exp(-(k - 1) / k * (p[y] - (sum(p) - p[y]) / (k - 1)))
        w = [v / sum(w) for v in w]
    return stumps


def plain_predict(stumps, x, classes):
    votes = [0.0] * len(classes)
    for f, t, left, right in stumps:
        p = logs(right if x[f] > t else left)
        votes = [v + (len(classes) - 1) * (q - sum(p) / len(p)) for v, q in zip(votes, p)]
    votes = [round(v, 9) for v in votes]
    return classes[votes.index(max(votes))]


def noisy(n, seed, classes):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        y = rng.randrange(len(classes))
        rows.append(((round(y + rng.gauss(0, 0.8), 1), round(rng.random(), 1), round(rng.gauss(-y, 1.5), 1)), classes[y]))
    return rows


def frame(spark, rows):
    flat = [(*x, label, "kept") for x, label in rows]
    return spark.createDataFrame(flat, "p double, q double, r double, label string, l string").repartition(3)


@pytest.mark.parametrize("classes", [["D/D", "I/D", "I/I"], ["no", "yes"]])
def test_fit_equals_plain_rounds(spark, classes):
    rows = noisy(120, 5, classes)
    rows += rows[:1] * 60  # copies that hold a third of all rows
    model = boosted_stumps(frame(spark, rows), ["p", "q", "r"], "label", rounds=7)
    want = plain_fit(rows, classes, 7)
    assert [(s.feature, s.threshold) for s in model.stumps] == [(f, pytest.approx(t)) for f, t, _, _ in want]
    for s, (_, _, left, right) in zip(model.stumps, want):
        assert s.left == pytest.approx([c / sum(left) for c in left])
        assert s.right == pytest.approx([c / sum(right) for c in right])
    for r in model.predict(frame(spark, rows)).collect():
        assert r["prediction"] == plain_predict(want, (r["p"], r["q"], r["r"]), classes)
        assert r["l"] == "kept"


def test_folds(spark):
    rows = noisy(60, 9, ["a", "b", "c"])
    fold = F.when(F.col("q") < 0.5, 0).otherwise(2)  # fold 1 has no rows
    model = boosted_stumps(frame(spark, rows), ["p", "q", "r"], "label", rounds=2, folds=3, fold=fold)
    assert sorted(model.accuracy) == [0, 2]
    for part in (0, 2):
        held = [i for i, r in enumerate(rows) if (r[0][1] < 0.5) == (part == 0)]
        stumps = plain_fit(rows, ["a", "b", "c"], 2, held)
        right = sum(plain_predict(stumps, rows[i][0], ["a", "b", "c"]) == rows[i][1] for i in held)
        assert model.accuracy[part] == pytest.approx(right / len(held))


def test_unknown_values_and_few_classes(spark):
    rows = [((1.0, 0.0, 0.0), "a"), ((2.0, 0.0, 0.0), "b"), ((None, 0.0, 0.0), "a"), ((math.nan, 0.0, 0.0), "b"), ((1.0, 0.0, 0.0), None)]
    model = boosted_stumps(frame(spark, rows), ["p", "q", "r"], "label", rounds=9)
    assert [(s.feature, s.threshold) for s in model.stumps] == [(0, 1.5)]  # no error left, so no second round
    found = {(str(r["p"]), r["prediction"]) for r in model.predict(frame(spark, rows)).collect()}
    assert found == {("1.0", "a"), ("2.0", "b"), ("None", None), ("nan", None)}
    alone = boosted_stumps(frame(spark, rows[:1]), ["p", "q", "r"], "label")
    assert [r["prediction"] for r in alone.predict(frame(spark, rows[:2])).collect()] == ["a", "a"]
    with pytest.raises(ValueError):
        boosted_stumps(frame(spark, rows[4:]), ["p", "q", "r"], "label")
