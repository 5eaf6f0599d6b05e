"""Local regression against a plain loop over all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from strandwise.operators.smoothing import local_fit, smoothing_r2


def plain(x, y, fraction, passes):
    """LOWESS over every pair of rows."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    k = min(max(int(fraction * len(x) + 1e-10), 1), len(x))
    dist = np.abs(x[:, None] - x[None, :])
    radius = np.sort(dist, axis=1)[:, k - 1][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        near = np.where(radius > 0, np.clip(1 - (dist / radius) ** 3, 0, None) ** 3, dist == 0)
        robust = np.ones(len(x))
        for step in range(passes + 1):
            w = near * robust
            total = w.sum(1)
            mx, my = w @ x / total, w @ y / total
            away = x[None, :] - mx[:, None]
            sxx, sxy = (w * away**2).sum(1), (w * away * y).sum(1)
            flat = sxx <= 1e-12 * total * np.where(radius[:, 0] > 0, radius[:, 0], 1) ** 2
            fit = my + np.where(flat, 0, sxy / sxx) * (x - mx)
            if step < passes:
                a = np.abs(y - fit)
                mad = np.nanmedian(a)
                robust = np.where(a < 6 * mad, (1 - (a / (6 * mad)) ** 2) ** 2, 0) if mad > 0 else (a == 0) * 1.0
    return fit


def check(spark, frame, fraction, passes):
    df = spark.createDataFrame(frame).repartition(5)
    got = local_fit(df, ["g"], "x", "y", fraction=fraction, passes=passes).toPandas().sort_values("i")
    assert len(got) == len(frame)
    for g, part in frame.groupby("g"):
        want = plain(part["x"], part["y"], fraction, passes)
        mine = got[got["g"] == g].set_index("i").loc[part["i"], "fit"].to_numpy()
        np.testing.assert_allclose(mine, want, rtol=1e-7, atol=1e-7)


def test_equals_the_loop_over_all_rows(spark):
    rng = np.random.default_rng(3)
    parts = [
        pd.DataFrame({"g": "even", "x": rng.uniform(0, 50, 700)}),
        # a gap, a far point, and a third of the rows on one x
        pd.DataFrame({"g": "odd", "x": np.concatenate([rng.normal(0, 1, 300), rng.normal(900, 1, 250), np.full(280, 1.5), [1e6]])}),
        pd.DataFrame({"g": "steps", "x": rng.integers(0, 40, 300).astype(float)}),
        pd.DataFrame({"g": "two", "x": [1.0, 3.0]}),
        pd.DataFrame({"g": "one", "x": [4.0]}),
        pd.DataFrame({"g": "same", "x": np.full(9, 2.0)}),
    ]
    frame = pd.concat(parts, ignore_index=True)
    frame["y"] = np.sin(frame["x"] / 5) + rng.normal(0, 0.1, len(frame)) + (rng.random(len(frame)) < 0.02) * 30
    frame["i"] = range(len(frame))
    check(spark, frame, 0.1, 0)
    check(spark, frame, 2 / 3, 1)


@pytest.mark.parametrize("fraction", [0.03, 0.6])
def test_nodes_of_a_deep_tree(spark, fraction):
    """More leaves than one node holds: most of a window is read from moments."""
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"g": 1, "x": np.sort(np.concatenate([rng.exponential(1e3, 4700), rng.uniform(1e7, 2e7, 300)]))})
    frame["y"] = frame["x"] ** 0.5 + rng.normal(0, 1, len(frame))
    frame["i"] = range(len(frame))
    check(spark, frame, fraction, 1)


def test_rows_outside_and_clashing_names(spark):
    rows = [(1, "a", 1.0, 2.0, 7), (2, "a", 2.0, 4.0, 7), (3, "a", 3.0, 6.0, 7), (4, "a", None, 1.0, 7), (5, None, 1.0, 1.0, 7),
            (6, "a", 4.0, None, 7), (7, "a", float("nan"), 1.0, 7), (8, "a", float("inf"), 1.0, 7)]
    df = spark.createDataFrame(rows, "i int, k string, radius double, w double, d int")
    got = {r["i"]: r["fit"] for r in local_fit(df, ["k"], "radius", "w", fraction=1.0, passes=0).collect()}
    assert [got[i] for i in (4, 5, 6, 7, 8)] == [None] * 5
    assert [round(got[i], 9) for i in (1, 2, 3)] == [2.0, 4.0, 6.0]
    empty = local_fit(df.where("i < 0"), ["k"], "radius", "w")
    assert empty.columns == [*df.columns, "fit"] and empty.count() == 0


def test_r_square(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({"g": np.repeat(["a", "b"], 60), "x": np.tile(np.arange(60.0), 2)})
    frame["y"] = np.where(frame["g"] == "a", frame["x"] ** 1.1, 1.0) + np.where(frame["g"] == "a", rng.normal(0, 1, 120), 0)
    got = dict(map(tuple, smoothing_r2(spark.createDataFrame(frame), ["g"], "x", "y", fraction=0.3).collect()))
    a = frame[frame["g"] == "a"]
    fit = plain(a["x"], a["y"], 0.3, 3)
    assert got == {"a": round(1 - ((a["y"] - fit) ** 2).sum() / ((a["y"] - a["y"].mean()) ** 2).sum(), 4), "b": None}


def test_far_nodes_are_added_up_once(monkeypatch):
    from strandwise.operators import smoothing

    rng, calls, plain_moments = np.random.default_rng(5), [], smoothing._by_moments
    xs = np.sort(rng.uniform(0, 1000, 40 * smoothing.LEAF)).reshape(40, -1)
    ws, wys = rng.uniform(0, 1, xs.shape), rng.normal(size=xs.shape)
    leaves = pd.DataFrame({"g": "a", "node": np.arange(40), "xs": list(xs), "ws": list(ws), "wys": list(wys)})
    leaves = next(smoothing._leaf_moments(iter([leaves])))
    x = xs[20]
    radius = np.full(len(x), 300.0)
    pairs = leaves.assign(block=20, tx=[x] * 40, tr=[radius] * 40, up_lo=np.nan, up_hi=np.nan)
    monkeypatch.setattr(smoothing, "_by_moments", lambda *a: calls.append(1) or plain_moments(*a))
    got = next(smoothing._sums(["g"], True)(iter([pairs]))).sort_values("d")
    want = smoothing._by_values(x, radius, xs.ravel(), ws.ravel(), wys.ravel())
    np.testing.assert_allclose(got[list(smoothing._PARTS)].to_numpy(), want, rtol=1e-11, atol=1e-9)
    assert got["d"].tolist() == list(range(20 * smoothing.LEAF, 21 * smoothing.LEAF)) and len(calls) <= 6
    # a radius far below the reach of the sums keeps every node by itself
    near = [(x[-1], x[-1] + 1, *map(np.asarray, (np.ones(12), np.ones(12))))] * 2
    np.testing.assert_allclose(smoothing._by_far(x, np.full(len(x), 5.0), 1.0, near), 2 * smoothing._by_far(x, np.full(len(x), 5.0), 1.0, near[:1]))
