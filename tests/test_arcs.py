"""Arcs against a search of all pairs; tails against simulated noise; segments on planted steps."""

import numpy as np
import pytest

from strandwise.operators import copynumber
from strandwise.operators.arcs import arc_tail, best_arcs, change_tail, open_pairs, permutation_p, plain_arc


def bridge(x):
    return np.concatenate(([0.0], np.cumsum(x - np.mean(x))))


def brute(x, width):
    b, n, best = bridge(x), len(x), (-1.0, 0, 0)
    for i in range(n + 1):
        for j in range(i + width, n):
            if n - (j - i) >= width:
                z = (b[j] - b[i]) ** 2 * n / ((j - i) * (n - (j - i)))
                best = max(best, (z, i, j), key=lambda t: t[0])
    return best


def series(rng):
    for n in (2, 3, 4, 5, 40, 63, 64, 200):
        yield rng.normal(size=n)
        x = rng.normal(size=n)
        x[n // 3 : n // 2] += 3
        yield x
    yield np.ones(50)
    yield np.repeat([0.0, 1.0], 40)


def test_bounds_never_lose_the_best_arc():
    rng = np.random.default_rng(1)
    for x in series(rng):
        for width in (1, 2, 5):
            want = brute(x, width)
            assert plain_arc(bridge(x), width)[0] == pytest.approx(max(want[0], -1.0), abs=1e-9)
            if want[0] < 0:
                continue
            b, rows = bridge(x), 4
            cuts = [b[i : i + rows] for i in range(0, len(b), rows)]
            first = np.arange(len(cuts)) * rows
            pairs = open_pairs(
                np.array([c.min() for c in cuts]), np.array([c.max() for c in cuts]), first + [int(c.argmin()) for c in cuts],
                first + [int(c.argmax()) for c in cuts], len(x), width, rows, fan=2)
            found = -1.0
            for p, q in pairs:
                for i in range(p * rows, p * rows + len(cuts[p])):
                    for j in range(q * rows, q * rows + len(cuts[q])):
                        if j - i >= width and len(x) - (j - i) >= width:
                            found = max(found, (b[j] - b[i]) ** 2 * len(x) / ((j - i) * (len(x) - (j - i))))
            assert found == pytest.approx(want[0], abs=1e-9)


def test_few_pairs_stay_open():
    rng = np.random.default_rng(2)
    shares = []
    for n in (20_000, 80_000):
        x = rng.normal(size=n)
        x[n // 4 : n // 2] += 1
        b, rows = bridge(x)[:-1], 100
        cuts = b.reshape(-1, rows)
        first = np.arange(len(cuts)) * rows
        pairs = open_pairs(cuts.min(axis=1), cuts.max(axis=1), first + cuts.argmin(axis=1), first + cuts.argmax(axis=1), n, 2, rows)
        shares.append(len(pairs) / len(cuts))
    assert max(shares) < 4  # in proportion to the rows, not to their square


def test_tails_follow_simulated_noise():
    rng, n = np.random.default_rng(3), 300
    arcs, changes = [], []
    for _ in range(1500):
        x = rng.normal(size=n)
        arcs.append(np.sqrt(plain_arc(bridge(x), 10)[0]))
        b, k = bridge(x)[10 : n - 9], np.arange(10, n - 9)
        changes.append(np.sqrt((b**2 * n / (k * (n - k))).max()))
    for values, tail in ((arcs, arc_tail), (changes, change_tail)):
        for share in (0.1, 0.03):
            assert tail(float(np.quantile(values, 1 - share)), n, 10) == pytest.approx(share, rel=0.5)
    assert arc_tail(0, 50, 2) == 1 and arc_tail(1e9, 50, 2) == 0 and arc_tail(5, 3, 2) == 1


def test_permutations_stop_early_and_tell_steps_from_noise():
    rng = np.random.default_rng(4)
    noise, step = rng.normal(size=100), np.concatenate([rng.normal(size=50), rng.normal(size=50) + 3])
    assert permutation_p(noise, plain_arc(bridge(noise), 2)[0], 2, 0.01) > 0.01
    assert permutation_p(step, plain_arc(bridge(step), 2)[0], 2, 0.01) <= 0.002


@pytest.mark.parametrize("permuted", [64, 256])
def test_short_planted_arc_is_found(spark, permuted):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(4):
        x = rng.normal(size=400) * 0.2
        x[150:156] += 2 * (s != 3)  # six rows that the range of sums alone would miss
        rows += [(f"S{s}", "c", i * 10, float(v)) for i, v in enumerate(x)]
    rows += [("S0", "c", 9999, None), ("S9", "c", 0, 1.0), ("S8", "c", 0, 1.0), ("S8", "c", 10, 1.0)]
    frame = spark.createDataFrame(rows, "sample string, chrom string, start long, x double")
    got = copynumber.segment(frame, "x", permuted=permuted).orderBy("sample", "start").collect()
    starts = {s: [r.start for r in got if r.sample == s] for s in ("S0", "S1", "S2", "S3", "S8", "S9")}
    assert starts == {"S0": [0, 1500, 1560], "S1": [0, 1500, 1560], "S2": [0, 1500, 1560], "S3": [0], "S8": [0], "S9": [0]}
    for r in got:
        last = r.start == starts[r.sample][-1]
        assert (r.pval is None) == last and (last or r.pval < 1e-6)


def test_short_and_long_paths_agree(spark):
    rng = np.random.default_rng(6)
    data = [(k, j + 1, float(v)) for k in range(6) for j, v in enumerate(rng.normal(size=50 + 40 * k))]
    want = {}
    rows = []
    for k in range(6):
        x = np.array([v for q, _, v in data if q == k])
        b = bridge(x)
        want[k] = brute(x, 3)
        rows += [(k, j + 1, float(v), float(b[j + 1]), len(x), float(((x - x.mean()) ** 2).sum())) for j, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "k int, j long, x double, b double, n long, tss double")
    for permuted in (0, 1000):
        got = {r.k: (r.stat, r.j1, r.j2) for r in best_arcs(frame, ["k"], "x", "j", 3, 0.01, permuted=permuted, block=8).collect()}
        for k, w in want.items():
            assert got[k] == (pytest.approx(w[0]), w[1], w[2])
