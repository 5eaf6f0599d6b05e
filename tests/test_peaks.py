"""Peak shape and thinning against plain scans, at block borders, on plateaus, ties and ends."""

import random

import pytest

from strandwise.operators import assay
from strandwise.operators.peaks import peak_shape, thin


def plain_shape(x, i, rel=0.5):
    """(prominence, left base, right base, left crossing, right crossing) of sample ``i``."""
    h, ends = x[i], []
    for step in (-1, 1):
        low, base, j = h, i, i
        while 0 <= j < len(x) and x[j] <= h:
            if x[j] < low:
                low, base = x[j], j
            j += step
        ends.append((low, base))
    prominence = h - max(low for low, _ in ends)
    level, cross = h - prominence * rel, []
    for step in (-1, 1):
        j = i
        while x[j] > level:
            j += step
        cross.append(j - step * ((level - x[j]) / (x[j - step] - x[j]) if x[j] < level else 0))
    return prominence, ends[0][1], ends[1][1], *cross


def plain_thin(rows, distance):
    kept = []
    for pos, height in sorted(rows, key=lambda r: (-r[1], -r[0])):
        if all(abs(pos - p) >= distance for p, _ in kept):
            kept.append((pos, height))
    return sorted(kept)


@pytest.mark.parametrize(("fan", "rel"), [(4, 0.5), (7, 0.9), (256, 0.5)])
def test_shape_equals_a_scan(spark, fan, rel):
    rng, rows, tops = random.Random(fan), [], []
    for key, n, steps in (("a", 300, 3), ("b", 90, 40), ("c", 64, 2)):
        x = [float(rng.randrange(steps)) for _ in range(n)]
        if key == "b":
            x = sorted(x)[: n // 2] + sorted(x)[n // 2 :][::-1] + [0.0]  # one slope up, one down
        rows += [(key, i, v) for i, v in enumerate(x)]
        tops += [(key, i, v, *plain_shape(x, i, rel)) for i, v in enumerate(x) if 0 < i < n - 1 and plain_shape(x, i, rel)[0] > 0]
    rows += [("a", None, 9.0), ("c", 70, None)]
    signal = spark.createDataFrame(rows, "sample string, pos long, intensity double")
    peaks = spark.createDataFrame([t[:3] for t in tops], "sample string, pos long, height double")
    got = peak_shape(peaks, signal, rel_height=rel, fan=fan).collect()
    have = sorted((r["sample"], r["pos"], r["height"], round(r["prominence"], 9), r["left_base"], r["right_base"], round(r["left_ip"], 9), round(r["right_ip"], 9)) for r in got)
    assert have == sorted((*t[:4], *t[4:6], round(t[6], 9), round(t[7], 9)) for t in tops)
    assert all(r["width"] == pytest.approx(r["right_ip"] - r["left_ip"]) for r in got)


def test_empty_traces(spark):
    signal = spark.createDataFrame([], "sample string, pos long, intensity double")
    peaks = spark.createDataFrame([], "sample string, pos long, height double")
    assert peak_shape(peaks, signal).count() == 0 and thin(peaks, ["sample"], 5).count() == 0
    assert assay.call_peaks(signal, 1, 5, max_peaks=3, max_width=4).count() == 0


@pytest.mark.parametrize("shape", ["random", "slope", "flat"])
def test_one_endless_chain_over_many_blocks(spark, shape):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        height = {"random": rng.randrange(60), "slope": 1000 - i, "flat": 7}[shape]
        rows.append((2 * i, float(height)))
    peaks = spark.createDataFrame([("s", *r) for r in rows] + [("t", 5, 1.0)], "sample string, pos long, height double")
    got = sorted((r["pos"], r["height"]) for r in thin(peaks, ["sample"], 9, span=64).where("sample = 's'").collect())
    assert got == plain_thin(rows, 9)


def test_wide_and_shallow_peaks_go(spark):
    x = [0, 9, 0, 0, 5, 6, 8, 6, 5, 0, 7, 8, 7, 9, 0, 9, 0]
    signal = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "sample string, pos long, intensity double")
    called = lambda **o: sorted(r["pos"] for r in assay.call_peaks(signal, 1, 1, **o).collect())
    assert called() == [1, 6, 11, 13, 15]
    assert called(max_width=2) == [1, 11, 15]
    assert called(min_width=2) == [6, 13]
    assert called(min_prominence_share=0.5) == [1, 6, 13, 15]
    # four peaks are too many: again over the fourth height, 8, and one
    assert called(max_peaks=3, min_prominence_share=0.5) == [1, 13, 15]
