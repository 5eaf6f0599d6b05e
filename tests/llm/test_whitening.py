"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from strandwise.llm.queries import QUERIES, table
from strandwise.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], SCHEMA)


def plain(vectors, wanted=32):
    """Longs, eigenvalues above nothing, components and trace."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    far = x * n - sums
    c = far.astype(float) / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1][:wanted], vector[:, ::-1][:, :wanted]
    return far, c, value, vector, np.trace(c.T @ c / n)


def check(got, vectors, ids, wanted=32, tolerance=1e-9):
    far, c, value, vector, trace = plain(vectors, wanted)
    value = value[value > 1e-18 * max(value.max(), 1)]
    k = len(value)
    assert len(got) == k * len(vectors)
    table = {(r["vec_id"], r["component"]): r for r in got}
    assert len(table) == len(got)
    for j in range(k):
        have = np.array([table[i, j + 1]["whitened"] for i in ids])
        want = c @ vector[:, j] / np.sqrt(value[j])
        sign = np.sign(have @ want)
        np.testing.assert_allclose(have * sign, want, atol=tolerance)
        np.testing.assert_allclose(table[ids[0], j + 1]["explained"], value[j] / trace, rtol=1e-9)
    for i, f in zip(ids, far):
        assert table[i, 1]["deviation"] == sum(a * a for a in f) and table[i, 1]["n"] == len(vectors)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_query_equals_the_eigenvectors(spark, sf_dir):
    rows = [r for r in table(spark, sf_dir, "embeddings").collect() if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    got = QUERIES["op12_whitening"](spark, sf_dir).collect()
    # neighbouring eigenvalues bound how well single components can agree
    check(got, [r["embedding"] for r in rows], [r["vec_id"] for r in rows], tolerance=1e-8)


def test_odd_vectors_are_left_out(spark):
    random = np.random.default_rng(1)
    good = (random.standard_normal((40, 5)) * [5, 4, 3, 2, 1]).tolist()
    odd = [None, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0]]
    got = whiten(frame(spark, good + odd + good[:3])).collect()
    check(got, good + good[:3], [*range(40), 44, 45, 46])


@pytest.mark.parametrize("wanted", [1, 2, 7])
def test_wide_spectrum_stops_early_or_late(spark, wanted):
    random = np.random.default_rng(2)
    vectors = (random.standard_normal((300, 7)) @ random.standard_normal((7, 7)) * 100).tolist()
    check(whiten(frame(spark, vectors), components=wanted).collect(), vectors, list(range(300)), wanted)


def test_lost_rank_and_equal_values(spark):
    random = np.random.default_rng(3)
    low = random.integers(-5, 5, (60, 2)).astype(float)
    vectors = np.column_stack([low, low.sum(axis=1), np.ones(60)]).tolist()
    check(whiten(frame(spark, vectors)).collect(), vectors, list(range(60)))
    # three equal eigenvalues: single components are free, the whitened vectors keep their lengths
    cube = [[sign * (i == j) for j in range(3)] for i in range(3) for sign in (1.0, -1.0)]
    got = whiten(frame(spark, cube)).collect()
    for i in range(6):
        assert sum(r["whitened"] ** 2 for r in got if r["vec_id"] == i) == pytest.approx(3)


def test_nothing_varies(spark):
    assert whiten(frame(spark, [[1.0, 2.0]] * 3)).count() == 0
    assert whiten(frame(spark, [[1.0]])).count() == 0
    assert whiten(frame(spark, [[], []])).count() == 0
    assert whiten(frame(spark, [None, [float("nan")]])).count() == 0
    with pytest.raises(ValueError):
        whiten(frame(spark, [[1.0], [1.0, 2.0]]))
