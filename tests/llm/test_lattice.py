"""Lattice hashing against all pairs."""

import math

import numpy as np

from strandwise.llm.lattice import decode, near_duplicates, neighbours
from strandwise.llm.queries import QUERIES


def plain(ids, vectors, least=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(ids)
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(vectors, ok)]
    link = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= least] for i in range(n)]
    comp = list(ids)
    while True:
        now = [min([comp[i], *(comp[j] for j in link[i])]) for i in range(n)]
        if now == comp:
            break
        comp = now
    return sorted((ids[i], len(link[i]), comp[i], ids[i] == comp[i]) for i in range(n))


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(500, 8)) * 3
    point = decode(y)
    around = neighbours()
    assert len(np.unique(around, axis=0)) == 240 and np.allclose((around**2).sum(axis=1), 2)
    twice = np.rint(point * 2)
    assert np.allclose(twice, point * 2) and (np.ptp(twice % 2, axis=1) == 0).all() and (point.sum(axis=1) % 2 == 0).all()
    own = ((y - point) ** 2).sum(axis=1)
    assert (own[:, None] <= ((y[:, None] - point[:, None] - around) ** 2).sum(axis=2) + 1e-9).all()


def clustered(seed, n=1500, dim=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, dim))
    x = []
    for i in range(n):
        c = centres[i % len(centres)]
        spread = (0.0, 0.01, 0.05, 0.2, 0.3, 0.33)[i % 6]
        x.append(c / np.linalg.norm(c) + spread * rng.normal(size=dim) / math.sqrt(dim))
    x += [centres[0] * 3 + 0.001 * rng.normal(size=dim) for _ in range(200)]  # one large bunch
    return np.array(x, np.float32)


def test_recall_and_no_false_link(spark):
    x = clustered(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    true = (u @ u.T >= 0.95).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= true).all()
    assert found.sum() >= 0.97 * true.sum()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = sorted(tuple(r) for r in QUERIES["op9_embedding_near_dedup"](spark, sf).collect())
    assert got == plain([r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [nan] * 4), (6, [inf, 0.0, 0.0, 0.0]),
        (7, a), (8, a), (8, a), (9, [2.0, 0.1, 0.0, -0.0]), (10, b), (11, [1.0, 0.0]), (12, [1e30, 0.0, 0.0, 0.0]), (13, [1e-30, 0.0, 0.0, 0.0]),
        (14, [-1.0, 0.0, 0.0, 0.0]), (15, [nan] * 4),
    ]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cls string")
    assert sorted(map(tuple, near_duplicates(df).collect())) == plain([r[0] for r in rows], [r[1] for r in rows])
    assert near_duplicates(df.limit(0)).count() == 0


def test_chains_link_through(spark):
    step = math.acos(0.95) * 0.9
    rows = [(100 - i, [math.cos(i * step), math.sin(i * step), 0.0, 0.0]) for i in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, near_duplicates(df).collect())) == plain([r[0] for r in rows], [r[1] for r in rows])


def test_candidates_do_not_all_lie_on_disk_at_once(spark, monkeypatch):
    from strandwise.llm import lattice

    plans, keep = [], lattice.written

    def told(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, *args)

    monkeypatch.setattr(lattice, "written", told)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(60, 16)).astype(np.float32)
    x[30:] = x[:30] + 0.01
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = lattice.near_duplicates(docs).orderBy("vec_id").collect()
    assert [r.component_id for r in got] == [*range(30), *range(30)]
    # the cells of one table, or the cosines of one share of the pairs; not all cells and the cosines
    held = [{c for c in ("cell", "verdict") if f"{c}#" in p} for p in plans]
    assert (held.count({"cell"}), held.count({"cell", "verdict"})) == (lattice.TABLES, 0), held
    assert held.count({"verdict"}) >= lattice.SHARES, held
