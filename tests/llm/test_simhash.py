"""SimHash links and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strandwise.llm.graph import components
from strandwise.llm.simhash import Part, fit, links, near_duplicates, thresholds


def plain_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, reach=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    arr = np.array(fps, np.uint64)
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(arr ^ arr[i]) <= reach)[0]:
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fp(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r.doc_id for r in rows], fps))}
    assert {tuple(r) for r in near_duplicates(docs).collect()} == want


@pytest.mark.parametrize("reach", [1, 2, 3, 5])
def test_links_lose_nothing(spark, reach):
    rng = random.Random(reach)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base) | {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(12)}
    fps |= {b ^ i for b in base[:3] for i in range(40)}  # many share all but the lowest bits
    signed = sorted(int(np.uint64(f).view(np.int64)) for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {tuple(r) for r in links(df, reach, fit_rows=200).collect()}
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if (a ^ b & (1 << 64) - 1) & (1 << 64) - 1 and ((a ^ b) & (1 << 64) - 1).bit_count() <= reach}
    assert got == want


def test_thresholds_keep_the_pigeonhole_sum():
    cost = np.array([[0, 1, 5, 9, 20], [0, 30, 40, 50, 60], [0, 2, 3, 9, 30]], float)
    total, chosen = thresholds(cost, 3)
    assert sum(t + 1 for t in chosen) == 4 and total == 1 + 9 or total == 5 + 3
    parts = fit(np.arange(1000, dtype=np.uint64) * 7919, 10**6, 3)
    assert sum(p.threshold + 1 for p in parts) == 4
    assert len(set().union(*(p.bits for p in parts))) == sum(len(p.bits) for p in parts)


def test_part_values(spark):
    part = Part((0, 1, 5, 6, 63), 1)
    fp = -(1 << 63) | 0b0100010
    row = spark.createDataFrame([(fp,)], "fp long").select(part.value(F.col("fp")).alias("v")).first()
    assert row.v == 0b10110 >> 0 or row.v == (0b10 | 0b01 << 2 | 1 << 4)
    assert len(part.masks()) == 6


def test_odd_rows(spark):
    long_text = "word " * 50_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "y"), (4, "One two", "y"), (5, "one TWO", None), (5, "one two", None), (6, long_text, "z"), (7, long_text + "word", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6)}
    assert near_duplicates(docs).count() == 8
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    nodes = spark.createDataFrame([(i,) for i in [*range(0, 301), *range(1000, 1300), 5000]], "n long")
    got = dict(map(tuple, components(nodes, spark.createDataFrame(chain + star, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1300), 1000), 5000: 5000}
