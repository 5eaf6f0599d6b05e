"""Ranked search against a plain loop and the SQL oracle."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from strandwise.llm import lexical
from strandwise.llm.lexical import TERM, Block, search, terms, tiles

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return re.findall(TERM, (text or "").translate(FOLD))


def brute(docs, items, k):
    words = [Counter(plain_terms(t)) for _, t in docs]
    n = [sum(w.values()) for w in words]
    total, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for w in words for t in w)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), w, size in zip(docs, words, n):
            m = 75 + 25 * size * total // max(length, 1)
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * w[t] // (1000 * w[t] + 12 * m))
                for t in plain_terms(text) if w[t])
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


DOCS = [
    (1, "The cat, the CAT and a dog"), (2, "the cat, the cat and a dog"), (3, None), (4, ""), (5, "...!"), (None, "cat"),
    (7, "Übercat straße \x00 cat9 x_y"), (8, "dog " * 5000), (9, "dog"), (9, "dog"), (10, "ÀB àb élan"), (11, "zebra"),
]
ITEMS = [(1, "cat cat dog"), (2, None), (3, ""), (4, "the the the a"), (5, "nowhere"), (None, "dog"), (6, "X Y"), (6, "ÀB élan"), (7, "cat cat dog")]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_odd_rows(spark, k, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 4)  # several blocks
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, item string, score int")
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, doc_id int")
    got = sorted(map(tuple, search(docs, items, k).collect()), key=repr)
    assert got == brute(DOCS, ITEMS, k)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id string, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert search(docs, items).count() == 0
    assert search(spark.createDataFrame([("d", "a")], "doc_id string, text string"), items.limit(0)).count() == 0
    assert [tuple(r) for r in search(spark.createDataFrame([("e", "b"), ("d", "a")], docs.schema), items).collect()][0][:3] == (1, 1, "d")


def test_terms():
    for _, text in DOCS:
        assert [t.decode() for t in terms(text)] == plain_terms(text)


def test_partial_sums_stay_exact():
    counts = np.array([10**6, 3 * 10**6, 5])
    block = Block(np.array([7]), [b"a", b"b", b"c"], np.array([0, 0, 0]), np.array([0, 1, 2]), counts)
    weight = np.array([20_000, 15_000, 0])
    parts = tiles(block, weight)[0].parts
    sums = np.zeros(3, dtype=object)
    for words, table in parts:
        assert table.sum(axis=0).max() * lexical.IMPACT < lexical.EXACT
        for t, row in zip(words, table):
            sums[t] += int(row[0])
    assert sums.tolist() == [2 * 10**10, 45 * 10**9, 0] and len(parts) > 1


def test_many_ties_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TILE_DOCS", 16)
    monkeypatch.setattr(lexical, "HELD", 8)
    monkeypatch.setattr(lexical, "TILE_TERMS", 1)
    docs = [(i, ["alpha beta", "alpha", "beta gamma alpha"][i % 3]) for i in range(300, 0, -1)]
    items = [(1, "alpha beta"), (2, "gamma gamma")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = search(frame, spark.createDataFrame(items, "item_id long, text string"), 25)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 25)
