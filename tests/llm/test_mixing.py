"""Mixing against a plain loop over the contract's rules."""

import heapq
import re
from collections import Counter, defaultdict

import pytest

from strandwise.llm.mixing import mix, mixed_documents, sainte_lague, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Deal out, stop at the cap, deal the excess again, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        now = {s: left * weight[s] / total for s in rest}
        over = [s for s in rest if now[s] > cap * sizes[s]]
        if not over:
            return full | now
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


def rows_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")


def test_against_the_rules(spark, sf_dir):
    docs = rows_of(spark, sf_dir)
    got = mix(docs).collect()
    text = {r.doc_id: r for r in docs.collect()}
    assert len(got) == len(text)
    sizes = defaultdict(int)
    for r in text.values():
        sizes[r.source] += len(WORDS.findall(r.text or ""))
    want = plain_targets(sizes)
    taken = Counter()
    for r in got:
        source = text[r.doc_id].source
        assert r["size"] == len(WORDS.findall(text[r.doc_id].text or ""))
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 64
    again = {r.doc_id: r.taken for r in mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in got}


def test_taken_words_are_those_of_the_chosen_blocks(spark):
    docs = spark.createDataFrame([(i, "w " * (7 * i % 50), f"s{i % 3}") for i in range(90)], "doc_id long, text string, source string")
    for r in mix(docs, block=5, shard=200).collect():
        if r.blocks is None:
            assert r.taken == 0 == r["size"]
            continue
        b = r.blocks
        times = lambda k: b.quota // b.n + ((k * 2_654_435_761 + b["shift"]) % b.n < b.quota % b.n)
        assert r.taken == sum(times((b.offset + w) // 5) for w in range(r["size"]))


def test_highest_quotients(spark):
    votes = {"a": 53, "b": 24, "c": 23, "d": 11, "e": 0, "f": 3}
    for seats in (0, 1, 7, 40, 101):
        quotas = dict.fromkeys(votes, 0)
        for _ in range(seats):
            quotas[min(votes, key=lambda p: (-votes[p] / (2 * quotas[p] + 1), p))] += 1
        df = spark.createDataFrame([(1, p, v, seats) for p, v in votes.items()], "g int, p string, v long, n long")
        assert {r.p: r.quota for r in sainte_lague(df, ["g"], "p", "v", "n").collect()} == quotas


def test_one_large_and_thousands_of_tiny_parties(spark):
    for large, tiny, n, seats in ((100_000, 4, 20_000, 1000), (7, 7, 18_000, 777)):
        votes = {0: large} | {i: tiny for i in range(1, n + 1)}
        heap = [(-v, p) for p, v in votes.items()]
        heapq.heapify(heap)
        quotas = dict.fromkeys(votes, 0)
        for _ in range(seats):
            p = heap[0][1]
            quotas[p] += 1
            heapq.heapreplace(heap, (-votes[p] / (2 * quotas[p] + 1), p))
        df = spark.createDataFrame([(p, v, seats) for p, v in votes.items()], "p long, v long, n long")
        got = {r.p: r.quota for r in sainte_lague(df, [], "p", "v", "n").collect()}
        assert got == quotas


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "w x y z " * 9, "s", 1, 2, 3, 4) for i in range(20)], "doc_id long, text string, source string, taken int, blocks int, size int, _row int")
    mixed = mixed_documents(docs.union(docs.limit(2)))
    assert mixed.columns == docs.columns and {tuple(r)[3:] for r in mixed.collect()} == {(1, 2, 3, 4)}


def test_odd_rows(spark):
    rows = [(1, None, "a", 9), (2, "", None, 9), (None, "one two", None, 9), (3, "x " * 3000, "a", 9), (3, "x " * 3000, "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(docs).collect()
    assert len(got) == 5
    assert sum(r.taken for r in got if r.doc_id == 3) == pytest.approx(got[0].target if got[0].doc_id in (1, 3) else got[-1].target, abs=64)
    assert mix(docs.limit(0)).count() == 0


def test_caps_hand_on_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 20, None: 300}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(df, (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(plain_targets(sizes))
