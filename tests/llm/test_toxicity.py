"""Segments against brute force; the classifier on held-out and planted documents."""

import random

import pytest
from pyspark.sql import functions as F

from strandwise.llm.common import fold
from strandwise.llm.queries import QUERIES
from strandwise.llm.toxicity import DRIFT, Model, fit, log_odds, maximal_segments, score


def plain_segments(values):
    """Best segment first, then the same left and right of it (shortest, leftmost on ties)."""
    best = None
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            s = sum(values[i:j])
            if s > 0 and (best is None or s > best[0] or s == best[0] and j - i < best[2] - best[1]):
                best = s, i, j
    if best is None:
        return []
    s, i, j = best
    shifted = [(t, a + j, b + j) for t, a, b in plain_segments(values[j:])]
    return plain_segments(values[:i]) + [best] + shifted


def test_all_maximal_segments():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 26)
        scores = {i: rng.choice((-3, -1, 2, 4, 7)) for i in range(n) if rng.random() < 0.6}
        values = [scores.get(i, 0) - 1 for i in range(n)]
        assert maximal_segments(sorted(scores.items()), 1) == plain_segments(values)


def test_a_long_staircase_is_scanned_in_linear_time():
    hits = [(i, 2.0 if i % 2 else -2.0) for i in range(200_000)]
    assert len(maximal_segments(hits, 0.0)) == 100_000


def test_log_odds_need_evidence():
    assert log_odds(100, 0, 400, 3000) > log_odds(20, 0, 400, 3000) > 0
    assert log_odds(1, 0, 400, 3000) == 0 == log_odds(0, 0, 400, 3000)
    assert log_odds(0, 2000, 400, 3000) < 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    # an eighth of the toxic labels lie on texts without any toxic word
    assert sum(s >= 0.5 for s in toxic) > 0.8 * len(toxic)
    assert sum(s >= 0.5 for s in clean) < 0.01 * len(clean)
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) > 0.92 * len(toxic) * len(clean)


def planted(spark, n=1200):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(400)]
    bad = ["vile", "rotten", "filth"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.choice((5, 60, 900)))
        if i % 8 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [*rng.choices(bad, k=2), "you", rng.choice(bad)]
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 8 == 0)))
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_planted_passages(spark):
    docs, labels = planted(spark)
    model = fit(docs, labels, fold("doc_id") != 0)
    rows = score(docs, model).collect()
    assert all((r.predicted == 1) == (r.doc_id % 8 == 0) for r in rows)
    assert any("vile" in p.text or "rotten" in p.text or "filth" in p.text for r in rows for p in r.passages)
    assert all(any(t in p.text for t in ("vile", "rotten", "filth")) for r in rows for p in r.passages)


def test_odd_rows(spark):
    docs, labels = planted(spark)
    model = fit(docs, labels.union(labels.limit(5)), F.lit(True))
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "vile rotten filth"), (4, "word1 " * 100_000), (5, "vile " * 100_000)], "doc_id long, text string")
    got = score(odd, model).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].predicted == by[2].predicted == by[4].predicted == 0
    assert by[None].predicted == by[5].predicted == 1
    assert score(odd.limit(0), model).count() == 0
    nothing = fit(docs, labels.limit(0), F.lit(True))
    assert {r.predicted for r in score(odd, nothing).collect()} == {0}
    one_class = fit(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.predicted for r in score(odd, one_class).collect()} == {0}
    assert fit(docs.limit(0), labels, F.lit(True)).weights == {}


def test_evidence_grows_with_score_and_shrinks_with_length():
    m = Model({"bad": (4.0, 4.0, 4.0)}, decay=1.0, rate=0.1, slope=1.0, offset=-3.0)
    assert m.segments(["a", "bad", "a"]) == [(pytest.approx(4.0 - DRIFT), 1, 2)]
    few, many = m.segments(["bad"] * 2), m.segments(["bad"] * 5)
    assert m.evidence(10, many) > m.evidence(10, few) > m.evidence(1000, few) >= m.evidence(1000, []) == 0
