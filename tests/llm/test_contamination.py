"""Containment search against exact shingle sets."""

import random
import re

import numpy as np

from strandwise.llm.contamination import _searches, contained, shingle_hashes, window_minima, word_hashes


def plain_words(text):
    return re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", text or "")


def plain_shingles(text):
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in plain_words(text)]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(docs, items, least=0.8):
    sets = [(i, plain_shingles(t)) for i, t in items]
    out = []
    for d, t in docs:
        own = plain_shingles(t)
        for i, s in sets:
            if s and len(s & own) >= least * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=repr)


def test_word_hashes_tell_words_apart():
    text = "The cat's hat; été  THE the\tx1 été"
    words = [w.lower() if w.isascii() else w for w in plain_words(text)]
    hashes, owner = word_hashes(["", text, None, "the", " " * 999 + "THE.", "no"])
    one = hashes[owner == 1]
    assert one[0] == hashes[owner == 3] == hashes[owner == 4] and (owner != 0).all() and (owner != 2).all()
    names, of = shingle_hashes(hashes, owner, 5)
    assert len(names) == len(words) - 4 and set(of.tolist()) == {1}
    hashes = one
    assert len(hashes) == len(words)
    assert len(set(hashes.tolist())) == len(set(words))


def test_windows_hold_every_run_of_the_largest_size():
    rng = np.random.default_rng(1)
    for n in (1, 5, 30, 97):
        x = rng.integers(0, 1 << 62, n).astype(np.uint64)
        for largest in (1, 2, 7, 30):
            minima = set(window_minima(x, largest).tolist())
            step = max(1, -(-largest // 2))
            runs = [x[i * step : (i + 3) * step].min() for i in range(max(1, -(-n // step) - 2))]
            assert minima == set(runs)
            for at in range(max(1, n - largest + 1)):
                assert any(i * step <= at and min(n, at + largest) <= (i + 3) * step for i in range(max(1, -(-n // step) - 2)))


def test_whole_tables(spark):
    for folder in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
        items = spark.read.parquet(f"/root/testdata/{folder}/benchmark.parquet")
        got = sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in contained(docs, items).collect()), key=repr)
        want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
        assert got == want and want


def test_edited_copies_and_odd_rows(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate((5, 6, 9, 14, 30, 33, 60, 250, 4, 0))] + [(98, None), (99, "five words are in this")]
    docs = [(1, None), (2, ""), (3, "Five, words ARE in this!"), (None, items[4][1]), (4, items[4][1]), (4, items[4][1])]
    for k in range(200):
        text = rng.choices(words, k=rng.choice((0, 40, 4000)))
        i, t = items[rng.randrange(8)]
        part = t.split()
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = "edit"
        at = rng.randrange(len(text) + 1)
        docs.append((100 + k, " ".join(text[:at] + part + text[at:])))
    d = spark.createDataFrame([(*r, "c") for r in docs], "doc_id long, text string, containment string")
    b = spark.createDataFrame([(*r, "c") for r in items], "item_id int, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in contained(d, b, item_block=5).collect()), key=repr)
    want = plain(docs, items)
    assert got == want and len(want) > 40
    assert contained(d, b.limit(0)).count() == contained(d.limit(0), b).count() == 0


def test_blocks_by_bytes(spark):
    """Few items of much text are several searches with the same result; set-up cuts each item's shingles."""
    items = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(40))) for i in range(12)] + [(50, None), (51, "")], "item_id int, text string")
    docs = spark.createDataFrame([(i, f"before it {' '.join(f'i{i}w{k}' for k in range(40))} after") for i in range(12)], "doc_id int, text string")
    size = sum(len(r.text or "") for r in items.collect())
    searches = list(_searches(spark, items, "item_id", "text", 5, 0.8, 1000, 32, size // 4))
    assert len(searches) > 1
    found = []
    for s in searches:
        s.begin()
        assert [len(x) for x in s.sets] == [max(0, len((t or "").split()) - 4) for t in s.shared.value[1]]
        found += [s.ids[i].as_py() for _, i, _ in s([r.text for r in docs.collect()])]
    assert sorted(found) == list(range(12)) == sorted(r.item_id for r in contained(docs, items).collect())
