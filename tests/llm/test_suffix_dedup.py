"""Repeated 50-byte strings against a dictionary of all of them."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.llm import suffix_dedup, suffixes
from strandwise.llm.common import FOLDERS
from strandwise.llm.suffix_dedup import _among, deduplicate, removed_bytes
from strandwise.llm.suffixes import runs


def plain(rows, depth=50):
    first = {}
    data = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - depth + 1):
            w = b[i : i + depth]
            first[w] = min(d, first.get(w, d))
    out = []
    for (d, b), (own, _) in zip(data, rows):
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if first[b[i : i + depth]] < d:
                mask[i : i + depth] = True
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(mask[i] and not (i and mask[i - 1]) for i in range(len(b)))
        out.append((own, len(b), int(mask.sum()), int(spans), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


LAST = (1 << 63) - 1


def got(df, **kw):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in deduplicate(df, **kw).collect()), key=repr)


def test_runs_hold_every_window_once(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab", k=700)), b"a" * 300, b"", bytes(rng.randbytes(500)), b"x" * 49, b"y" * 50, b"z" * 51]
    for piece in (1 << 21, 256):
        monkeypatch.setattr(suffixes, "PIECE", piece)
        seen = []
        for r in runs(texts, 50):
            rows = np.arange(len(r.first))
            for right in (True, False):
                start, owner = r.windows(rows, np.full(len(rows), right))
                place = start + r.shift[owner]
                seen += zip(r.text[owner].tolist(), place.tolist())
                for t, p, s in zip(r.text[owner].tolist(), place.tolist(), start.tolist()):
                    assert r.data[s : s + 50].tobytes() == texts[t][p : p + 50]
            assert (r.at >= r.last).all() and (r.at <= r.first + 34).all()
        assert sorted(seen) == [(t, i) for t, x in enumerate(texts) for i in range(max(0, len(x) - 49))]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in want) > 0
    assert got(docs) == want


@pytest.mark.parametrize("depth", [50, 20])
def test_edited_copies_and_few_letters(spark, depth):
    rng = random.Random(7)
    base = "".join(rng.choices("ab ", k=400))
    long = "".join(rng.choices("abcdefghé ", k=3000))
    rows = []
    for i in range(60):
        a = rng.randrange(len(long) - 200)
        text = list(rng.choice((base, long[a : a + rng.randrange(30, 200)], "z" * rng.randrange(120), long)))
        for _ in range(rng.randrange(4)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("xyß")
        rows.append((rng.randrange(50), "".join(text)))
    rows += [(None, long), (None, long), (5, None), (6, ""), (7, "short"), (7, "short")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, doc string")
    assert got(docs, depth=depth) == plain(rows, depth)


def test_pieces_of_very_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    shared = "".join(rng.choices("abcdefgh", k=2000))
    rows = [(i, "".join(rng.choices("abcdefgh", k=300)) + shared) for i in range(3)]
    data = rows[2][1].encode()
    whole = np.concatenate([r.names(np.arange(len(r.first))) for r in runs([data], 50)])
    monkeypatch.setattr(suffixes, "PIECE", 256)
    cut = [r for r in runs([data], 50)]
    assert len(cut) > 5 and sum(int((r.last - r.first + 1).sum()) for r in cut) == len(data) - 49
    assert len(np.intersect1d(whole, np.concatenate([r.names(np.arange(len(r.first))) for r in cut]))) > 0.7 * len(whole)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_empty_table(spark):
    assert deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_only_texts_with_names_are_cut(monkeypatch):
    rng = random.Random(2)
    texts = [bytes(rng.randbytes(200)) for _ in range(4)]
    (whole,) = runs(texts, 50)
    ask, cut, asked = np.flatnonzero(whole.text == 1)[:1], [], []
    start, owner = whole.windows(np.flatnonzero(whole.text == 3)[:1], np.array([True]))
    names = whole.names(ask), whole.window_names(start)[-1:]

    def seen(some, depth):
        cut.append([len(t) for t in some])
        for r in runs(some, depth):
            plainly = r.windows
            r.windows = lambda rows, right: asked.extend(r.text[rows].tolist()) or plainly(rows, right)
            yield r

    monkeypatch.setattr(suffix_dedup, "runs", seen)
    masks = removed_bytes(texts, 50, (names[0], np.array([1])), (names[1], np.array([3])))
    length = int(whole.last[ask[0]] - whole.first[ask[0]]) + 50
    assert [int(m.sum()) for m in masks] == [0, length, 0, 50]
    assert cut == [[0, 200, 0, 200]] and set(asked) == {3}


@pytest.mark.parametrize("count", [0, 1, 5000])
def test_names_are_found_among_others(count):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 64, 20000, dtype=np.uint64)
    values[:4] = [0, (1 << 64) - 1, 7, 7]
    names = np.unique(values[: 2 * count : 2]) if count else values[:0]
    assert (_among(values, names) == np.isin(values, names)).all()


def test_runs_are_not_kept_beside_the_texts(spark, monkeypatch):
    sizes, keep = [], suffix_dedup.written

    def told(df, folder=None):
        out = keep(df, folder)
        sizes.append(sum(f.stat().st_size for f in Path((folder or FOLDERS[-1]).removeprefix("file://")).iterdir()))
        return out

    monkeypatch.setattr(suffix_dedup, "written", told)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    deduplicate(docs)
    assert sum(sizes) < 0.8 * docs.agg(F.sum(F.octet_length("text"))).first()[0], sizes
