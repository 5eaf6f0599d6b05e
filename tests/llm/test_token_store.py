"""Token ids and their store against direct encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strandwise.llm.subwords import Encoder
from strandwise.llm.token_store import ENTRY, Index, PerfectHash, index_bytes, round_trip

FILE = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "It's THE cat's, they'll we've I'm 'sup 'T", "a b c　d", "x\x1cy \x1f z\x85w", "İstanbul ΣΊΣΥΦΟΣ ſt ﬁ Å Å",
    "<|endoftext|> a<|startoftext|>b <| endoftext |>", "日本語 テキスト 123４５ ½² ª", "😀👍🏽 zürich straße ÀÉ", "é ́x ñ", "tab\there\r\nnew\vline\fff",
    "don't’s “q” … – —", "​zero‍width ﻿ bom", "x" * 3000, "ab'scd 'reab", "İı ǅ ǆ ǅ", "ß ẞ ẞ ŉ", "a" + "́" * 40, "؀؁ ١٢",
]


def test_encoder_equals_the_library(spark):
    whole = Tokenizer.from_file(FILE)
    texts = ODD + [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    encoder = Encoder(FILE, kept=5000)
    for text in texts + ODD:
        assert encoder.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text[:80]


def test_other_tokenizers_take_the_library_s_way():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert Encoder(path).encode("Two words").tolist() == Tokenizer.from_file(path).encode("Two words").ids


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 100, 20_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        function, left = PerfectHash.build(keys)
        assert not len(left)
        assert sorted(function(keys).tolist()) == list(range(len(keys)))


def test_index_tells_equal_keys_and_strangers_apart():
    keys = np.array([5, 5, 7, 9, 11], np.uint64)  # two documents share a 64-bit hash
    table = np.zeros(5, ENTRY)
    table["check"], table["n"] = [1, 2, 3, 4, 5], [10, 20, 30, 40, 50]
    index = Index(index_bytes(keys, table))
    assert index.find(keys, np.array([1, 2, 3, 4, 5], np.uint32))["n"].tolist() == [10, 20, 30, 40, 50]
    strangers = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert not index.find(strangers, np.full(1000, 99, np.uint32))["n"].any()


def plain(rows):
    whole = Tokenizer.from_file(FILE)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted((tuple(r) for r in round_trip(docs, FILE, bucket=300).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice((None, 1, 2, 3, -7, 1 << 60)), t) for t in ODD * 3] + [(50, None), (51, "word " * 50_000), (50, None)]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, start int")
    assert sorted((tuple(r) for r in round_trip(docs, FILE).collect()), key=repr) == plain(rows)
    assert round_trip(docs.limit(0), FILE).count() == 0
