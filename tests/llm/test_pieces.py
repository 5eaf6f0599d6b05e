"""Marked-word tables against the library on whole texts."""

import hashlib

import numpy as np
import pytest

from strandwise.llm.pieces import Model, decode, encode
from strandwise.llm.queries import QUERIES, table, tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b   c  ", "▁x ▁▁ y", "a\n\nb　c\td", "<s>x</s> <0x0A> <unk>", "a\x00b",
    "überﬁ \U0001f600\U0001f600", "x" * 70, "word " * 3000, "y" * 20000 + " z", "same", "same", "café", "​﻿",
]


@pytest.fixture(scope="module")
def library():
    return Model(MODEL).library


def check(rows, library):
    for r in rows:
        want = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want, r["text"]
        assert r["decoded"] == library.decode(want)


@pytest.mark.parametrize("held", [0, 3, 1 << 17])
def test_odd_texts(spark, library, held):
    docs = spark.createDataFrame([(i, t, "old", "e") for i, t in enumerate(ODD)], "n int, text string, ids string, decoded string")
    rows = decode(encode(docs, MODEL, held=held), MODEL).collect()
    assert len(rows) == len(ODD)
    check(rows, library)


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], "text string")
    assert decode(encode(docs, MODEL), MODEL).count() == 0
    rows = spark.createDataFrame([(None,), (b"",)], "ids binary")
    assert {r["decoded"] for r in decode(rows, MODEL).collect()} == {None, ""}


def test_models_that_cross_white_space_take_whole_texts(spark, library):
    model = Model(MODEL)
    assert model.by_chunk
    model.by_chunk = False
    texts = [t for t in ODD if t]
    found = model.encode(texts, {})
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == library.encode(texts, add_bos=True, add_eos=True)


def test_query_equals_the_library(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op13_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        want = (len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids).encode())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (want[0], *(hashlib.sha256(b).hexdigest() for b in want[1:]))
