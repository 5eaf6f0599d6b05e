"""SentencePiece ids through a table of distinct marked words.

The library writes a white space marker before each word, and where no piece holds a marker
behind another sign, no merge ever crosses into the next marked word (its markers and what
follows them up to the next marker). So each such chunk is segmented by itself: Spark counts
the distinct chunks of all documents and segments each of the frequent ones once, tasks hold
that table, and a document's ids are its chunks' ids joined by position. A chunk that the
table lacks is segmented, once, by the task that meets it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import written

#: The most frequent chunks, whose ids every task holds, and the bytes of the longest of them.
HELD_CHUNKS, HELD_BYTES = 1 << 17, 64
#: Further chunks whose ids a Python worker keeps from one batch to the next.
KEPT_CHUNKS = 300_000
#: Characters of text that are worked on together.
ROOM = 2 << 20
MARK = "▁"
#: A chunk without its first marker, in a text that begins with a marker.
_CHUNK = re.compile(r" ( *[^ ]*)")
_CROSSING = re.compile(f"[^{MARK}]{MARK}")


class Model:
    """A SentencePiece model file in this process."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = spec.normalizer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
        plain = plain and not normal.remove_extra_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
        bpe = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        by_chunk = plain and bpe and not any(_CROSSING.search(p.piece) or p.type == p.USER_DEFINED for p in spec.pieces)
        #: Can texts be cut into marked words? Else they are encoded whole.
        self.by_chunk = bool(by_chunk)
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        self.kept: dict[str, bytes] = {}

    def chunks(self, text: str | None) -> list[str]:
        """The marked words, each without its first marker; the encoder puts that back. An empty text has none."""
        if not text:
            return []
        if not self.by_chunk:
            return [text]
        text = text.replace(MARK, " ")
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return text.split(" ")
        return _CHUNK.findall(" " + text)

    def segment(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk as little-endian unsigned 32-bit integers; a marker alone is one piece."""
        mark = [self.library.piece_to_id(MARK)]
        found = zip(chunks, self.library.encode(chunks, num_threads=1), strict=True)
        return [np.array(ids if c else mark, "<u4").tobytes() for c, ids in found]

    def encode(self, texts: list[str | None], held: dict[str, bytes]) -> list[bytes]:
        """The ids of each text between the begin and the end id. What ``held`` lacks is segmented once."""
        found = [self.chunks(t) for t in texts]
        new = list({c for cs in found for c in cs}.difference(held, self.kept))
        ids = dict(zip(new, self.segment(new), strict=True))
        table = _Joined(held, self.kept, ids)
        out = [self.begin + b"".join([held.get(c) or table[c] for c in cs]) + self.end for cs in found]
        for c in new:
            if len(self.kept) >= KEPT_CHUNKS:
                break
            if len(c) <= HELD_BYTES:
                self.kept[c] = ids[c]
        return out


class _Joined:
    """The first of several tables that holds a chunk."""

    def __init__(self, *tables: dict[str, bytes]):
        self.tables = tables

    def __getitem__(self, chunk: str) -> bytes:
        return next(t[chunk] for t in self.tables if chunk in t)


@cache
def task_model(path: str) -> Model:
    """The model of a Python worker."""
    return Model(path)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Where a group of about ``ROOM`` characters begins, and its texts."""
    first, held, size = 0, [], 0
    for i in range(len(texts)):
        held.append(texts[i].as_py())
        size += len(held[-1] or "")
        if size >= ROOM:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def count_chunks(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``(chunk, n)``: the distinct marked words of all texts and how often they stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = task_model(model).chunks
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                found = Counter()
                for t in texts:
                    found.update(cut(t))
                yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["chunk", "n"])

    return docs.select(text).mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(docs: DataFrame, model: str, text: str = "text", held: int = HELD_CHUNKS) -> DataFrame:
    """``(chunk, ids)`` of the most frequent marked words, at most ``held``, each segmented once.

    All chunks of a count or none are in it: the counts of the counts tell where to stop.
    """
    counts = written(count_chunks(docs, model, text).where(F.octet_length("chunk") <= HELD_BYTES))
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n")).limit(held).toArrow()
    total = np.cumsum(steps["rows"].to_numpy())
    steps = steps["n"].to_numpy()[: int((total <= held).sum())]
    frequent = counts.where(F.col("n") >= int(steps[-1])) if len(steps) else counts.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = task_model(model).segment(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], ["chunk", "ids"])

    return frequent.select("chunk").mapInArrow(run, "chunk string, ids binary")


def encode(docs: DataFrame, model: str, text: str = "text", held: int = HELD_CHUNKS) -> DataFrame:
    """``docs`` with ``ids``: the begin id, the text's ids and the end id as little-endian unsigned 32-bit integers.

    The ids are those of the library's ``encode`` without sampling. A null text counts as
    empty (two ids); repeated rows are rows like any other; an empty table gives no rows;
    a column ``ids`` that ``docs`` has already is replaced. Model files whose pieces cross
    white space, or that change the text, are applied to whole texts.
    """
    docs = docs.drop("ids")
    if task_model(model).by_chunk:
        table = chunk_table(docs, model, text, held).toArrow()  # at most `held` chunks of HELD_BYTES
        table = dict(zip(table["chunk"].to_pylist(), table["ids"].to_pylist(), strict=True))
    else:
        table = {}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(at)):
                ids = task_model(model).encode(texts, shared.value)
                part = batch.slice(first, len(texts))
                yield pa.record_batch([*part.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    return docs.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), "ids binary"]))


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text that the library's ``decode`` makes of the ids; null ids give null.

    A column ``decoded`` that is there already is replaced.
    """
    rows = rows.drop("decoded")
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = task_model(model).library
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                found, size, last = [], 0, first
                while last < batch.num_rows and size < ROOM:
                    found.append(batch.column(at)[last].as_py())
                    size += len(found[-1] or b"")
                    last += 1
                texts = iter(library.decode([np.frombuffer(f, "<u4").tolist() for f in found if f is not None], num_threads=1))
                part = batch.slice(first, last - first)
                decoded = pa.array([None if f is None else next(texts) for f in found], pa.string())
                yield pa.record_batch([*part.columns, decoded], [*batch.schema.names, "decoded"])
                first = last

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "decoded string"]))
