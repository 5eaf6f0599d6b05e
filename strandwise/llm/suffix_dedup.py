"""Repeated substrings by a depth-limited radix sort of all suffixes.

Suffixes are ordered by their first ``depth`` bytes only, one digit after the other, and a
group that lies in one document leaves at once. A suffix's digits are read from its anchor
outwards (see ``suffixes``): the anchor itself, then the whole run it travels in, then half
a window on one side of the anchor, then the window. Equal groups after the last digit are
exactly the repeated windows. The first two digits share one shuffle, in which a run stands
once for each document, so a group as large as a third of all suffixes costs one row per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.llm.common import discard, scratch, written
from strandwise.llm.suffixes import Runs, runs

#: Stands for a null document id: after all others.
LAST = (1 << 63) - 1
#: Rows of a batch that are worked on together.
ROWS = 2048
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[bytes]]]:
    """Some rows at a time: the rows, their documents (first column) and their texts (second)."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            yield part, part.column(0).to_numpy(), [(t.as_py() or "").encode() for t in part.column(1)]


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the row of each."""
    rows = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), rows


def _of(names: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Names told apart by the row they belong to."""
    return names + row.astype(np.uint64) * _ODD


def _among(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which ``values`` are among ``names`` (sorted, distinct): a table of hashed bits leaves few to be looked up."""
    if not len(names):
        return np.zeros(len(values), bool)
    bits = min(max(10, (8 * len(names)).bit_length()), 24)
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[(names * _MIX) >> shift] = True
    found = table[(values * _MIX) >> shift]
    likely = np.flatnonzero(found)
    at = np.minimum(np.searchsorted(names, values[likely]), len(names) - 1)
    found[likely] = names[at] == values[likely]
    return found


def _distinct(doc: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Places of the distinct pairs, hardly any of them twice."""
    order = np.argsort(_of(content, doc))
    doc, content = doc[order], content[order]
    return order[np.concatenate((np.ones(min(1, len(order)), bool), (doc[1:] != doc[:-1]) | (content[1:] != content[:-1])))]


def _named(depth: int):
    """``(anchor, content, doc)`` of every run, mostly once for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, docs, texts in _groups(batches):
            for r in runs(texts, depth):
                doc, content = docs[r.text], r.names(np.arange(len(r.first)))
                rows = _distinct(doc, content)
                yield pa.record_batch([_longs(r.anchor[rows]), _longs(content[rows]), _longs(doc[rows])], ["anchor", "content", "doc"])

    return run


def _halves(depth: int):
    """``(anchor, content, right, left, low)`` of the listed runs, ``low`` being their document; null where a half is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, docs, texts in _groups(batches):
            listed = np.unique(_of(*_flat(part.column(2))))
            for r in runs(texts, depth):
                content = r.names(np.arange(len(r.first)))
                rows = np.flatnonzero(_among(_of(content, r.text), listed))
                rows = rows[_distinct(r.text[rows], content[rows])]
                right, left, right_name, left_name = r.halves(rows)
                yield pa.record_batch(
                    [
                        _longs(r.anchor[rows]), _longs(content[rows]), pa.array(right_name.view(np.int64), mask=~right),
                        pa.array(left_name.view(np.int64), mask=~left), _longs(docs[r.text[rows]]),
                    ],
                    ["anchor", "content", "right", "left", "low"],
                )

    return run


def _windows(depth: int):
    """``(anchor, window, doc)`` of the windows in the listed halves of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, docs, texts in _groups(batches):
            listed = [np.unique(_of(*_flat(part.column(k)))) for k in (2, 3)]
            for r in runs(texts, depth):
                content = _of(r.names(np.arange(len(r.first))), r.text)
                for names, right in zip(listed, (True, False), strict=True):
                    rows = np.flatnonzero(_among(content, names))
                    start, owner = r.windows(rows, np.full(len(rows), right))
                    yield pa.record_batch(
                        [_longs(r.anchor[owner]), _longs(r.window_names(start)), _longs(docs[r.text[owner]])],
                        ["anchor", "window", "doc"],
                    )

    return run


def removed_bytes(texts: list[bytes], depth: int, contents: tuple[np.ndarray, np.ndarray], windows: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """A mask for each text of the bytes under one of its runs ``contents`` or of its ``windows`` (names, and the text of each).

    Texts without names are not cut into runs, and those without windows not into windows.
    """
    asks = np.zeros((2, len(texts)), bool)
    for mine, (_, row) in zip(asks, (contents, windows), strict=True):
        mine[row] = True
    contents, windows = (np.unique(_of(*told)) for told in (contents, windows))
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    change = np.zeros(int(lengths.sum()) + 1, np.int32)

    def cover(start: np.ndarray, end: np.ndarray) -> None:
        np.add.at(change, start, 1)
        np.add.at(change, end, -1)

    told = asks.any(axis=0)
    for r in runs([t if some else b"" for t, some in zip(texts, told, strict=True)], depth):
        shift = begins[r.text] + r.shift
        gone = _among(_of(r.names(np.arange(len(r.first))), r.text), contents)
        cover((r.first + shift)[gone], (r.last + shift)[gone] + depth)
        if len(windows):
            left = np.flatnonzero(~gone & asks[1][r.text])
            for right in (True, False):
                start, owner = r.windows(left, np.full(len(left), right))
                hit = _among(_of(r.window_names(start), r.text[owner]), windows)
                place = start[hit] + shift[owner[hit]]
                cover(place, place + depth)
    covered = np.cumsum(change[:-1]) > 0
    return [covered[b : b + n - 1] for b, n in zip(begins, lengths, strict=True)]


def repeats(docs: DataFrame, depth: int = 50) -> DataFrame:
    """``(doc, contents, windows)``: what to remove from each document of ``docs`` (``doc``, ``text``).

    ``contents`` names whole runs and ``windows`` single windows that also start in a
    document with a smaller number.
    """
    folders = {}

    def kept(name: str, df: DataFrame) -> DataFrame:
        folders[name] = scratch(df.sparkSession)
        return written(df, folders[name])

    # a run is one row of one shuffle; a hot anchor has as many rows as there are documents and contents with it
    seen = docs.mapInArrow(_named(depth), "anchor long, content long, doc long").repartition("anchor")
    content, anchor = Window.partitionBy("anchor", "content"), Window.partitionBy("anchor")
    marked = seen.withColumn("low", F.min("doc").over(content))
    # a run's first document has to ask window by window, where other runs share its anchor and then half a window
    marked = marked.withColumn("several", F.min("low").over(anchor) < F.max("low").over(anchor)).where("low < doc or several")
    marked = kept("marked", marked.select("content", "doc", (F.col("low") < F.col("doc")).alias("gone")))
    # a run that starts in a smaller document goes as a whole
    gone = kept("gone", marked.where("gone").groupBy("doc").agg(F.collect_set("content").alias("contents")))
    asking = marked.where("not gone").groupBy("doc").agg(F.collect_set("content").alias("contents"))
    schema = "anchor long, content long, right long, left long, low long"
    unsure = docs.join(asking.hint("shuffle_hash"), "doc").select("doc", "text", "contents").mapInArrow(_halves(depth), schema)
    unsure = kept("unsure", unsure)
    discard([folders["marked"]])
    sides = F.array(
        F.struct(F.lit(True).alias("is_right"), F.col("right").alias("half")), F.struct(F.lit(False).alias("is_right"), F.col("left").alias("half")))
    halves = unsure.select("anchor", "content", "low", F.explode(sides).alias("s")).select("anchor", "content", "low", "s.*").where("half is not null")
    met = halves.groupBy("anchor", "half").agg(F.min("low").alias("least"), F.max("low").alias("most")).where("least < most")
    asked = halves.join(met.select("anchor", "half").hint("shuffle_hash"), ["anchor", "half"])
    asked = asked.groupBy(F.col("low").alias("doc")).agg(
        F.collect_set(F.when(F.col("is_right"), F.col("content"))).alias("rights"),
        F.collect_set(F.when(~F.col("is_right"), F.col("content"))).alias("lefts"))
    windows = docs.join(asked.hint("shuffle_hash"), "doc").select("doc", "text", "rights", "lefts")
    windows = kept("windows", windows.mapInArrow(_windows(depth), "anchor long, window long, doc long"))
    discard([folders["unsure"]])
    # shuffled once for the least document and for the rows themselves
    alike = Window.partitionBy("anchor", "window")
    single = windows.withColumn("low", F.min("doc").over(alike)).where("low < doc")
    single = single.groupBy("doc").agg(F.collect_set("window").alias("windows"))
    none = F.array().cast("array<long>")
    told = written(gone.join(single, "doc", "full").select(
        "doc", F.coalesce("contents", none).alias("contents"), F.coalesce("windows", none).alias("windows")))
    discard([folders[name] for name in ("gone", "windows")])
    return told


def deduplicate(docs: DataFrame, depth: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``docs``.

    A byte goes when a ``depth``-byte string over it also starts in a document with a
    smaller id, judged on the input. ``kept`` holds the bytes left, in order. A null text
    is empty; a null id is larger than any other and null ids are one document, as rows of
    one id are: they take nothing from each other. Texts shorter than ``depth`` stay whole;
    an empty table gives no rows; further columns are ignored.
    """
    kind = dict(docs.dtypes)[doc_id]
    numbered = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), F.col(text).alias("text"))
    told = repeats(numbered, depth)
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, texts in _groups(batches):
            out = []
            names_of = [_flat(part.column(k)) for k in (2, 3)]
            for data, mask in zip(texts, removed_bytes(texts, depth, *names_of), strict=True):
                spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~mask].tobytes() if spans else data
                out.append((len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds, strict=True)]
            yield pa.record_batch([part.column(0), *columns], names)

    joined = numbered.join(told.hint("shuffle_hash"), "doc", "left").select("doc", "text", "contents", "windows")
    done = joined.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    own = F.when(F.col("doc") != LAST, F.col("doc")).cast(kind).alias(doc_id)
    return done.select(own, *names[1:])
