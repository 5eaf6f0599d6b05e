"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint bits are grouped into partitions of correlated bits. Two fingerprints within
``reach`` bits differ by at most ``t_i`` bits in some partition ``i`` whenever
``sum(t_i + 1) = reach + 1``, so the thresholds may be unequal: dynamic programming gives
them to partitions by the candidates they are estimated to bring. One side of a pair is
indexed by its exact partition value, the other probes all values within the threshold,
and every candidate is verified on the whole fingerprint.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.llm.common import UPPER, WORD, written
from strandwise.llm.graph import components

BITS = 64
#: Fingerprints the index is fitted on; any fit finds all links, the fit only sets the cost.
FIT_ROWS = 4096
_LOWER = str.maketrans(UPPER, UPPER.lower())


def simhash(text: str | None, words: re.Pattern, shingle: int) -> int:
    found = words.findall((text or "").translate(_LOWER))
    if not found:
        return 0
    if len(found) <= shingle:
        grams = [" ".join(found)]
    else:
        grams = map(" ".join, zip(*(itertools.islice(found, i, None) for i in range(shingle))))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(g.encode(), 42) for g in grams]), np.uint8).reshape(-1, 8)
    # unpacked in blocks, so that a very long text needs no 64 bytes a word at once
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long; null or no words: 0."""
    schema = f"{doc_id} {dict(docs.dtypes)[doc_id]}, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(WORD)
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py(), words, shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], [doc_id, "fp"])

    return docs.select(doc_id, text).mapInArrow(run, schema)


@dataclass(frozen=True)
class Part:
    """Bit numbers of one partition (0 is the lowest bit) and its threshold; -1 leaves it out."""

    bits: tuple[int, ...]
    threshold: int

    def value(self, fp: Column) -> Column:
        """The partition's bits of ``fp``, run by run, as a number."""
        out, at = F.lit(0).cast("long"), 0
        for low, high in _runs(self.bits):
            piece = F.shiftrightunsigned(fp, low).bitwiseAND((1 << (high - low)) - 1)
            out = out.bitwiseOR(F.shiftleft(piece, at))
            at += high - low
        return out

    def masks(self) -> list[int]:
        """All ways to flip up to ``threshold`` bits of the value."""
        return [
            sum(1 << i for i in flips)
            for n in range(self.threshold + 1)
            for flips in itertools.combinations(range(len(self.bits)), n)
        ]


def _runs(bits: tuple[int, ...]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b in bits:
        if out and out[-1][1] == b:
            out[-1][1] = b + 1
        else:
            out.append([b, b + 1])
    return [(a, b) for a, b in out]


def group_bits(ones: np.ndarray, n_parts: int) -> list[tuple[int, ...]]:
    """Partitions of near-equal size; each grows by the bit most correlated with it."""
    centred = ones - ones.mean(axis=0)
    norm = np.sqrt((centred**2).sum(axis=0))
    corr = np.abs(centred.T @ centred) / np.maximum(np.outer(norm, norm), 1e-9)
    sizes = [BITS // n_parts + (i < BITS % n_parts) for i in range(n_parts)]
    free, parts = set(range(BITS)), []
    for size in sizes:
        rest = sorted(free)
        first = rest[int(np.argmax(corr[np.ix_(rest, rest)].sum(axis=1)))]
        part = [first]
        free.remove(first)
        while len(part) < size:
            rest = sorted(free)
            best = rest[int(np.argmax(corr[np.ix_(rest, part)].sum(axis=1)))]
            part.append(best)
            free.remove(best)
        parts.append(tuple(sorted(part)))
    return parts


def thresholds(cost: np.ndarray, reach: int) -> tuple[float, list[int]]:
    """Least total ``cost[part, t + 1]`` with ``sum(t + 1) == reach + 1``; t = -1 costs column 0."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        now: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for step in range(min(len(row) - 1, reach + 1 - used) + 1):
                option = (total + row[step], [*chosen, step - 1])
                if used + step not in now or option < now[used + step]:
                    now[used + step] = option
        best = now
    return best[reach + 1]


def fit(sample: np.ndarray, n_rows: int, reach: int) -> list[Part]:
    """Partitions and thresholds for ``n_rows`` fingerprints like those of ``sample``.

    A threshold costs its probes per fingerprint and the candidates per fingerprint,
    estimated from the sample's distances within the partition.
    """
    sample = np.unique(sample.astype(np.uint64))
    if len(sample) < 2:  # nothing to estimate from
        return [Part(tuple(range(i, BITS, reach + 1)), 0) for i in range(reach + 1)]
    ones = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
    pairs = max(1, len(sample) * (len(sample) - 1))
    best: tuple[float, list[Part]] | None = None
    for n_parts in range(2, reach + 2):
        parts = group_bits(ones, n_parts)
        cost = np.zeros((n_parts, reach + 2))
        for i, bits in enumerate(parts):
            x = ones[:, list(bits)]
            far = (x.sum(axis=1)[:, None] + x.sum(axis=1)[None, :] - 2 * (x @ x.T)).round()
            probes = 0.0
            for t in range(reach + 1):
                probes += len(list(itertools.combinations(range(len(bits)), t)))
                # one unseen pair more than seen, so that a small sample promises nothing
                candidates = ((far <= t).sum() - len(sample) + 1) / pairs * n_rows
                cost[i, t + 1] = probes + 1 + candidates
        total, chosen = thresholds(cost, reach)
        if best is None or total < best[0]:
            best = total, [Part(b, t) for b, t in zip(parts, chosen, strict=True)]
    return [p for p in best[1] if p.threshold >= 0]


def links(prints: DataFrame, reach: int = 3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of the distinct ``fp`` in ``prints`` at most ``reach`` bits apart."""
    n_rows = prints.count()
    # a bounded sample picked by hash: at most fit_rows longs come to the driver
    sample = [r.fp for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(fit_rows).collect()]
    parts = fit(np.array(sample, np.int64).view(np.uint64), n_rows, reach)
    entries, probes = [], []
    for i, p in enumerate(parts):
        entries.append(F.struct(F.lit(i).alias("part"), p.value(F.col("fp")).alias("value")))
        probes += [
            F.struct(F.lit(i).alias("part"), p.value(F.col("fp")).bitwiseXOR(F.lit(m).cast("long")).alias("value"))
            for m in p.masks()
        ]
    left = prints.select(F.col("fp").alias("a"), F.explode(F.array(*entries)).alias("k")).select("a", "k.*")
    right = prints.select(F.col("fp").alias("b"), F.explode(F.array(*probes)).alias("k")).select("b", "k.*")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= reach)
    return left.join(right, ["part", "value"]).where(close).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, reach: int = 3
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Documents link when their fingerprints differ in at most ``reach`` bits; a component's
    id is its smallest ``doc_id``. Equal fingerprints are one class from the start, so
    copies cost no pairs. Null, empty and blank texts have fingerprint 0 and link like any
    other; repeated rows stay; a null id never names a component unless it has no other;
    further columns are ignored and an empty table gives no rows.
    """
    prints = written(fingerprints(docs, doc_id, text, shingle))
    classes = written(prints.groupBy("fp").agg(F.min(doc_id).alias("first")))
    label = components(classes.select("fp"), links(classes.select("fp"), reach))
    names = _named(classes, label)
    return prints.join(names, "fp").select(
        doc_id, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(classes: DataFrame, label: DataFrame) -> DataFrame:
    """``(fp, component_id)``: the smallest first document of each component."""
    rooted = classes.join(label, "fp")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, reach: int = 3) -> DataFrame:
    """One row of each component, with all its columns: the smallest ``doc_id``, null last.

    Of rows with that same id one is kept.
    """
    stamped = docs.select(F.monotonically_increasing_id().alias("_row"), *docs.columns)
    at = stamped.columns.index(text)
    schema = ", ".join(["_fp long", *(f"`{c}` {t}" for c, t in stamped.dtypes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(WORD)
        for batch in batches:
            fps = np.fromiter((simhash(t.as_py(), words, shingle) for t in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.record_batch([pa.array(fps.view(np.int64)), *batch.columns], ["_fp", *batch.schema.names])

    rows = written(stamped.mapInArrow(run, schema))
    order = F.struct(F.col(doc_id).isNull().alias("unknown"), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    classes = written(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min(order).alias("first")))
    label = components(classes.select("fp"), links(classes.select("fp"), reach))
    kept = classes.join(label, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)
