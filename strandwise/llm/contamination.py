"""Benchmark decontamination: size-partitioned MinHash containment search.

Benchmark items are partitioned by their number of shingles. For each partition every
document is cut into overlapping windows a little longer than the partition's largest
item, so an item of the partition that occurs in a document lies whole in some window and
the bound that containment sets on the Jaccard similarity is high, however long the
document is. An item and a window become candidates when one of ``N_HASHES`` MinHash
values agrees; a candidate is verified by exact shingle containment in the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: With windows of 1.5 times the largest item of a partition, and items of at least 4/5 of
#: it, containment 0.8 means Jaccard 0.38 at least: all 32 values miss it in 2e-7 of cases.
N_HASHES = 32
RATIO = 1.25
#: Items searched for in one pass over the documents; their signatures go to every task.
ITEM_BLOCK = 20_000
#: Bytes of their texts, about; a longer item is a block of its own.
BLOCK_BYTES = 64 << 20
SEED = 20_240
#: Characters of text that a task searches at once.
CHUNK = 1 << 21

#: Bytes that belong to no word: everything of ASCII but letters and digits.
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        base = np.full(size, _PRIME)
        base[0] = 1
        inverse = np.full(size, _INVERSE)
        inverse[0] = 1
        _POWERS, _INVERSES = np.cumprod(base), np.cumprod(inverse)
    return _POWERS, _INVERSES


def word_hashes(texts: list[str | None], separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, and the number of its text.

    Words are runs of the bytes that are no ``separator``, with A-Z folded; by default of
    non-ASCII characters, letters and digits. A space always separates.
    """
    data = [(t or "").encode() for t in texts]
    raw = _FOLD[np.frombuffer(b" ".join(data), np.uint8)]
    inside = np.concatenate(([False], ~separator[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    powers, inverses = _powers(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)])))
    hashes = mixed((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
    lengths = np.array([len(d) + 1 for d in data], np.int64)
    return hashes, np.searchsorted(np.cumsum(lengths), starts, "right")


def shingle_hashes(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every ``size`` words in a row of one text, and the number of the text."""
    n = max(0, len(words) - size + 1)
    out = words[:n].copy()
    for i in range(1, size):
        out = out * _PRIME + words[i : n + i]
    whole = owner[:n] == owner[len(words) - n :]
    return mixed(out[whole]), owner[:n][whole]


@dataclass
class Items:
    """Items of one size partition: ``largest`` shingles at most."""

    largest: int
    values: list[np.ndarray]  # for each hash function the items' MinHash values, sorted
    owners: list[np.ndarray]  # the items in that order


def partition_items(sets: list[np.ndarray], n_hashes: int, ratio: float) -> list[Items]:
    """Partitions whose sizes differ by ``ratio`` at most, from the smallest item up."""
    order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: len(sets[i]))
    groups: list[list[int]] = []
    for i in order:
        if groups and len(sets[i]) <= ratio * len(sets[groups[-1][0]]):
            groups[-1].append(i)
        else:
            groups.append([i])
    out = []
    for group in groups:
        values, owners = [], []
        for a in hash_seeds(n_hashes):
            v = np.array([permuted(sets[i], a).min() for i in group])
            by = np.argsort(v, kind="stable")
            values.append(v[by])
            owners.append(np.array(group)[by])
        out.append(Items(len(sets[group[-1]]), values, owners))
    return out


def hash_seeds(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def permuted(shingles: np.ndarray, seed: np.uint64) -> np.ndarray:
    """The shingles under the permutation ``seed``: an odd multiple, high bits folded down."""
    x = shingles * seed
    return x ^ (x >> np.uint64(32))


def window_minima(x: np.ndarray, largest: int) -> np.ndarray:
    """MinHash values of the windows: three half-steps long, a new one each half-step."""
    step = max(1, -(-largest // 2))
    blocks = np.minimum.reduceat(x, np.arange(0, len(x), step))
    if len(blocks) < 3:
        return blocks.min(keepdims=True)
    return np.minimum(np.minimum(blocks[:-2], blocks[1:-1]), blocks[2:])


def candidates(shingles: np.ndarray, owner: np.ndarray, partitions: list[Items], seeds: np.ndarray) -> set[tuple[int, int]]:
    """``(text, item)`` where a MinHash value of the item agrees with that of a window over the text.

    Windows run over the shingles of all texts; one that spans several stands for each.
    """
    found: set[tuple[int, int]] = set()
    for k, seed in enumerate(seeds):
        x = permuted(shingles, seed)
        for p in partitions:
            minima = window_minima(x, p.largest)
            at = np.searchsorted(p.values[k], minima)
            at[at == len(p.values[k])] = 0
            step = max(1, -(-p.largest // 2))
            for w in np.flatnonzero(p.values[k][at] == minima):
                items = p.owners[k][at[w] : np.searchsorted(p.values[k], minima[w], "right")].tolist()
                # an item's share of a value's shingle is in one text, that of the shingle itself
                low, high = w * step, min((w + 3) * step, len(x))
                for text in np.unique(owner[low:high][x[low:high] == minima[w]]).tolist():
                    found.update((text, i) for i in items)
    return found


def contained(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = 5,
    containment: float = 0.8,
    item_block: int = ITEM_BLOCK,
    n_hashes: int = N_HASHES,
) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared, containment)`` of every contaminated row.

    An item is in a document when at least ``containment`` of its distinct word shingles
    are. Words are runs of letters, digits and non-ASCII characters with A-Z folded, so
    case and punctuation do not hide a copy. An item of fewer than ``shingle`` words has no
    shingle and is found nowhere; so is a null or empty one, and null or empty documents
    hold nothing. Repeated documents each get their rows, repeated items one each; further
    columns are ignored; empty tables give no rows.

    Items come to the driver about ``item_block`` or ``BLOCK_BYTES`` at a time, picked by hash, and each block is one
    pass over the documents.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    schema = f"{doc_id} {kinds[0]}, {item_id} {kinds[1]}, n_shingles long, n_shared long, containment double"
    out = None
    for search in _searches(spark, items, item_id, item_text, shingle, containment, item_block, n_hashes):
        found = docs.select(doc_id, text).mapInArrow(_pairs(search, schema), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    shingle: int = 5, containment: float = 0.8, item_block: int = ITEM_BLOCK, n_hashes: int = N_HASHES,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    at = docs.columns.index(text)
    for search in _searches(docs.sparkSession, items, item_id, item_text, shingle, containment, item_block, n_hashes):
        docs = docs.mapInArrow(_clean(search, at), docs.schema)
    return docs


def _searches(
    spark, items, item_id, item_text, shingle, containment, item_block, n_hashes, block_bytes: int = BLOCK_BYTES
) -> Iterator[Search]:
    """A search for each block of items: about ``item_block`` of them and ``block_bytes`` of text at most."""
    wanted = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    rows, size = wanted.agg(F.count("text"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(-(-rows // item_block), -(-size // block_bytes))
    for k in range(n_blocks):
        block = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k).toArrow()
        if block.num_rows:
            shared = spark.sparkContext.broadcast((block["item"].combine_chunks(), block["text"].to_pylist()))
            yield Search(shared, shingle, containment, n_hashes)


class Search:
    """One block of items, ready in a task after ``begin``."""

    def __init__(self, shared, shingle: int, containment: float, n_hashes: int):
        self.shared, self.shingle, self.containment, self.n_hashes = shared, shingle, containment, n_hashes

    def begin(self) -> None:
        self.ids, texts = self.shared.value
        names, owner = shingle_hashes(*word_hashes(texts), self.shingle)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.sets = [np.unique(names[i:j]) for i, j in zip(ends[:-1], ends[1:])]
        self.partitions = partition_items(self.sets, self.n_hashes, RATIO)
        self.seeds = hash_seeds(self.n_hashes)

    def __call__(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """``(text, item, shingles shared)`` of every item that a text holds."""
        names, owner = shingle_hashes(*word_hashes(texts), self.shingle)
        if not len(names) or not self.partitions:
            return []
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        out, own = [], {}
        for text, i in sorted(candidates(names, owner, self.partitions, self.seeds)):
            if text not in own:
                own = {text: np.unique(names[ends[text] : ends[text + 1]])}
            n_shared = len(np.intersect1d(own[text], self.sets[i], assume_unique=True))
            if n_shared >= self.containment * len(self.sets[i]):
                out.append((text, i, n_shared))
        return out


def _chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[str | None]]]:
    """Rows of ``batch`` in groups of about ``CHUNK`` characters: the first row's number, and the texts."""
    first, texts, size = 0, [], 0
    for i, t in enumerate(batch.column(at)):
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= CHUNK:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def _pairs(search: Search, schema: str):
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search.begin()
        for batch in batches:
            rows = []
            for first, texts in _chunks(batch, 1):
                for text, i, n_shared in search(texts):
                    size = len(search.sets[i])
                    doc = batch.column(0)[first + text].as_py()
                    rows.append((doc, search.ids[i].as_py(), size, n_shared, n_shared / size))
            if rows:
                kinds = [batch.schema.field(0).type, search.ids.type, pa.int64(), pa.int64(), pa.float64()]
                columns = zip(zip(*rows, strict=True), kinds, strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in columns], names)

    return run


def _clean(search: Search, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search.begin()
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, texts in _chunks(batch, at):
                keep[[first + text for text, _, _ in search(texts)]] = False
            yield batch.filter(pa.array(keep))

    return run
