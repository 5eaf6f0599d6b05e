"""Ranked lexical search by dense blocked multiplication.

The items are the queries, all documents are ranked for each of them. Items stand in tiles
with a compact vocabulary of their own; a tile of documents becomes a dense matrix of
impacts over that vocabulary, and one BLAS product in float64 gives the scores of all
document-item pairs of the tile. All numbers are whole, and vocabularies are cut so that no
partial sum reaches 2^53, so every product is exact; partial sums are added as 64-bit
integers. Each task keeps the best rows of each item, ties by id, tile by tile.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.llm.common import written

#: Terms are runs of letters and digits of ASCII and of anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A block of items has its own pass over the documents; it ends when it has so many (item, term) pairs or bytes of text.
BLOCK_PAIRS, BLOCK_BYTES = 1 << 18, 16 << 20
#: Items and vocabulary of a tile, documents of a tile.
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 32, 2048, 1024
#: Sums of whole numbers below this are exact in float64, in any order.
EXACT = 1 << 53
#: No term's saturated frequency reaches this.
IMPACT = 1_000_000
#: Candidates that a task holds before it keeps the best ones only.
HELD = 1 << 16
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text with A-Z in lower case; null has none."""
    return (text or "").encode().translate(_FOLDED).split()


@dataclass
class Block:
    """Some items: their numbers, their vocabulary and ``(item, term, count)`` as places in these."""

    numbers: np.ndarray
    vocabulary: list[bytes]
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray


def blocks(items: DataFrame, number: str, text: str) -> Iterator[Block]:
    """The items with terms in blocks; the driver holds one block at a time."""
    numbers, vocabulary, entries, size = [], {}, [], 0
    for row in items.select(number, text).toLocalIterator():
        found = Counter(terms(row[1]))
        if not found:
            continue
        entries += [(len(numbers), vocabulary.setdefault(t, len(vocabulary)), n) for t, n in found.items()]
        numbers.append(row[0])
        size += sum(map(len, found))
        if len(entries) >= BLOCK_PAIRS or size >= BLOCK_BYTES:
            yield Block(np.array(numbers), list(vocabulary), *np.array(entries, np.int64).T)
            numbers, vocabulary, entries, size = [], {}, [], 0
    if numbers:
        yield Block(np.array(numbers), list(vocabulary), *np.array(entries, np.int64).T)


@dataclass
class Tile:
    """Vocabulary tiles of a few items: the terms, and for each of them and each item count times weight."""

    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def tiles(block: Block, weight: np.ndarray) -> list[Tile]:
    """The block's item tiles; within a part no item's weights times ``IMPACT`` reach ``EXACT``."""
    out = []
    for first in range(0, len(block.numbers), TILE_ITEMS):
        own = (block.item >= first) & (block.item < first + TILE_ITEMS) & (weight[block.term] > 0)
        left = [(t, i - first, int(n) * int(weight[t])) for i, t, n in zip(block.item[own], block.term[own], block.count[own])]
        items = np.arange(first, min(first + TILE_ITEMS, len(block.numbers)))
        parts, room = [], (EXACT - 1) // IMPACT
        left.sort()
        while left:
            columns, rest, sums, values = {}, [], [0] * len(items), []
            for t, i, value in left:
                take = min(value, room - sums[i])
                if take and (t in columns or len(columns) < TILE_TERMS):
                    sums[i] += take
                    values.append((columns.setdefault(t, len(columns)), i, take))
                    value -= take
                if value:
                    rest.append((t, i, value))
            table = np.zeros((len(columns), len(items)))
            for t, i, value in values:
                table[t, i] = value
            parts.append((np.array(list(columns)), table))
            left = rest
        out.append(Tile(items, parts))
    return out


def match(docs: DataFrame, block: Block, doc_id: str, text: str) -> DataFrame:
    """``doc, n`` and of the block's terms ``ids, tf``, for every row of ``docs``; ``n`` counts all its terms."""
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary)  # a block of bounded size
    size = len(block.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = dict(zip(shared.value, range(size), strict=True)).get
        for batch in batches:
            n, found = np.zeros(batch.num_rows, np.int64), []
            for i, t in enumerate(batch.column(1)):
                words = terms(t.as_py())
                n[i] = len(words)
                held = [w for w in map(place, words) if w is not None]
                found.append(np.unique(np.array(held, np.int32), return_counts=True))
            ends = np.cumsum([0, *(len(f[0]) for f in found)]).astype(np.int32)
            ids, tf = (np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in (0, 1))
            yield pa.record_batch(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))], ["doc", "n", "ids", "tf"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc"), text).mapInArrow(run, f"doc {kind}, n long, ids array<int>, tf array<long>")


def best(rows: pa.Table, k: int) -> pa.Table:
    """The first ``k`` rows of each ``item`` by falling ``score``, equal scores by ``doc``, null last."""
    order = pc.sort_indices(rows, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc", "ascending")], null_placement="at_end")
    item = rows["item"].to_numpy()[order.to_numpy()]
    rank = np.arange(len(item)) - np.searchsorted(item, item)
    return rows.take(order.filter(pa.array(rank < k)))


def rank_tiles(matched: DataFrame, found: list[Tile], n_terms: int, n_items: int, docs: int, length: int, k: int, doc_kind: str) -> DataFrame:
    """``item, doc, score``: of each task's documents the best ``k`` of each item."""
    shared = matched.sparkSession.sparkContext.broadcast(found)  # tiles of a block of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, least = np.zeros(n_terms, np.int64), np.ones(n_items, np.int64)
        held: pa.Table | None = None

        def tighten() -> None:
            nonlocal held
            held = best(held, k)
            item, score = held["item"].to_numpy(), held["score"].to_numpy()
            full = np.bincount(item, minlength=n_items) >= k
            low = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(low, item, score)
            least[full] = low[full]  # an equal score may still win by its id

        for batch in batches:
            for first in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(first, TILE_DOCS)
                n = part.column(1).to_numpy()
                ids, tf = (part.column(c).flatten().to_numpy() for c in (2, 3))
                row = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy())
                m = 75 + 25 * n * docs // max(length, 1)
                value = (1_000_000_000 * tf // (1000 * tf + 12 * m[row])).astype(float)
                for tile in shared.value:
                    scores = np.zeros((part.num_rows, len(tile.items)), np.int64)
                    for words, weights in tile.parts:
                        column[:] = -1
                        column[words] = np.arange(len(words))
                        at = column[ids]
                        own = at >= 0
                        dense = np.zeros((part.num_rows, len(words)))
                        dense[row[own], at[own]] = value[own]
                        scores += (dense @ weights).astype(np.int64)
                    bar = least[tile.items]
                    if part.num_rows > k:
                        bar = np.maximum(bar, np.partition(scores, part.num_rows - k, axis=0)[part.num_rows - k])
                    d, i = np.nonzero(scores >= bar)
                    new = pa.table({"item": tile.items[i], "doc": part.column(0).take(pa.array(d)), "score": scores[d, i]})
                    held = new if held is None else pa.concat_tables([held, new])
                    if held.num_rows > HELD:
                        tighten()
        if held is not None:
            tighten()
            yield from held.combine_chunks().to_batches()

    return matched.mapInArrow(run, f"item long, doc {doc_kind}, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring rows of ``docs`` for each row of ``items``.

    ``N`` counts the documents with terms, ``L`` their terms, ``n`` a document's terms, ``df``
    the documents with a term, ``tf`` its occurrences. A term weighs
    ``floor(1000 ln((2N+2)/(2df+1)))``, with ``m = 75 + 25nN div L`` a document scores the sum of
    ``weight * (10^9 tf div (1000 tf + 12 m))`` over the item's terms, repeats included. Equal
    scores go by rising ``doc_id``, null last; only scores above 0 are returned.

    Null and empty texts have no terms: such an item gets no row, such a document is never
    found. Repeated rows are documents, or items, of their own; empty tables give no rows;
    further columns are ignored. A document's row number is not needed: of rows alike in id
    and text, any may stand for another.
    """
    kind = dict(docs.dtypes)[doc_id]
    asked = written(items.select(F.monotonically_increasing_id().alias("number"), F.col(item_id).alias("id"), F.col(item_text).alias("words")))
    found = None
    for block in blocks(asked, "number", "words"):
        matched = written(match(docs, block, doc_id, text))
        total = matched.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(block.vocabulary), np.int64)
        held = matched.select(F.explode("ids").alias("id")).groupBy("id").count().toArrow()  # a row for each term of the block
        df[held["id"].to_numpy()] = held["count"].to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        rows = rank_tiles(
            matched, tiles(block, weight), len(weight), len(block.numbers), total.docs, total.terms or 0, k, kind)
        part = F.pmod(F.spark_partition_id(), F.lit(64))
        order = [F.desc("score"), F.asc_nulls_last("doc")]
        near = Window.partitionBy("item", "part").orderBy(*order)
        rows = rows.withColumn("part", part).withColumn("place", F.row_number().over(near)).where(F.col("place") <= k)
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        names = docs.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(block.numbers)], "item long, number long")
        rows = rows.join(names, "item").select("number", "rank", "doc", "score")
        found = rows if found is None else found.union(rows)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"number long, rank int, doc {kind}, score long")
    found = found.join(asked.select("number", "id"), "number")
    return found.select(F.col("id").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
