"""Token ids in binary shards, with a minimal perfect hash index for keyed access.

A shard file holds nothing but ids, little-endian, of a range of documents in ascending
``doc_id`` order. Index files hold, by hash bucket of the document's key, a minimal perfect
hash function and in its order a fingerprint, shard, offset and length of each document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwise.llm.common import scratch, written
from strandwise.llm.store import opened, publish
from strandwise.llm.subwords import Encoder, task_encoder

#: Documents in one index file.
BUCKET = 1 << 18
#: Bits a level has per key that is left.
GAMMA = 2.0
#: Levels after which the keys left (equal 64-bit hashes) are listed as they are.
LEVELS = 48
MAGIC = b"MPHIDX01"
ENTRY = np.dtype([("check", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("start", "<u8"), ("n", "<u8")])


def _level_hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


@dataclass
class PerfectHash:
    """Each level marks the places that exactly one remaining key falls on; the rest go on.

    A key's number is the count of marks before its own, so ``n`` keys get the numbers
    0 to n - 1 in constant expected time.
    """

    levels: list[np.ndarray]  # of bool

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The function and which of ``keys`` it could not tell apart."""
        levels, left = [], np.arange(len(keys))
        while len(left) and len(levels) < LEVELS:
            size = max(64, int(GAMMA * len(left)) + 63 & ~63)
            at = _level_hash(keys[left], len(levels), size)
            marks = np.bincount(at, minlength=size) == 1
            levels.append(marks)
            left = left[~marks[at]]
        return cls(levels), left

    def __post_init__(self):
        self.before, base = [], 0
        for marks in self.levels:
            counts = np.cumsum(marks)
            self.before.append(base + counts - marks)
            base += int(counts[-1])
        self.n = base

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for a key that surely is not one."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, marks in enumerate(self.levels):
            at = _level_hash(keys[left], level, len(marks))
            hit = marks[at]
            out[left[hit]] = self.before[level][at[hit]]
            left = left[~hit]
        return out


def index_bytes(keys: np.ndarray, entries: np.ndarray) -> bytes:
    function, left = PerfectHash.build(keys)
    told = np.setdiff1d(np.arange(len(keys)), left, assume_unique=True)
    ordered = np.empty(function.n, ENTRY)
    ordered[function(keys[told])] = entries[told]
    parts = [MAGIC, struct.pack("<QQQ", function.n, len(left), len(function.levels))]
    for marks in function.levels:
        parts += [struct.pack("<Q", len(marks)), np.packbits(marks, bitorder="little").tobytes()]
    return b"".join([*parts, ordered.tobytes(), keys[left].tobytes(), entries[left].tobytes()])


class Index:
    """An index file in memory; ``find`` gives the entries of keys, with ``n`` 0 for unknown ones."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        n, n_left, n_levels = struct.unpack_from("<QQQ", data, 8)
        at, levels = 32, []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<Q", data, at)
            bits = np.frombuffer(data, np.uint8, size // 8, at + 8)
            levels.append(np.unpackbits(bits, bitorder="little").astype(bool))
            at += 8 + size // 8
        self.function = PerfectHash(levels)
        self.entries = np.frombuffer(data, ENTRY, n, at)
        at += n * ENTRY.itemsize
        self.left = np.frombuffer(data, np.uint64, n_left, at)
        self.left_entries = np.frombuffer(data, ENTRY, n_left, at + 8 * n_left)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), ENTRY)
        number = self.function(keys)
        known = np.flatnonzero(number >= 0)
        got = self.entries[number[known]]
        same = got["check"] == checks[known]
        out[known[same]] = got[same]
        for i in np.flatnonzero(np.isin(keys, self.left)) if len(self.left) else ():
            hit = np.flatnonzero((self.left == keys[i]) & (self.left_entries["check"] == checks[i]))
            if len(hit):
                out[i] = self.left_entries[hit[0]]
        return out


def document_key(doc_id: str, copy: str) -> tuple[Column, Column]:
    """A 64-bit key and a 32-bit fingerprint of (document id, number among equal ids)."""
    kind = [F.col(doc_id), F.col(copy)]
    return F.xxhash64(*kind), F.hash(F.lit("check"), *kind).bitwiseAND(0xFFFFFFFF)


@dataclass
class TokenStore:
    """Where a written corpus is: ``shard-*.ids`` and ``index-*.mph`` below ``folder``."""

    folder: str
    width: int  # bytes of an id
    buckets: int
    doc_id: str
    kind: str


def write_store(
    docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None,
    doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET,
) -> TokenStore:
    """Encode every row of ``docs``, append ``end_id`` and write shards and index files.

    Documents are in ascending ``doc_id`` order, nulls first, rows of one id by text; null
    and empty texts have the end id alone. Ids take 2 bytes if the vocabulary allows it.
    A file gets its name when whole, and a second attempt writes the same bytes.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark)
    kind = dict(docs.dtypes)[doc_id]
    width = 2 if max(Encoder(tokenizer).tokenizer.get_vocab_size(), end_id) <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder = TaskContext.get(), task_encoder(tokenizer)
        shard = task.partitionId()
        fs, root = opened(folder)
        fs.create_dir(root, recursive=True)
        name = _shard(folder, shard)
        temporary = f"{name}.{task.taskAttemptId()}"
        offset, last, copy, end = 0, object(), 0, np.array([end_id], f"<u{width}").tobytes()
        with fs.open_output_stream(opened(temporary)[1]) as out:
            for batch in batches:
                rows = []
                for key, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    copy = copy + 1 if key == last else 0
                    last = key
                    ids = encoder.encode(body.as_py())
                    out.write(ids.astype(f"<u{width}").tobytes())
                    out.write(end)
                    rows.append((copy, offset, len(ids) + 1))
                    offset += len(ids) + 1
                n = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 3
                yield pa.record_batch(
                    [batch.column(0), n[0], pa.array([shard] * len(rows), pa.int32()), n[1], n[2]],
                    ["doc", "copy", "shard", "offset", "n"],
                )
        publish(name, temporary)

    ordered = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange(F.col("doc").asc_nulls_first()).sortWithinPartitions(F.col("doc").asc_nulls_first(), "text")
    rows = written(ordered.mapInArrow(run, f"doc {kind}, copy long, shard int, offset long, n long"))
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard").agg(F.sum("n").alias("n_shard"))
    starts = starts.select("shard", F.coalesce(F.sum("n_shard").over(before), F.lit(0)).alias("base"))
    buckets = max(1, -(-rows.count() // bucket))
    key, check = document_key("doc", "copy")
    entries = rows.join(starts, "shard").select(
        F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"), key.alias("key"), check.alias("check"),
        "shard", "offset", (F.col("base") + F.col("offset")).alias("start"), "n",
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["bucket"].iloc[0])
        table = np.zeros(len(pdf), ENTRY)
        for field in ENTRY.names:
            table[field] = pdf[field].to_numpy()
        name = f"{folder}/index-{number:06d}.mph"
        temporary = f"{name}.{TaskContext.get().taskAttemptId()}"
        fs, path = opened(temporary)
        with fs.open_output_stream(path) as out:
            out.write(index_bytes(pdf["key"].to_numpy(np.int64).view(np.uint64), table))
        publish(name, temporary)
        return pd.DataFrame({"bucket": [number], "n": [len(pdf)]})

    written(entries.groupBy("bucket").applyInPandas(build, "bucket int, n long"))
    return TokenStore(folder, width, buckets, doc_id, kind)


def _shard(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.ids"


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``keys`` (``doc``, ``copy``) with ``shard, offset, start, n`` from the index; unknown keys are left out."""
    key, check = document_key("doc", "copy")
    wanted = keys.select(
        "doc", "copy", key.alias("key"), check.alias("check"), F.pmod(key, F.lit(store.buckets)).cast("int").alias("bucket"))
    schema = f"doc {store.kind}, copy long, shard int, offset long, start long, n long"
    folder = store.folder

    def look(table: pa.Table) -> pa.Table:
        fs, path = opened(f"{folder}/index-{table.column('bucket')[0].as_py():06d}.mph")
        with fs.open_input_stream(path) as stream:
            index = Index(stream.read())
        got = index.find(table.column("key").to_numpy().view(np.uint64), table.column("check").to_numpy().astype(np.uint32))
        known = pa.array(got["n"] > 0)
        types = {"shard": pa.int32()}
        columns = [pa.array(got[f].astype(np.int64)).cast(types.get(f, pa.int64())) for f in ("shard", "offset", "start", "n")]
        out = pa.table([table.column("doc"), table.column("copy"), *columns], ["doc", "copy", "shard", "offset", "start", "n"])
        return out.filter(known)

    return wanted.groupBy("bucket").applyInArrow(look, schema)


def read_ids(store: TokenStore, places: DataFrame, schema: str, use) -> DataFrame:
    """``use(ids) -> tuple`` over the ids of each row of ``places``; ``schema`` names what it returns.

    Rows are ordered by place first, so every task reads its shards in one direction.
    """
    folder, width = store.folder, store.width
    fields = f"doc {store.kind}, start long, n long, {schema}"
    empty = store_schema(places, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, stream = None, None
        for batch in batches:
            got = []
            for s, offset, n in zip(*(batch.column(i).to_pylist() for i in (3, 4, 2)), strict=True):
                if s != shard:
                    if stream is not None:
                        stream.close()
                    fs, path = opened(_shard(folder, s))
                    shard, stream = s, fs.open_input_file(path)
                data = stream.read_at(n * width, offset * width)
                got.append(use(np.frombuffer(data, f"<u{width}").astype("<u4")))
            made = [pa.array(c, t) for c, t in zip(zip(*got), empty, strict=True)] if got else [pa.array([], t) for t in empty]
            yield pa.record_batch([*batch.columns[:3], *made], [f.split()[0] for f in fields.split(", ")])
        if stream is not None:
            stream.close()

    ordered = places.select("doc", "start", "n", "shard", "offset").repartitionByRange("shard", "offset")
    return ordered.sortWithinPartitions("shard", "offset").mapInArrow(run, fields)


def store_schema(frame: DataFrame, fields: str) -> list[pa.DataType]:
    """Arrow types of what ``use`` adds to the three columns before it."""
    table = frame.sparkSession.createDataFrame([], fields).toArrow()
    return list(table.schema.types[3:])


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """Write ``docs`` and read every document back by its key.

    Returns ``doc_id, start, n_tokens, ids_crc32``. Repeated ids each get their rows (the
    n-th row of an id in text order is the key's n-th copy), a null id is an id like any
    other, further columns are ignored and an empty table gives no rows.
    """
    store = write_store(docs, tokenizer, end_id, None, doc_id, text, bucket)
    keys = docs.groupBy(F.col(doc_id).alias("doc")).agg(F.count("*").alias("_n"))
    keys = keys.select("doc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("copy"))
    read = read_ids(store, locate(store, keys), "ids_crc32 long", lambda ids: (zlib.crc32(ids.tobytes()),))
    return read.select(F.col("doc").alias(doc_id), "start", F.col("n").alias("n_tokens"), "ids_crc32")
