"""WARC archives: written as one gzip member per record, read back in sequence."""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import scratch, written
from strandwise.llm.store import opened, publish

VERSION = b"WARC/1.1"
#: Every record gets this date: a page row has none, and reruns must write the same bytes.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of compressed data read at once.
CHUNK = 1 << 16
#: Bytes of records after which a task begins the next archive.
ARCHIVE_BYTES = 1 << 30
PAGE = "X-Page-Id"
REFERS = "X-Refers-To-Page-Id"


class WarcError(ValueError):
    """A record that breaks the format or whose digest is wrong."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member: version line, named fields, blank line, block, two line ends."""
    head = VERSION + b"\r\n" + b"".join(f"{k}: {_one_line(v)}\r\n".encode() for k, v in fields)
    raw = head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if set(value) & {"\r", "\n"} else value


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A ``response`` with the payload, or with ``refers_to`` a ``revisit`` with the HTTP head alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{url}:{digest}")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    if page_id is not None:
        fields.append((PAGE, str(page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), (REFERS, str(refers_to))]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
    ]
    return record(fields, block)


class _Members:
    """The bytes of one gzip member after the other, decompressed as they are asked for."""

    def __init__(self, stream: io.RawIOBase):
        self.stream, self.pending, self.buffer = stream, b"", b""
        self.member: zlib._Decompress | None = None

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        self.buffer = b""
        self.pending = self.pending or self.stream.read(CHUNK)
        self.member = zlib.decompressobj(31) if self.pending else None
        return self.member is not None

    def _more(self) -> bool:
        """Decompress one more chunk into the buffer; False at the member's end."""
        if self.member.eof:
            return False
        if not self.pending:
            self.pending = self.stream.read(CHUNK)
            if not self.pending:
                raise WarcError("archive ends inside a member")
        got = self.member.decompress(self.pending, CHUNK * 4)
        self.pending = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
        self.buffer += got
        return True

    def line(self) -> bytes:
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                raise WarcError("line without an end")
        out, self.buffer = self.buffer[:at], self.buffer[at + 2 :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """``n`` bytes in pieces."""
        while n:
            if not self.buffer and not self._more():
                raise WarcError("block shorter than its Content-Length")
            piece, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> None:
        tail, self.buffer = self.buffer, b""
        while self._more():
            tail, self.buffer = tail + self.buffer, b""
        if tail != b"\r\n\r\n":
            raise WarcError("no record end after the block")


def read_records(stream: io.RawIOBase) -> Iterator[dict]:
    """Header fields (lower-case names) of each record and ``payload_bytes``, ``payload_sha1``, ``head``.

    A block is framed by its Content-Length and hashed piece by piece, never held whole;
    block and payload digests are verified and a wrong one raises ``WarcError``.
    """
    members = _Members(stream)
    while members.next_member():
        if members.line() != VERSION:
            raise WarcError("no version line")
        fields: dict[str, str] = {}
        while line := members.line():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise WarcError("no Content-Length")
        block, payload, head, in_payload, size = hashlib.sha1(), hashlib.sha1(), b"", False, 0
        for piece in members.take(int(fields["content-length"])):
            block.update(piece)
            if not in_payload:
                head += piece
                at = head.find(b"\r\n\r\n")
                if at < 0:
                    continue
                piece, head, in_payload = head[at + 4 :], head[: at + 4], True
            payload.update(piece)
            size += len(piece)
        members.finish()
        digest = base64.b32encode(payload.digest()).decode()
        _verify(fields, "warc-block-digest", base64.b32encode(block.digest()).decode())
        if fields.get("warc-type") != "revisit":
            _verify(fields, "warc-payload-digest", digest)
        yield fields | {"payload_bytes": size, "payload_sha1": digest, "head": head.decode("latin-1")}


def _verify(fields: dict, name: str, found: str) -> None:
    if name in fields and fields[name].removeprefix("sha1:") != found:
        raise WarcError(f"{name} is {fields[name]}, the bytes give {found}")


def _page_row(r: dict) -> tuple:
    revisit = r["warc-type"] == "revisit"
    size = r["payload_bytes"]
    if revisit:  # the payload itself is elsewhere; the HTTP head tells its length
        heads = dict(x.split(": ", 1) for x in r["head"].split("\r\n")[1:] if ": " in x)
        size = int(heads["Content-Length"])
    page, refers = r.get(PAGE.lower()), r.get(REFERS.lower())
    return (int(page) if page is not None else None, size, r["warc-payload-digest"].removeprefix("sha1:"),
            r["warc-type"], int(refers) if refers is not None else None)


def plan_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, first_id)``; ``first_id`` is null for a response.

    Of rows with equal payloads of at least ``min_bytes`` bytes that with the smallest
    ``page_id`` is the response (several, if that id repeats; a null id only if no row has
    one). Digests with their smallest id are summed up before the shuffle.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    digest = F.sha2("payload", 256)
    first = rows.groupBy(digest.alias("digest")).agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    copies = first.where("n > 1").drop("n")
    same = (F.col("least") != F.col("page_id")) | F.col("page_id").isNull()
    return rows.withColumn("digest", digest).join(copies, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(same & (F.octet_length("payload") >= min_bytes), F.col("least")).alias("first_id"),
    )


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``planned`` as archives below ``folder``; returns ``(archive, records)``.

    A task writes its rows to archives of its own. A file gets its final name, which tells
    the partition, only when whole, so a second attempt replaces it by the same bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = opened(folder)
        fs.create_dir(root, recursive=True)
        number, out, records, written_bytes, done = 0, None, 0, 0, []

        def close():
            nonlocal out, number
            out.close()
            publish(name(number), temporary(number))
            done.append((name(number), records))
            out, number = None, number + 1

        def name(k):
            return f"{folder}/part-{task.partitionId():06d}-{k:04d}.warc.gz"

        def temporary(k):
            return f"{name(k)}.{task.taskAttemptId()}"

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for page_id, url, payload, first_id in zip(*columns, strict=True):
                if out is None:
                    out, records, written_bytes = fs.open_output_stream(opened(temporary(number))[1]), 0, 0
                data = payload.as_py()
                packed = page_record(page_id.as_py(), url.as_py(), data, sha1_base32(data), first_id.as_py())
                out.write(packed)
                records, written_bytes = records + 1, written_bytes + len(packed)
                if written_bytes >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pa.record_batch([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["archive", "records"])

    return planned.mapInArrow(run, "archive string, records long")


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives named in ``archives.archive``."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def pack(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

        for batch in batches:
            for archive in batch.column(0):
                fs, path = opened(archive.as_py())
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream):
                        rows.append(_page_row(r))
                        if len(rows) == 10_000:
                            yield pack(rows)
                            rows = []
                if rows:
                    yield pack(rows)

    return archives.select("archive").mapInArrow(run, READ_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``) and read the archives back.

    Null html is an empty payload, null urls and ids leave their field out, line ends in a
    url are percent-encoded, repeated rows are records of their own, other columns are
    ignored and an empty table gives no rows.
    """
    folder = scratch(spark)
    archives = written(write_archives(plan_revisits(pages, min_bytes), folder, archive_bytes))
    # a file name per row: dealt out so that as many tasks read as wrote
    return read_archives(archives.repartition(max(1, spark.sparkContext.defaultParallelism), "archive"))
