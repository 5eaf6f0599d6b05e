"""WARC archives: round trip, revisits, framing and digests."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from strandwise.llm.common import scratch
from strandwise.llm.warc import WarcError, page_record, plan_revisits, read_archives, read_records, record, round_trip, sha1_base32, write_archives


def one(payload=b"<p>hi</p>", refers=None, url="http://a/b"):
    return page_record(7, url, payload, sha1_base32(payload), refers)


def test_members_are_plain_gzip_and_digests_hold():
    archive = one() + one(b"", None) + one(b"x" * 300_000) + one(b"x" * 300_000, 5)
    rows = list(read_records(io.BytesIO(archive)))
    assert [r["payload_bytes"] for r in rows] == [9, 0, 300_000, 0]
    assert [r["warc-type"] for r in rows] == ["response", "response", "response", "revisit"]
    assert rows[0]["payload_sha1"] == base64.b32encode(hashlib.sha1(b"<p>hi</p>").digest()).decode()
    assert gzip.decompress(archive).count(b"WARC/1.1\r\n") == 4


def test_record_ends_anywhere_in_a_chunk(monkeypatch):
    monkeypatch.setattr("strandwise.llm.warc.CHUNK", 7)
    rng = random.Random(3)
    payloads = [rng.randbytes(n) for n in range(120)]
    rows = list(read_records(io.BytesIO(b"".join(map(one, payloads)))))
    assert [r["payload_sha1"] for r in rows] == list(map(sha1_base32, payloads))


def test_broken_archives_are_told():
    good = one()
    with pytest.raises(WarcError):
        list(read_records(io.BytesIO(good[:-20])))
    wrong = record([("WARC-Type", "response"), ("WARC-Block-Digest", "sha1:" + "A" * 32)], b"HTTP/1.1 200 OK\r\n\r\nx")
    with pytest.raises(WarcError):
        list(read_records(io.BytesIO(good + wrong)))
    short = gzip.compress(b"WARC/1.1\r\nContent-Length: 90\r\n\r\nabc\r\n\r\n")
    with pytest.raises(WarcError):
        list(read_records(io.BytesIO(short)))


def plain(rows):
    least = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if i is not None:
            least[p] = min(i, least.get(p, i))
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        first = least.get(p)
        again = first is not None and first != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


ROWS = [
    (3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, "same"), (9, "u", None), (8, "u", ""),
    (4, "u", "é" * 200_000), (5, "u", "a\r\n\r\nb"), (5, "u", "a\r\n\r\nb"), (None, "u", "same"), (None, "u", "alone"),
]


def test_odd_rows(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string")
    assert sorted(map(tuple, round_trip(spark, pages).collect()), key=repr) == plain(ROWS)
    assert round_trip(spark, pages.limit(0)).count() == 0
    small = {r.page_id: r.record_type for r in round_trip(spark, pages, min_bytes=5).collect() if r.page_id in (1, 2, 3, 8, 9)}
    assert set(small.values()) == {"response"}


def test_archives_are_cut_by_size(spark):
    pages = spark.createDataFrame([(i, "u", f"{i:x}" * 500) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    archives = write_archives(plan_revisits(pages), scratch(spark), archive_bytes=4000).cache()
    assert archives.count() > 3
    assert read_archives(archives).count() == 60 == sum(r.records for r in archives.collect())
