"""WARC round trips, and archives that break the format."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import pytest

from meterline.llm import warc


def records(data):
    return [warc.page_record(fields, block) for fields, block in warc.read_records(io.BytesIO(data))]


def test_a_record_per_member_comes_back(monkeypatch):
    payloads = [b"", b"x" * 10, "é\r\n\r\n<p>".encode() * 1000, bytes(range(256)) * 5000]
    data = b"".join(warc.record_bytes(n, f"http://h/{n}", payload, None) for n, payload in enumerate(payloads))
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "READ_BYTES", size if size > 1 else 3)
        assert [row[6] for row in records(data)] == payloads
    assert [row[5] for row in records(data)] == [hashlib.sha1(payload).hexdigest() for payload in payloads]
    first = zlib.decompressobj(31)
    first.decompress(data)
    assert first.eof and first.unused_data
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(payloads)


def test_a_revisit_leaves_the_payload_out():
    data = warc.record_bytes(1, "http://h/1", b"a" * 5000, 9)
    page, url, kind, refers_to, size, digest, payload = records(data)[0]
    assert (page, url, kind, refers_to, size, payload) == (1, "http://h/1", "revisit", 9, 5000, None)
    assert digest == hashlib.sha1(b"a" * 5000).hexdigest() and b"aaaa" not in gzip.decompress(data)


def rewritten(change):
    return gzip.compress(change(gzip.decompress(warc.record_bytes(1, None, b"payload", None))))


@pytest.mark.parametrize(
    "data",
    [
        rewritten(lambda raw: raw.replace(b"payload", b"pAyload")),
        rewritten(lambda raw: raw.replace(b"WARC/1.1", b"ABCD/1.1")),
        rewritten(lambda raw: raw + b"more"),
        rewritten(lambda raw: raw[:-6]),
        rewritten(lambda raw: raw.replace(b"\r\nContent-Length: 8", b"\r\nContent-Length: 9")),
        rewritten(lambda raw: raw.replace(b"WARC-Block-Digest", b"WARC-Block-Other").replace(b"payload", b"pAyload")),
        warc.record_bytes(1, None, b"payload", None)[:-9],
        b"no archive",
    ],
)
def test_what_breaks_the_format_or_a_digest_fails(data):
    with pytest.raises(warc.ArchiveError):
        records(data)


def expected(rows):
    keep = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= warc.LEAST_SHARED_BYTES:
            keep[html] = max(page, keep.get(html, page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        refers_to = keep[html] if page is not None and page < keep.get(html, page) else None
        kind = "response" if refers_to is None else "revisit"
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers_to))
    return out


@pytest.mark.parametrize("most_broadcast", [0, 1000])
def test_odd_pages_come_back(spark, monkeypatch, most_broadcast):
    monkeypatch.setattr(warc, "MOST_BROADCAST", most_broadcast)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    long = "é" * 700
    rows = [(n, f"http://h/{n}", long) for n in range(5)] + [
        (7, None, None), (8, "http://h/\n", ""), (9, "u", "short"), (10, "u", "short"), (None, "u", long), (4, "again", long), (11, "u", "y" * 300_000),
    ]
    pages = spark.createDataFrame([(*row, 1) for row in rows], "page_id bigint, url string, html string, payload int")
    archives = warc.write_archives(pages, warc.archive_folder(spark))
    found = warc.read_archives(archives).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    key = str
    assert sorted((tuple(row[name] for name in columns) for row in found), key=key) == sorted(expected(rows), key=key)
    assert all(row.payload is None if row.record_type == "revisit" else hashlib.sha1(row.payload).hexdigest() == row.payload_digest for row in found)
    assert sum(row.records for row in archives.collect()) == len(rows) and archives.count() > 1


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark))).collect() == []
