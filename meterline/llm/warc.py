"""WARC archives: a writer that stores repeated payloads once, and a sequential reader.

Each record is a gzip member of its own. The reader inflates a file piece by piece with zlib, takes a record's block by
its Content-Length, goes on with the next member, and checks block and payload digests. It holds one record at a time.

Of records with equal payloads of at least ``least_shared_bytes`` the one with the largest page id is a response and
the others revisit it; all smaller ones are responses. Rows that repeat a page id and its payload are of equal rank:
where it is the largest, all of them are responses. A row without a page id is a response and nothing revisits it. A
null payload is an empty one, a null url is left out of the record. An empty table gives an archive folder without
files, and no records. Further columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.storage import stored
from meterline.sources.stores import open_store
from meterline.sources.workspace import fresh_folder

LEAST_SHARED_BYTES = 1000
# Repeated payloads whose decision is broadcast at most (about 60 bytes each); more are joined by a shuffle.
MOST_BROADCAST = 500_000
# Bytes of records in one archive file, after which the next is started.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 20

# Lines of the format.
VERSION = "WARC/1.1"
RESPONSE, REVISIT = "response", "revisit"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_BLOCK = "application/http;msgtype=response"
RECORD_DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "archive string, position bigint, page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


class ArchiveError(ValueError):
    """An archive that is not what the format or its own digests say."""


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head and leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = head if refers_to is not None else head + payload
    name = "none" if page_id is None else page_id
    fields = [
        ("WARC-Type", RESPONSE if refers_to is None else REVISIT),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", RECORD_DATE),
        ("Content-Type", HTTP_BLOCK),
        ("WARC-Block-Digest", _digest(block)),
        ("WARC-Payload-Digest", _digest(payload)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{lines}\r\n".encode("utf-8") + block + b"\r\n\r\n") + packer.flush()


class _Member:
    """Bytes of one gzip member of a stream, inflated as they are asked for."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.rest = stream, rest
        self.inflater = zlib.decompressobj(31)
        self.ready = bytearray()

    def _more(self) -> bool:
        if self.inflater.eof:
            return False
        data = self.rest or self.stream.read(READ_BYTES)
        if not data:
            raise ArchiveError("the archive ends within a record")
        try:
            self.ready += self.inflater.decompress(data, READ_BYTES)
        except zlib.error as error:
            raise ArchiveError(f"not a gzip member: {error}") from error
        self.rest = self.inflater.unconsumed_tail
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                raise ArchiveError("a record's head has no end")
        out = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return out

    def take(self, size: int) -> bytes:
        while len(self.ready) < size:
            if not self._more():
                raise ArchiveError("a record is shorter than its Content-Length")
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out

    def finish(self) -> bytes:
        """What follows this member; the member itself must hold nothing more."""
        while self._more():
            if self.ready:
                break
        if self.ready:
            raise ArchiveError("a record is longer than its Content-Length")
        return self.inflater.unused_data


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of a stream, one after the other, digests verified."""
    rest = stream.read(READ_BYTES)
    while rest:
        member = _Member(stream, rest)
        if not (version := member.line()).startswith(b"WARC/"):
            raise ArchiveError(f"no record starts with {version[:20]!r}")
        fields: dict[str, str] = {}
        while line := member.line():
            name, mark, value = line.decode("utf-8").partition(":")
            if not mark:
                raise ArchiveError(f"not a field: {line[:40]!r}")
            fields[name.lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise ArchiveError("a record has no Content-Length")
        block = member.take(int(fields["content-length"]))
        if member.take(4) != b"\r\n\r\n":
            raise ArchiveError("a record does not end after its Content-Length")
        if "warc-block-digest" in fields and fields["warc-block-digest"] != _digest(block):
            raise ArchiveError(f"block digest of {fields.get('warc-record-id')} is wrong")
        yield fields, block
        rest = member.finish() or stream.read(READ_BYTES)


def _http(block: bytes) -> tuple[int, bytes]:
    """The payload length an HTTP head states, and the payload that follows it."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    lengths = [line.partition(b":")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    if not mark or not lengths:
        raise ArchiveError("a block has no HTTP head with a Content-Length")
    return int(lengths[0]), payload


def _page(field: str | None) -> int | None:
    name = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def page_record(fields: dict[str, str], block: bytes) -> tuple:
    """Page id, url, type, page referred to, payload length, payload digest (hex) and payload of a record."""
    size, payload = _http(block)
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"]
    if kind == RESPONSE and (len(payload) != size or _digest(payload) != stated):
        raise ArchiveError(f"payload of {fields.get('warc-record-id')} is not the one its digest names")
    digest = base64.b32decode(stated.removeprefix("sha1:")).hex()
    return (
        _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")),
        size, digest, payload if kind == RESPONSE else None,
    )


def revisits(pages: DataFrame, least_shared_bytes: int = LEAST_SHARED_BYTES) -> DataFrame:
    """``payload`` and ``page_id`` columns in, the payloads that occur for several pages out: ``digest, keep_id``."""
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    return (
        pages.where(F.col("page_id").isNotNull() & (F.length(payload) >= least_shared_bytes))
        .groupBy(F.unhex(F.sha1(payload)).alias("digest"))
        .agg(F.max("page_id").alias("keep_id"), F.min("page_id").alias("first_id"))
        .where("first_id < keep_id")
        .drop("first_id")
    )


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_shared_bytes: int = LEAST_SHARED_BYTES,
) -> DataFrame:
    """Writes a record per page and returns what was written: ``archive, records, bytes``.

    ``folder`` must be one that all executors reach. A task that is run again writes the same files again.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("payload")
    )
    repeated = stored(revisits(rows, least_shared_bytes), "repeated-payloads")
    if repeated.count() <= MOST_BROADCAST:
        repeated = F.broadcast(repeated)
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    decided = rows.join(repeated, F.unhex(F.sha1(payload)) == F.col("digest"), "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") < F.col("keep_id"), F.col("keep_id")).alias("refers_to")
    )

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        written = []
        target = None

        def close():
            nonlocal target
            if target is not None:
                target.close()
                # A finished file appears under its name at once, whichever attempt of the task finished it.
                store.move(f"{base}/{hidden}", f"{base}/{written[-1][0]}")
                target = None

        for batch in batches:
            for row in batch.to_pylist():
                if target is None:
                    name = f"part-{part:06d}-{len(written):04d}.warc.gz"
                    hidden = f".{name}.{TaskContext.get().taskAttemptId()}"
                    target = store.open_output_stream(f"{base}/{hidden}", compression=None)
                    written.append([name, 0, 0])
                record = record_bytes(row["page_id"], row["url"], row["payload"] or b"", row["refers_to"])
                target.write(record)
                written[-1][1] += 1
                written[-1][2] += len(record)
                if written[-1][2] >= ARCHIVE_BYTES:
                    close()
        close()
        names, records, sizes = zip(*written) if written else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}" for name in names], pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            names=["archive", "records", "bytes"],
        )

    return stored(decided.mapInArrow(write, "archive string, records bigint, bytes bigint"), "archive-list")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives named in column ``archive``, one file after the other within a task.

    Anything that does not follow the format, or whose digest is wrong, fails the read.
    """
    spark: SparkSession = archives.sparkSession
    names = archives.select("archive")
    tasks = max(1, min(archives.count(), 4 * spark.sparkContext.defaultParallelism))
    most = READ_BYTES * 8

    def read(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        labels = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

        def table(rows):
            columns = zip(*rows) if rows else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=labels)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, name = open_store(archive)
                rows, held = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for position, (fields, block) in enumerate(read_records(stream)):
                        page, url, kind, refers_to, size, digest, payload = page_record(fields, block)
                        payload = payload if with_payload else None
                        rows.append((archive, position, page, url, kind, refers_to, size, digest, payload))
                        held += 200 + len(payload or b"")
                        if held >= most:
                            yield table(rows)
                            rows, held = [], 0
                yield table(rows)

    return names.repartition(tasks, "archive").mapInArrow(read, RECORD_SCHEMA)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared place."""
    return fresh_folder(spark, "archives")
