"""WARC archives: writing with revisits, and a reader that salvages what damaged archives still hold.

Every record is written as a gzip member of its own; the reader takes members of several records too. It takes
members one by one and checks each: the member's checksum, and of each record the version line, the length, the
digest. Records and gaps inside one member have the member's bytes as their place. After a failed check it searches the next place where a
whole valid record begins (a gzip member, or a version line in an archive that is not compressed), reads on
from there, and reports the bytes between as a gap with the reason.

Archives are files in a folder that all executors share, addressed by URI; tasks write under a name of their
own and rename the finished file, so a repeated task leaves one complete file. They are read as Spark's
``binaryFile`` source, one archive a row; ``ARCHIVE_BYTES`` bounds its size.

Defined results: a null payload is empty. Payloads of at least ``LEAST_BYTES`` that occur more than once are a
response with the smallest id and revisits otherwise; a null id is never the smallest, and rows that repeat
the smallest are responses too. An empty table writes no archive and reads no record. A revisit whose response was
lost keeps the digest it names and has no length.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import materialise
from cartwheel.sources.workspace import new_folder

LEAST_BYTES = 100
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
# bytes opened at a time: what lies behind a member is copied once per read
READ_BYTES = 16 << 10
# fixed values of the format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "archive string, start long, end long, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, url string, payload binary"
GAP = "archive string, start long, end long, reason string"
NAME = "urn:page:"


def record(page_id: int | None, number: int, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One record, as a gzip member."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{NAME}{'' if page_id is None else page_id}:{number}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{NAME}{'' if first is None else first}:0>"]
        payload = b""
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", "Content-Type: text/html", f"Content-Length: {len(payload)}"]
    raw = "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + payload + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def planned(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``first`` (the response's id) and ``revisit``."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long_ = F.octet_length("payload") >= LEAST_BYTES
    seen = rows.where(long_).groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("_n"))
    # of the copies only, so that the join's small side holds nothing else
    seen = materialise(seen.where("_n > 1").drop("_n"), "copies")
    copies = rows.join(seen, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    return copies.withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write the planned rows; returns one row per archive: ``archive``, ``records``, ``bytes``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        store.create_dir(root, recursive=True)
        done, out, written, records, number = [], None, 0, 0, 0

        def finish() -> None:
            out.close()
            name = f"{root}/part-{part:06d}-{len(done):05d}.warc.gz"
            store.move(f"{root}/.{attempt}", name)
            done.append((name, records, written))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out, written, records = store.open_output_stream(f"{root}/.{attempt}", compression=None), 0, 0
                number += 1
                # repeated ids have different names; the response that others refer to is number 0
                rank = number if row["revisit"] or row["first"] is None else 0
                data = record(row["page_id"], rank, row["url"], row["payload"], row["digest"], row["first"], row["revisit"])
                out.write(data)
                written, records = written + len(data), records + 1
                if written >= ARCHIVE_BYTES:
                    finish()
                    out = None
        if out is not None:
            finish()
        if done:
            names, counts, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["archive", "records", "bytes"])

    return materialise(rows.select("page_id", "url", "payload", "digest", "first", "revisit").mapInArrow(write, "archive string, records long, bytes long"), "archives")


@dataclass
class Found:
    """A valid record, or a gap if ``reason`` is set."""

    start: int
    end: int
    headers: dict[str, str]
    payload: bytes = b""
    reason: str = ""


def _parsed(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int, str]:
    """Headers, payload and end of the record that begins at ``at``, and why it is not valid."""
    if not raw.startswith(VERSION, at):
        return {}, b"", at, "no version line"
    head = raw.find(b"\r\n\r\n", at)
    if head < 0:
        return {}, b"", at, "headers do not end"
    headers = {}
    for line in raw[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return headers, b"", at, "no length"
    end = head + 4 + int(length)
    if end > len(raw):
        return headers, b"", at, "shorter than its length"
    payload = raw[head + 4 : end]
    said = headers.get("warc-block-digest", "").removeprefix("sha256:")
    if said and hashlib.sha256(payload).hexdigest() != said:
        return headers, payload, at, "digest differs"
    if raw[end : end + 4] != b"\r\n\r\n":
        return headers, payload, at, "no end of record"
    return headers, payload, end + 4, ""


def _member(data: bytes, start: int) -> tuple[list[Found], int]:
    """The records and gaps in the gzip member at ``start``, and where the member ends."""
    opener, at, raw = zlib.decompressobj(31), start, []
    try:
        while not opener.eof and at < len(data):
            raw.append(opener.decompress(data[at : at + READ_BYTES]))
            at = min(len(data), at + READ_BYTES)
    except zlib.error:
        return [Found(start, start, {}, reason="member is damaged")], start
    if not opener.eof:
        return [Found(start, start, {}, reason="member is cut off")], start
    end = at - len(opener.unused_data)
    whole = b"".join(raw)
    inside = list(salvage(whole, members=False)) or [Found(0, 0, {}, reason="no version line")]
    return [Found(start, end, x.headers, x.payload, x.reason) for x in inside], end


def _plain(data: bytes, start: int) -> tuple[list[Found], int]:
    headers, payload, end, why = _parsed(data, start)
    return [Found(start, end, headers, payload, why)], end


def salvage(data: bytes, members: bool = True) -> Iterator[Found]:
    """Valid records in order, and the gaps between them. Without ``members``, records that are not compressed only."""
    at, gap, why = 0, None, ""
    while at < len(data):
        if members and data.startswith(MAGIC, at):
            found, end = _member(data, at)
        elif data.startswith(VERSION, at):
            found, end = _plain(data, at)
        else:
            found, end = [Found(at, at, {}, reason="neither member nor version line")], at
        if not all(x.reason for x in found):
            if gap is not None:
                yield Found(gap, at, {}, reason=why)
                gap = None
            yield from found
            at = end
            continue
        if gap is None:
            gap, why = at, found[0].reason
        places = [p for p in (data.find(MAGIC, at + 1) if members else -1, data.find(VERSION, at + 1)) if p >= 0]
        at = min(places, default=len(data))
    if gap is not None:
        yield Found(gap, len(data), {}, reason=why)


def page_of(name: str) -> int | None:
    number = name.strip("<>").removeprefix(NAME).rpartition(":")[0]
    return int(number) if number.lstrip("-").isdigit() else None


def archives(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return found.select("path", "content")


def read_records(found: DataFrame, payloads: bool = True) -> DataFrame:
    """Valid records of the archives (``path``, ``content``); digest and length are taken from the payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for x in salvage(content):
                    if x.reason:
                        continue
                    again = x.headers.get("warc-type") == "revisit"
                    digest = x.headers.get("warc-payload-digest", "").removeprefix("sha256:") if again else hashlib.sha256(x.payload).hexdigest()
                    rows.append(
                        {
                            "archive": path,
                            "start": x.start,
                            "end": x.end,
                            "page_id": page_of(x.headers.get("warc-record-id", "")),
                            "record_type": x.headers.get("warc-type"),
                            "payload_digest": digest,
                            "payload_bytes": None if again else len(x.payload),
                            "refers_to": page_of(x.headers.get("warc-refers-to", "")) if again else None,
                            "url": x.headers.get("warc-target-uri"),
                            "payload": x.payload if payloads else None,
                        }
                    )
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_pylist(rows, _ROWS)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return found.mapInArrow(read, RECORD)


_ROWS = pa.schema(
    [("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string())]
    + [("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())]
)


def read_gaps(found: DataFrame) -> DataFrame:
    """Quarantined byte ranges of the archives and why each begins."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string())])
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                gaps = [{"archive": path, "start": x.start, "end": x.end, "reason": x.reason} for x in salvage(content) if x.reason]
                yield pa.RecordBatch.from_pylist(gaps, schema)

    return found.mapInArrow(read, GAP)


def resolved(records: DataFrame, expected: int | None = None) -> DataFrame:
    """Revisits get the length of the response with the same digest. Fails if there are not as many records as expected."""
    records = materialise(records.select("page_id", "record_type", "payload_digest", "payload_bytes", "refers_to"), "records")
    if expected is not None and (found := records.count()) != expected:
        raise ValueError(f"{expected} records were written, {found} are read")
    referred = records.where("record_type = 'revisit'").select("payload_digest").distinct()
    known = records.where("record_type = 'response'").join(referred, "payload_digest", "left_semi")
    known = known.groupBy("payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    own = F.coalesce("payload_bytes", "_bytes").alias("payload_bytes")
    return records.join(known, "payload_digest", "left").select("page_id", own, "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back: one row per record."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    written = write_archives(planned(pages), folder).agg(F.sum("records")).first()[0]
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return resolved(read_records(archives(spark, folder), payloads=False), written)
