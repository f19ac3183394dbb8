"""Web pages in WARC files, written sharded and the same at every run, and read back.

Of equal payloads of at least ``REVISIT_BYTES`` the record of the largest page id holds the payload, and the
others are revisit records that point to it. Which those are is found on digests alone; the payloads are shuffled
once, to sort them by page id. Each record is one gzip member without a time stamp. A file is closed when its
compressed size reaches the limit; headers, record ids and digests are made anew from the page, so the same pages
give the same bytes. Files are committed by :mod:`files`.

Null payloads are written as empty ones, null urls as an empty target, null ids come first and are read back as
null. Rows with the same largest id and the same payload are all responses. An empty table gives no files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm import files
from moodlens.llm.cuts import slices

REVISIT_BYTES = 1000
#: Compressed bytes after which a file is closed.
FILE_BYTES = 64 << 20
#: Payload bytes of a range.
RANGE_BYTES = 16 << 20
#: Partitions of files when they are read back, at most.
READERS = 20_000
#: The date in every record; the tables have none.
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = f"{files.MANIFEST}, records bigint"
RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string()),
])


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}').urn}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed: a response, or a revisit of the page ``refers_to``."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{_base32(digest)}"),
        ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).hexdigest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _info() -> bytes:
    block = b"software: moodlens\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{uuid.uuid5(uuid.NAMESPACE_URL, 'warcinfo').urn}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _writer(folder: str, limit: int) -> Callable:
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), []
        temporary, out, size, records = "", None, 0, 0
        notice_id, notices = None, {}

        def close() -> None:
            nonlocal out, size, records
            out.close()
            done.append((part, len(done), temporary, f"pages-{part:06d}-{len(done):04d}.warc.gz", size, records))
            out, size, records = None, 0, 0

        for rows in chain.from_iterable(slices(p, "html") for p in parts):
            for page_id, notice, digest, refers_to, url, html in zip(*(c.to_pylist() for c in rows.columns)):
                if notice:  # sorted ahead of the pages with this id
                    if notice_id != page_id:
                        notice_id, notices = page_id, {}
                    notices[digest] = refers_to
                    continue
                payload = (html or "").encode()
                target = notices.get(hashlib.sha1(payload).hexdigest()) if notices and notice_id == page_id and len(payload) >= REVISIT_BYTES else None
                if out is None:
                    temporary = files.temporary_name()
                    out = files.create(folder, temporary)
                    size = out.write(gzip.compress(_info(), mtime=0))
                member = gzip.compress(record(page_id, url, payload, target), mtime=0)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= limit:
                    close()
        if out is not None:
            close()
        columns = zip(*done) if done else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return write


def revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages that repeat the payload of a page with a larger id."""
    slim = pages.select("page_id", "html").where(F.octet_length("html") >= REVISIT_BYTES).select("page_id", F.sha1("html").alias("digest"))
    last = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return slim.join(last, "digest").where("page_id IS NULL OR page_id < refers_to").where("refers_to IS NOT NULL").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str, limit: int = FILE_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)`` below ``folder``; returns the manifest."""
    pages = pages.select("page_id", "url", "html")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    none = F.lit(None)
    own = pages.select("page_id", F.lit(0).alias("notice"), none.cast("string").alias("digest"), none.cast("bigint").alias("refers_to"), "url", "html")
    told = revisits(pages).select("page_id", F.lit(1).alias("notice"), "digest", "refers_to", none.cast("string").alias("url"), none.cast("string").alias("html"))
    both = own.unionByName(told).repartitionByRange(int(total // RANGE_BYTES + 1), "page_id")
    order = ["page_id", F.desc("notice"), "url", "html", "digest"]
    return files.commit(both.sortWithinPartitions(*order).mapInArrow(_writer(folder, limit), MANIFEST), folder)


def members(file: BinaryIO, step: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, each uncompressed, read piece by piece."""
    unpack, parts = zlib.decompressobj(31), []
    while data := file.read(step):
        while data:
            parts.append(unpack.decompress(data))
            data = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last record is cut off")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record, after checking its length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != f"sha1:{_base32(hashlib.sha1(block).hexdigest())}":
        raise ValueError(f"wrong block digest in {fields['WARC-Record-ID']}")
    return fields, block


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)`` of every page record.

    ``payload`` is null for revisits; length and digest are those of the full payload.
    """

    def records(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name in part.column("name").to_pylist():
                rows, size = [], 0
                with files.open_input(folder, name) as file:
                    for data in members(file):
                        fields, block = parse(data)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"wrong payload in {fields['WARC-Record-ID']}")
                        page, target = fields["WARC-Page-ID"], fields.get("WARC-Refers-To-Page-ID")
                        rows.append((int(page) if page else None, fields["WARC-Target-URI"], length, digest, fields["WARC-Type"], int(target) if target else None, None if revisit else payload.decode()))
                        size += len(data)
                        if size > 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                yield _batch(rows)

    spread = manifest.select("name").repartition(min(READERS, manifest.count() + 1), "name")
    return spread.mapInArrow(records, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(RECORD)
    return pa.RecordBatch.from_arrays([pa.array(c, RECORD.field(k).type) for k, c in enumerate(columns)], schema=RECORD)
