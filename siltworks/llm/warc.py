"""WARC archives with an index in front of every read.

Writing: each task writes one archive of gzip members, one member per record, and
returns a row for each record with file, offset, length, URL and digest. These rows are
the index. A task that is run again writes another archive; only the archives that the
index names exist for a reader, so an attempt that was lost leaves no record.

Reading: records are selected in the index, sorted by place, and neighbouring ranges are
read in one request.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import col, partitions_for, slices
from siltworks.session import new_table_path, stage

#: records closer than this are read in one request, up to so many bytes
READ_GAP = 64 << 10
READ_BYTES = 8 << 20
#: the records of one stretch of an archive are read by one task
SLAB_BYTES = 8 << 20
GZIP_LEVEL = 1

_NO_LINE_BREAK = re.compile(r"[\x00-\x20\x7f]")

_INDEX = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
    ]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Where tasks read and write bytes: any shared store that Arrow knows, by URI or plain path."""
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_id(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; without ``payload`` it is a revisit, which has the response's header only."""
    kind = "response" if payload is not None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # a break in a URL would end the header line
        head.insert(3, "WARC-Target-URI: " + _NO_LINE_BREAK.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Header fields, and the payload of a response, of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    return {"fields": fields, "payload": payload, "size": int(size[1]) if size else len(payload)}


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and return the index, itself a written table.

    Of records with equal payloads of at least ``min_revisit_bytes`` the one with the
    largest page_id is a response and the others revisit it; a null page_id is smaller
    than all others. Rows that share the largest page_id as well are all responses. Null
    html is an empty payload; a null url gives no target header.
    """
    spark = pages.sparkSession
    folder = folder or new_table_path(spark, "warc")
    body = F.coalesce(col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        col("page_id").cast("long").alias("page_id"),
        col("url").cast("string").alias("url"),
        body.alias("body"),
        F.sha1(body).alias("sha"),
    )
    repeated = rows.filter(F.octet_length("body") >= min_revisit_bytes).select("page_id", "sha").groupBy("sha")
    # written, so that the join below reads both sides by exchanges and a hot payload can be split
    leaders = stage(repeated.agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "leaders")
    is_revisit = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    joined = (
        rows.join(leaders, "sha", "left")
        .withColumn("size", F.octet_length("body").cast("long"))
        .select(
            "page_id",
            "url",
            "size",
            "sha",
            F.when(is_revisit, F.col("leader")).alias("refers_to"),
            F.when(~is_revisit, F.col("body")).alias("body"),
        )
    )
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for batch in slices(batches):
            if out is None:
                store, base = filesystem(folder)
                store.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"  # its own for every attempt
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                info = b"software: siltworks\r\nformat: WARC File Format 1.1\r\n"
                head = (
                    f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
                    f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                )
                first = _member(head.encode() + info + b"\r\n\r\n")
                out.write(first)
                at = len(first)
            index = []
            for page_id, url, size, sha, refers_to, payload in zip(*[c.to_pylist() for c in batch.columns]):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                member = _member(record(page_id, url, payload, size, digest, refers_to, date))
                out.write(member)
                kind = "revisit" if payload is None else "response"
                index.append((f"{folder}/{name}", at, len(member), url, digest, record_id(page_id), kind))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*index), _INDEX)], schema=_INDEX)
        if out is not None:
            out.close()

    index = joined.mapInArrow(
        write, "file string, offset long, length long, url string, digest string, record_id string, record_type string"
    )
    return stage(index, "warc-index")


_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(selected: DataFrame, payloads: bool = False) -> DataFrame:
    """Records that index rows name, from coalesced range reads of the archives.

    Sizes and digests of responses are taken from the payloads as read, those of revisits
    from their headers; a response that does not have its digest fails the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pa.NativeFile] | None = None
        for batch in batches:
            places = list(zip(*[c.to_pylist() for c in batch.columns]))
            k = 0
            while k < len(places):
                file, start, length = places[k]
                stop, m = start + length, k + 1
                while (
                    m < len(places)
                    and places[m][0] == file
                    and places[m][1] - stop <= READ_GAP
                    and places[m][1] + places[m][2] - start <= READ_BYTES
                ):
                    stop = max(stop, places[m][1] + places[m][2])
                    m += 1
                if opened is None or opened[0] != file:
                    store, path = filesystem(file)
                    opened = (file, store.open_input_file(path))
                data = opened[1].read_at(stop - start, start)
                members = (data[at - start : at - start + n] for _, at, n in places[k:m])
                out = [_row(zlib.decompress(x, 31), payloads) for x in members]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), wanted)], schema=wanted)
                k = m

    wanted = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            *([("payload", pa.binary())] if payloads else []),
        ]
    )
    slabs = selected.select("file", "offset", "length", F.expr(f"offset div {SLAB_BYTES}").alias("slab"))
    # index rows are small; tasks are counted by the bytes that they will read
    tasks = partitions_for(selected.agg(F.sum("length")).first()[0] or 0, SLAB_BYTES)
    in_order = slabs.repartition(tasks, "file", "slab").sortWithinPartitions("file", "offset").drop("slab")
    return in_order.mapInArrow(read, _RECORD + ", payload binary" * payloads)


def _row(data: bytes, with_payload: bool) -> tuple:
    found = parse(data)
    fields = found["fields"]
    kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), found["size"]
    if kind == "response":
        size, read = len(found["payload"]), base32_sha1(found["payload"])
        if read != digest:
            raise ValueError(f"{fields['warc-record-id']}: payload has digest {read}, not {digest}")
    row = (
        _page_id(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        size,
        digest,
        kind,
        _page_id(fields.get("warc-refers-to")),
    )
    return (*row, found["payload"] if kind == "response" else None) if with_payload else row
