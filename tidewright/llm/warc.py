"""WARC archives: written, normalised from one gzip stream to a member per record, read back.

``write`` puts one record per row into archives that are gzipped as a whole, as a
plain ``gzip file.warc`` leaves them. ``normalise`` inflates such a stream once,
writes every record as a gzip member of its own and beside each archive an index
of record id, offset and length, so that any record can be read alone.
``read`` parses normalised archives; ``read_one`` seeks to one record.

Files are written by tasks through ``pyarrow.fs`` under random names; a reader gets
the list of files from the tasks that succeeded, so that a lost or repeated task
leaves no record twice, and what it wrote is never read (it goes with the scratch
folder).

Defined cases: null payloads are empty; a null url is ``urn:none``; rows that repeat an
id are records of their own; a row without an id is a response, and no others revisit it;
an empty table gives no archives and no rows; extra columns are not read.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Bytes of records after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Equal payloads of fewer bytes are stored each.
LEAST_REVISIT = 1000
#: All records carry this date: archives of equal tables are equal.
DATE = "2024-01-01T00:00:00Z"
_LEVEL = 3
_BUFFER = 1 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    found, local = fs.FileSystem.from_uri(path)
    return found, local


def _create(path: str) -> Any:
    where, local = _open(path)
    where.create_dir(local.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(local, compression=None, buffer_size=_BUFFER)


def _put(path: str, data: bytes) -> None:
    with _create(path) as out:
        out.write(data)


def _get(path: str, offset: int = 0, length: int | None = None) -> bytes:
    where, local = _open(path)
    with where.open_input_file(local) as f:
        f.seek(offset)
        return f.read() if length is None else f.read(length)


def record_id(key: Any) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def record(key: Any, url: str | None, payload: bytes, digest: str, kind: str, refers_to: Any) -> bytes:
    """One record; a revisit keeps the headers and no payload."""
    block = payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or 'urn:none').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(stream: Any) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """``(headers, block, raw bytes)`` of every record of an inflated stream, read as it comes."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        raw, headers = [line], {}
        while (line := stream.readline()).strip():
            raw.append(line)
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        raw.append(line)
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError("the archive ends within a record")
        end = stream.read(4)
        yield headers, block, b"".join(raw) + block + end


def decide(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``key, digest, bytes, holder``: of equal payloads of ``least`` bytes or more, the largest key holds the payload."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    seen = pages.select(F.col(id_col).cast("long").alias("key"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    held = seen.filter(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return seen.join(held, ["digest", "bytes"], "left").filter("holder is not null and key <> holder").select("key", "digest", "holder").distinct()


def write(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Archives gzipped as one stream each; ``path, records, bytes`` of each."""
    revisits = scratch.save(decide(pages, id_col, payload_col, least), "revisits")
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.col(url_col).alias("url"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"), payload.alias("payload"))
    rows = rows.join(revisits.select("key", "digest", "holder"), ["key", "digest"], "left").select("key", "url", "digest", "bytes", "payload", "holder")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, size = None, 0, 0

        def close() -> pa.RecordBatch:
            z.close()
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            _put(path, out.getvalue())
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([out.tell()], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for key, url, digest, _, payload_value, holder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, n, size = io.BytesIO(), 0, 0
                    z = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=_LEVEL, mtime=0)
                data = record(key, url, payload_value, digest, "response" if holder is None else "revisit", holder)
                z.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return scratch.save(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def members(source: Any) -> Iterator[tuple[str, bytes]]:
    """Record id and own gzip member of every record of a whole-file stream (or of members): bytes, or a file read as it comes."""
    with gzip.GzipFile(fileobj=io.BytesIO(source) if isinstance(source, bytes) else source) as stream:
        for headers, _, raw in records(io.BufferedReader(stream, 1 << 16)):  # type: ignore[arg-type]
            z = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
            yield headers["warc-record-id"], z.compress(raw) + z.flush()


def normalise(archives: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Rewrites each archive; ``path, index_path, records`` of the new ones.

    Archives of any size pass as streams: a task holds one record at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                to, offset, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                where, local = _open(path)
                with where.open_input_stream(local, compression=None, buffer_size=_BUFFER) as source, _create(to) as out, _create(f"{to}.idx") as index:
                    for name, member in members(source):
                        out.write(member)
                        index.write(json.dumps({"id": name, "offset": offset, "length": len(member)}).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_arrays([pa.array([to]), pa.array([f"{to}.idx"]), pa.array([n], pa.int64())], ["path", "index_path", "records"])

    spread = archives.select("path").repartition(max(1, archives.count()), "path")
    return scratch.save(spread.mapInArrow(run, "path string, index_path string, records long"), "normalised")


def read_one(path: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    headers, block, _ = next(records(io.BytesIO(gzip.decompress(_get(path, offset, length)))))
    return headers, block


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of normalised archives, each inflated alone at the place its index gives; index and archive are read as they come."""
    names = ["key", "url", "kind", "digest", "payload_bytes", "refers_to", "block_digest"] + ["payload"] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def number(text: str | None) -> int | None:
            tail = (text or "none").strip("<>").rsplit(":", 1)[-1]
            return None if tail == "none" else int(tail)

        def batch_of(rows: list[list[Any]]) -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] * with_payload)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for path, index_path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (where, local), (_, local_index) = _open(path), _open(index_path)
                rows, held_bytes = [], 0
                with where.open_input_stream(local, compression=None, buffer_size=_BUFFER) as data, where.open_input_stream(local_index, compression=None, buffer_size=_BUFFER) as index:
                    at = 0
                    for place in map(json.loads, io.BufferedReader(index)):
                        if place["offset"] != at:
                            raise ValueError(f"{index_path} leaves a gap at {at}")
                        at += place["length"]
                        headers, block, _ = next(records(io.BytesIO(gzip.decompress(data.read(place["length"])))))
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        held = hashlib.sha1(block).hexdigest() if headers["warc-type"] == "response" else None
                        if held not in (None, digest):
                            raise ValueError(f"{headers['warc-record-id']} does not hold the payload of its digest")
                        rows.append([number(headers["warc-record-id"]), headers["warc-target-uri"], headers["warc-type"], digest, int(headers["x-payload-length"]), number(headers.get("warc-refers-to")), held, *([block] * with_payload)])
                        held_bytes += len(block) * with_payload
                        if len(rows) == 1000 or held_bytes > _BUFFER << 4:
                            yield batch_of(rows)
                            rows, held_bytes = [], 0
                if rows:
                    yield batch_of(rows)

    ddl = "key long, url string, kind string, digest string, payload_bytes long, refers_to long, block_digest string" + ", payload binary" * with_payload
    spread = archives.select("path", "index_path").repartition(max(1, archives.count()), "path")
    return spread.mapInArrow(run, ddl)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes, normalises and reads back ``pages``; the whole-file streams are removed in between."""
    scratch = Scratch(pages.sparkSession, "warc")
    whole = write(pages, f"{scratch.root}/whole", scratch, id_col, url_col, payload_col)
    tidy = normalise(whole, f"{scratch.root}/members", scratch)
    scratch.drop(f"{scratch.root}/whole")
    return read(tidy)
