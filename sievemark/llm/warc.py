"""WARC archives of pages: monolithic gzip files are rewritten with one member per record, beside an offset index.

Spark decides which records are revisits (a sum by payload digest, before which nothing large is shuffled), deals the pages
out to tasks, and each task writes one archive in the shared folder. The normaliser inflates such a file once, as
a stream, holds one record at a time, and writes every record as its own gzip member with its offset, length and
names in a sidecar. Reading goes by the sidecar, so any record is one seek.

A file appears under its name only when it is whole, and its content depends on its task's rows alone, so tasks may run again.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, need, row_key, table

LEVEL = 4
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNK = 1 << 18


def decide(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, url, html`` with payload_bytes, payload_digest and refers_to (null: a response).

    Of rows with equal payloads of at least ``least`` bytes, that with the largest page_id is the response.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("payload_digest"))
    rows = rows.select(*row_key(F.col("page_id"), F.col("payload_digest")), "*")
    facts = rows.where(F.col("payload_bytes") >= least).select("k1", "k2", "page_id", "payload_bytes", "payload_digest")
    same = facts.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("refers_to").isNotNull())
    again = facts.join(same, ["payload_digest", "payload_bytes"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("k1", "k2", "refers_to").distinct()
    return rows.join(again, ["k1", "k2"], "left").drop("k1", "k2")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    return int(name[10:-1]) if name and name != "<urn:page:none>" else None


def record(page: dict, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC record. A revisit has the HTTP head and no payload; both have the full payload's digest and size."""
    revisit = page["refers_to"] is not None
    block = HTTP + (b"" if revisit else (page["html"] or "").encode("utf-8", "surrogatepass"))
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page['page_id'])}",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in page["url"] or ""),
        f"WARC-Payload-Digest: sha1:{page['payload_digest']}",
        f"WARC-Payload-Bytes: {page['payload_bytes']}",
        *([f"WARC-Refers-To: {_name(page['refers_to'])}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    """Header fields of a record's head, names in lower case."""
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode("utf-8", "surrogatepass").split("\r\n")[1:]) if k.strip()}


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of each record of a gzip file, whether it has one member or many."""
    inflate, held = zlib.decompressobj(31), bytearray()

    def more() -> bool:
        nonlocal inflate
        raw = inflate.unused_data if inflate.eof else b""
        if inflate.eof:
            inflate = zlib.decompressobj(31)
        raw = inflate.unconsumed_tail or raw or stream.read(CHUNK)
        if not raw:
            return False
        held.extend(inflate.decompress(raw, 4 * CHUNK))
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("a record's head is cut off")
                return
        fields = headers(bytes(held[:end]))
        size = end + 4 + int(fields["content-length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("a record's block is cut off")
        yield fields, bytes(held[:size])
        del held[:size]


def normalise(source: BinaryIO, target: BinaryIO) -> Iterator[str]:
    """Write each record of ``source`` as a gzip member of ``target``; yields the index's lines (JSON)."""
    at = 0
    for fields, raw in records(source):
        deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        size = target.write(deflate.compress(raw)) + target.write(deflate.flush())
        yield json.dumps({"offset": at, "length": size, "id": fields["warc-record-id"], "type": fields["warc-type"], "digest": fields.get("warc-payload-digest"), "uri": fields.get("warc-target-uri")})
        at += size


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _there(path: str) -> bool:
    where, name = _at(path)
    return where.get_file_info(name).type == fs.FileType.File


class _Whole:
    """Writes under a name of its own and takes the final name on success."""

    def __init__(self, path: str):
        self.where, self.name = _at(path)
        self.draft = f"{self.name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else os.getpid()}.draft"

    def __enter__(self) -> BinaryIO:
        self.where.create_dir(os.path.dirname(self.name), recursive=True)
        self.out = self.where.open_output_stream(self.draft, compression=None)
        return self.out

    def __exit__(self, kind, *_) -> None:
        self.out.close()
        if kind is None:
            self.where.move(self.draft, self.name)
        else:
            self.where.delete_file(self.draft)


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """One monolithic gzip archive for each partition of ``decide``'s rows; returns their paths."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with _Whole(path) as out:
            deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            for batch in batches:
                for k in range(batch.num_rows):
                    out.write(deflate.compress(record(batch.slice(k, 1).to_pylist()[0])))
                    n += 1
            out.write(deflate.flush())
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

    return decided.mapInArrow(part, "path string, records long")


def normalise_archives(paths: DataFrame, folder: str, drop_source: bool = False) -> DataFrame:
    """Rewrite the archives named in ``path`` with one member per record; returns path, index and records.

    With ``drop_source`` a monolithic file goes once its rewritten form is whole; a task that runs again then finds that form.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                target = f"{folder}/{path.rsplit('/', 1)[1]}"
                index = f"{target}.idx"
                if not (_there(target) and _there(index)):
                    where, name = _at(path)
                    with where.open_input_stream(name, compression=None) as source, _Whole(target) as out, _Whole(index) as lines:
                        for line in normalise(source, out):
                            lines.write(line.encode() + b"\n")
                if drop_source and _there(path):
                    where, name = _at(path)
                    where.delete_file(name)
                where, name = _at(index)
                with where.open_input_stream(name) as lines:
                    n = lines.read().count(b"\n")
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([index]), pa.array([n], pa.int64())], ["path", "index", "records"])

    return _dealt(paths).mapInArrow(part, "path string, index string, records long")


def _dealt(paths: DataFrame) -> DataFrame:
    return paths.select("path").repartition(max(1, paths.count()), "path")


def read_archives(paths: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, by their indexes.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to, archive, offset, and ``payload`` if asked for. A
    response's payload must have the digest and size that its head says.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long" + ", payload binary" * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def one(raw: bytes, path: str, at: int) -> tuple:
        head, _, block = zlib.decompress(raw, 31)[:-4].partition(b"\r\n\r\n")
        f = headers(head)
        payload = block.partition(b"\r\n\r\n")[2]
        size, digest = int(f["warc-payload-bytes"]), f["warc-payload-digest"].removeprefix("sha1:")
        if f["warc-type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
            raise ValueError(f"{path} at {at}: the payload is not what its head says")
        return (_page(f["warc-record-id"]), f.get("warc-target-uri") or None, size, digest, f["warc-type"], _page(f.get("warc-refers-to")), path, at, payload)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = _at(path)
                with where.open_input_stream(f"{name}.idx") as lines:
                    index = [json.loads(x) for x in lines.read().splitlines()]
                with where.open_input_file(name) as archive:
                    for k in range(0, len(index), 500):
                        got = []
                        for x in index[k : k + 500]:
                            archive.seek(x["offset"])
                            got.append(one(archive.read(x["length"]), path, x["offset"]))
                        yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], types[i]) for i in range(len(names))], names)

    return _dealt(paths).mapInArrow(part, schema)


def archive_pages(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as normalised archives in the shared folder; returns their paths and indexes.

    A null html is an empty payload. A row without a page_id is a record named ``none``; among equal payloads it
    revisits a row with an id, and is a response where no row has one. Rows that repeat the response's page_id and
    payload are responses too. Other columns are left out; an empty table gives archives without records, or none.
    """
    need(pages, "page_id", "url", "html")
    folder = fresh_dir(pages.sparkSession, "warc")
    written = table(write_archives(decide(pages, least), f"{folder}/whole"), "warc-list")
    return table(normalise_archives(written, f"{folder}/members", drop_source=True), "warc-list")
