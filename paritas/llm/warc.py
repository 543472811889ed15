"""WARC archives: revisit decisions, a writer, and a splittable reader.

Of pages with equal payloads of at least 1000 bytes the one with the largest
``page_id`` is stored, the others become revisit records that refer to it.
Each record is a gzip member of its own, so a file can be read in parts: a
task gets a byte range, looks for gzip magic in it, takes a candidate for a
member only if its first decoded bytes are a WARC version line, and owns the
records that begin inside its range, reading past the end for the last one.
A member that begins inside the range is followed by the next one at the place
where it ends; only where that is no member does the search go on.

Writers name files by attempt; the saved list of files, which Spark commits,
says which count, so retried or lost tasks leave no records twice.

Edge cases: a null html is an empty payload; a null url leaves out the target;
a null ``page_id`` never stands for others and is read back as null. Repeated
rows that all hold the largest id are all responses. An empty table writes no
file and reads no rows. Extra columns are not read. Payloads of any length are
written whole.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import new_folder, saved, slices

#: Payloads from this length on are stored once.
LEAST_SHARED = 1000
#: Copies of a payload's stored record for the lookup, so that one that a third
#: of all pages share is looked up by many tasks.
SALTS = 16
#: Bytes of a file that one reading task owns, and reading tasks at most.
RANGE_BYTES, MOST_TASKS = 8 << 20, 20_000
LEVEL = 5
MAGIC = b"\x1f\x8b\x08"

# --- fixed values: the format ------------------------------------------------
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# --- end of fixed values -----------------------------------------------------


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to (null: a response)."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    own = own.withColumn("payload_digest", F.sha1(F.col("payload").cast("binary")))
    shared = (own.where(F.octet_length("payload") >= LEAST_SHARED)
              .groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("stored"))
              .where("n > 1 AND stored IS NOT NULL")
              .select("payload_digest", "stored",
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("stored"))
    return salted.join(shared, ["payload_digest", "salt"], "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(F.col("stored").isNotNull() & other, F.col("stored")).alias("refers_to"))


def _line(value: str) -> str:
    """A header's value on one line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """One gzip member."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    if page_id is not None:
        head.append(("Page-Id", str(page_id)))
    head.append(("WARC-Payload-Digest",
                 "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n")
    block = http.encode() + (payload if refers_to is None else b"")
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("Refers-To-Page-Id", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    lines = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(lines + block + b"\r\n\r\n") + packer.flush()


def parsed(data: bytes) -> dict:
    """A record's fields; a response's digest is computed from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b": ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
    if fields["WARC-Type"] == "response":
        if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of page {fields.get('Page-Id')} is damaged")
    ident, refers = fields.get("Page-Id"), fields.get("Refers-To-Page-Id")
    return {"page_id": int(ident) if ident else None, "url": fields.get("WARC-Target-URI"),
            "payload_bytes": length, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": int(refers) if refers else None,
            "payload": payload if fields["WARC-Type"] == "response" else None}


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives; returns the list of files, which it saves too."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size = None, None, 0
        for batch in batches:
            for b in slices(batch, "payload"):
                if out is None:
                    store, base = fs.FileSystem.from_uri(folder)
                    store.create_dir(base, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", store.open_output_stream(
                        f"{base}/{name}", compression=None)
                for page_id, url, payload, digest, refers_to in zip(
                        *(c.to_pylist() for c in (b.column("page_id"), b.column("url"),
                                                  b.column("payload").cast(pa.binary()),
                                                  b.column("payload_digest"),
                                                  b.column("refers_to")))):
                    member = record(page_id, url, payload, digest, refers_to)
                    out.write(member)
                    size += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": [size]}, pa.schema(
                [("path", pa.string()), ("size", pa.int64())]))

    return saved(decided(pages).mapInArrow(files, "path string, size long"), "archives")


def members(f, size: int, start: int, end: int) -> Iterator[bytes]:
    """The decoded members of a file that begin in [start, end)."""
    data, base = f.read_at(min(end, size) - start + len(MAGIC), start), start
    at = start
    while True:
        at = data.find(MAGIC, at - base) + base
        if at < base or at >= end:
            return
        whole, after = _member(f, size, data, base, at)
        if whole is None:
            at += 1
            continue
        yield whole
        if after >= end:
            return
        at = after


def _member(f, size: int, data: bytes, base: int, at: int) -> tuple[bytes | None, int]:
    """The member at ``at`` and where it ends, or None if there is none."""
    unpacker = zlib.decompressobj(31)
    out, fed = [], at
    piece = data[at - base:at - base + 4096]  # enough to tell a member by its first line
    while True:
        fed += len(piece)
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error:
            return None, at
        if len(out) == 1 and not out[0].startswith(VERSION) and (
                len(out[0]) >= len(VERSION) or unpacker.eof):
            return None, at
        if unpacker.eof:
            return b"".join(out), fed - len(unpacker.unused_data)
        if fed >= size:
            return None, at  # cut off, so not a member
        inside = data[fed - base:fed - base + (1 << 16)] if fed - base < len(data) else b""
        piece = inside or f.read_at(min(1 << 16, size - fed), fed)


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary())])
#: Records held until they are handed on: few, as payloads may be long.
_AT_ONCE = 256


def read(files: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the listed files (path, size)."""
    schema = _RECORD if with_payload else pa.schema([x for x in _RECORD if x.name != "payload"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                held = []
                with store.open_input_file(path) as f:
                    for m in members(f, row["size"], row["start"], row["start"] + range_bytes):
                        held.append(parsed(m))
                        if not with_payload:
                            del held[-1]["payload"]
                        if len(held) == _AT_ONCE:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    ranges = files.select("path", "size", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    tasks = max(1, min(MOST_TASKS, ranges.count()))
    names = ("page_id long, url string, payload_bytes long, payload_digest string, "
             "record_type string, refers_to long" + ", payload binary" * with_payload)
    return ranges.repartition(tasks, "path", "start").mapInArrow(records, names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives and returns their records as read back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read(write(pages, folder), with_payload=False)
