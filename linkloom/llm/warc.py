"""WARC archives: a writer with revisit records, and a splittable reader.

A task of the writer makes one file of one gzip member a record and reports it in a manifest;
only files of the manifest are ever read, so what a lost or repeated task left behind is
ignored. A task of the reader gets a byte range. It looks for the gzip magic, accepts a member
if it decodes to a WARC header, and owns the records that start inside its range; the last one
it reads to its end beyond the range.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.storage import local_path, materialize, new_path

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
CHUNK = 1 << 20
#: Copies of a payload that one task takes, and the most payloads that are treated as having more.
COPIES, HOT = 1_000, 100_000
DATE = "1970-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _open(path: str, mode: str) -> BinaryIO:
    """A file of the shared folder, in whatever store that is."""
    plain = local_path(path)
    if plain:
        if mode == "wb":
            os.makedirs(os.path.dirname(plain), exist_ok=True)
        return open(plain, mode)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    if mode == "wb":
        store.create_dir(os.path.dirname(inner), recursive=True)
        return store.open_output_stream(inner)
    return store.open_input_file(inner)


def _size(path: str) -> int:
    plain = local_path(path)
    if plain:
        return os.path.getsize(plain)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.get_file_info(inner).size


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False, digest: str | None = None) -> bytes:
    """One WARC record, not yet compressed. A revisit keeps the HTTP header, which tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest or base32_sha1(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = 6) -> DataFrame:
    """Write the archive of page_id, url, html; return its manifest (path, bytes, records).

    Payloads are the html in UTF-8, null as empty. Of the pages with equal payloads of at
    least ``min_bytes``, that with the largest page_id is a response and the others are
    revisits of it; smaller payloads are all responses. Repeated rows of the responding page
    are each a response; where no page of a payload has an id, all are. Null urls leave the
    header out. Other columns are ignored. An empty table has an empty manifest.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    base = base.withColumn("digest", F.unhex(F.sha1("payload")))
    last = base.select("page_id", "digest", F.length("payload").alias("n")).where(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
    last = materialize(last, "digests")
    # payloads of very many copies don't meet in one task: their digests, HOT at most, go to all tasks
    total = last.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = last.where(F.col("copies") > max(COPIES, total // HOT)).select("digest", F.col("response_id").alias("hot_id"), F.lit(True).alias("hot"))
    joined = base.join(F.broadcast(hot), "digest", "left")
    # for the other join, such rows get a key each that meets nothing
    apart = F.concat("digest", F.encode(F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")), "utf-8"))
    joined = joined.withColumn("key", F.when(F.col("hot"), apart).otherwise(F.col("digest")))
    joined = joined.join(last.select(F.col("digest").alias("key"), "response_id"), "key", "left")
    response = F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("response_id"))
    joined = joined.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(response), response).alias("refers_to"), "digest")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for page_id, url, payload, refers_to, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or _open(path, "wb")
                raw = record(page_id, url, payload, refers_to, refers_to is not None, base64.b32encode(digest).decode())
                squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(squeeze.compress(raw) + squeeze.flush())
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([_size(path)], pa.int64()), pa.array([n], pa.int64())], ["path", "bytes", "records"])

    return materialize(joined.mapInArrow(run, "path string, bytes long, records long"), "manifest")


def members(source: BinaryIO, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the members that start in [start, end) of the file."""
    source.seek(start)
    buffer, base, at, more = b"", start, 0, True

    def refill(keep: int) -> None:
        nonlocal buffer, base, at, more
        data = source.read(CHUNK)
        more = bool(data)
        buffer, base, at = buffer[keep:] + data, base + keep, at - keep

    refill(0)
    while True:
        found = buffer.find(MAGIC, at)
        if found < 0 or base + found >= end:
            if not more or base + len(buffer) >= end + len(MAGIC):
                return
            at = max(at, len(buffer) - len(MAGIC) + 1)
            refill(at)
            continue
        inflate, parts, used, valid = zlib.decompressobj(31), [], found, True
        at = found
        try:
            while not inflate.eof:
                if used >= len(buffer):
                    if not more:
                        valid = False
                        break
                    drop = at
                    used -= drop
                    found = 0
                    refill(drop)
                    continue
                step = buffer[used : used + CHUNK]
                parts.append(inflate.decompress(step))
                used += len(step) - len(inflate.unused_data)
                if len(parts) == 1 and not b"WARC/1.".startswith(parts[0][:7]) or len(parts) > 1 and not b"".join(parts[:2]).startswith(b"WARC/1."):
                    valid = False
                    break
        except zlib.error:
            valid = False
        whole = b"".join(parts)
        if valid and b"Content-Length:" in whole.partition(b"\r\n\r\n")[0]:
            yield base + at, whole
            at = used
        else:
            at += 1


def parse(raw: bytes) -> dict:
    """page_id, target_uri, record_type, refers_to, payload_digest, payload_bytes and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    told = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if not revisit and (len(payload) != told or base32_sha1(payload) != stated):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't match its header")
    return {
        "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
        "target_uri": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["WARC-Refers-To"].removeprefix("<urn:page:").rstrip(">")) if revisit else None,
        "payload_digest": stated,
        "payload_bytes": told,
        "payload": None if revisit else payload,
    }


_READ = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def read(manifest: DataFrame, split: int = SPLIT, keep_payload: bool = True) -> DataFrame:
    """One row per record of the archives: see ``parse``. Responses are checked against length and digest.

    Files are cut into ranges of ``split`` bytes, whatever the records' borders.
    """
    columns = _READ if keep_payload else _READ.remove(6)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _open(path, "rb") as source:
                    rows, held = [], 0
                    for _, raw in members(source, start, end):
                        row = parse(raw)
                        rows.append(row if keep_payload else {k: v for k, v in row.items() if k != "payload"})
                        held += len(raw)
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, columns)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, columns)

    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long")))
    ranges = manifest.where("bytes > 0").select("path", starts.alias("start"), "bytes").select("path", "start", F.least(F.col("start") + split, "bytes").alias("end"))
    ddl = "page_id long, target_uri string, record_type string, refers_to long, payload_digest string, payload_bytes long" + (", payload binary" if keep_payload else "")
    # a range is a few bytes here and up to ``split`` in its file: a task for each, not for each 64 MB of rows
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    return ranges.repartition(int(tasks), "path", "start").mapInArrow(run, ddl)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, keep_payload: bool = False) -> DataFrame:
    """Write the archive to the shared folder and read it back."""
    return read(write(pages, new_path(spark, "warc"), min_bytes), keep_payload=keep_payload)
