"""WARC archives: written with an index of their records, read back by byte ranges.

Each task writes archives of its own (one gzip member per record) through the file system of the shared folder and
returns an index row per record: file, offset, length, url, digest. Only rows of tasks that succeeded get into the
index, so that the files of a lost or repeated attempt are never read. Reading sorts the chosen index rows by file
and offset and joins neighbouring ranges into one read.

Records with equal payloads are found on (digest, length) alone; payloads are shuffled once, by digest and a salt,
so that a payload that a third of all pages share is written by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.storage import materialize, scratch_path
from emberline.llm.common import arrow_schema
from pyspark.sql import types as T

#: A new archive is begun beyond so many bytes; ranges are joined over gaps and up to sizes like these.
ARCHIVE_BYTES = 256 << 20
GAP_BYTES = 64 << 10
RANGE_BYTES = 8 << 20
#: Bytes of archive that a task reads, about.
TASK_BYTES = 32 << 20
SALTS = 16

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("file string, offset long, length long, url string, payload_digest string, page_id long, "
         "record_type string")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload string")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of SHA-1: each five hex digits are four characters."""
    digits = F.sha1(data)
    chars = []
    for group in range(8):
        value = F.conv(F.substring(digits, 1 + 5 * group, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(_BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1))
                  for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {str(v).replace(chr(13), '%0D').replace(chr(10), '%0A')}"
                           for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, target: int | None,
                 date: str) -> bytes:
    """One record; ``target`` is the page whose record holds the payload, for a revisit."""
    block = _HTTP + payload if target is None else _HTTP
    fields = [("WARC-Type", "response" if target is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
              ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", len(block))]
    if target is not None:
        fields[2:2] = [("WARC-Refers-To", f"<urn:page:{target}>"), ("WARC-Profile", _REVISIT_PROFILE)]
    return _header(fields) + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """A RECORD row; the payload of a response is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    kind, payload, refers = fields["WARC-Type"], None, None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        payload = payload.decode("utf-8", "surrogatepass")
    else:
        refers = _page(fields["WARC-Refers-To"])
    return (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind, refers, payload)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "None" else int(number)


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``; return the index (INDEX).

    Of equal payloads the largest page_id is the response and other pages are revisits of it; rows that repeat
    that page_id, or have none, are responses of their own. NULL html is an empty payload, a NULL url gives a
    record without a target. ``folder`` is by default a new one in the shared folder; other columns are ignored.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    struct = T._parse_datatype_string(INDEX)
    schema = arrow_schema(struct)

    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").alias("bytes"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt"))
    repeated = (rows.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.max("page_id").alias("target"))
                .filter("n > 1").select("digest", "bytes", "target",
                                        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
                                        .alias("salt")))
    marked = rows.join(repeated.hint("shuffle_hash"), ["digest", "bytes", "salt"], "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("target"), F.col("target"))
        .alias("target"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(name, compression=None)
                page_id, url, payload, digest, target = row
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record_bytes(page_id, url, payload, digest, target, date)) + packer.flush()
                out.write(member)
                index.append((name, at, len(member), url, digest, page_id,
                              "response" if target is None else "revisit"))
                at += len(member)
            if index:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*index), schema)], schema=schema)
        if out is not None:
            out.close()

    written = marked.mapInArrow(write, struct)
    scheme = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    return materialize(written.withColumn("file", F.concat(F.lit(scheme), "file")), "warc-index")


def joined_ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(file, offset, length) sorted by file and offset -> file, start, size, and each record's place in the range."""
    current: list | None = None
    for file, offset, length in rows:
        if (current and current[0] == file and offset - (current[1] + current[2]) <= GAP_BYTES
                and offset + length - current[1] <= RANGE_BYTES):
            current[2] = max(current[2], offset + length - current[1])
            current[3].append((offset - current[1], length))
        else:
            if current:
                yield tuple(current)
            current = [file, offset, length, [(0, length)]]
    if current:
        yield tuple(current)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the chosen rows of an index (RECORD); each payload is checked against its digest.

    Tasks are stretches of files with about TASK_BYTES of chosen records each, however few index rows these are.
    """
    struct = T._parse_datatype_string(RECORD)
    schema = arrow_schema(struct)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple | None = None
        for batch in batches:
            for file, start, size, places in joined_ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                if opened is None or opened[0] != file:
                    system, path = _file_system(file)
                    opened = (file, system.open_input_file(path))
                data = opened[1].read_at(size, start)
                rows = [parse_record(zlib.decompress(data[a:a + n], 31)) for a, n in places]
                if not payloads:
                    rows = [(*row[:-1], None) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    ranges = index.select("file", "offset", "length")
    tasks = max(1, -(-(ranges.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    by_place = ranges.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return by_place.mapInArrow(read, struct)
